"""Checks of the cleaning operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.money import money_sum as msum
from ..operators import clean
from ..sources import retail_tables as rt
from . import frames as fr
from .sql import money_sum

# Limits low enough for these tables to cross them.
CONFIG = clean.CleanConfig(revenue_max=90_000.0, quantity_min=2, quantity_max=48,
                           min_date=dt.date(1996, 1, 1), max_date=dt.date(2001, 6, 30))


def _with_copies(spark, d):
    """Sales plus a later exact copy of every tenth quantity."""
    s = rt.sales(spark, d)
    later = F.col("ingest_ord") + F.expr("50000000000000000000000000000000000000BD")
    return s.unionByName(s.where(F.col("qty") % 10 == 0).withColumn("ingest_ord", later.cast("decimal(38,0)")))


def _with_holes(spark, d):
    """Sales with planted nulls."""
    s = rt.sales(spark, d, with_orders=True)
    return s.withColumns({
        "revenue": F.when(F.col("qty") == 13, None).otherwise(F.col("revenue")),
        "qty": F.when(F.col("qty") == 7, None).otherwise(F.col("qty")),
        "payment_method": F.when(F.col("payment_method") == "DEBIT", None).otherwise(F.col("payment_method")),
        "date": F.when(F.col("qty") == 21, None).otherwise(F.col("date"))})


def _fingerprint(df):
    return df.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("qty").alias("qty"), msum("revenue").alias("revenue"))


def exact_copies(spark, d):
    return _fingerprint(clean.drop_exact_copies(_with_copies(spark, d)))


def key_copies(spark, d):
    return _fingerprint(clean.remove_duplicates(_with_copies(spark, d)))


def duplicate_report(spark, d):
    return fr.big(clean.duplicate_counts(_with_copies(spark, d)),
                  "initial_rows", "exact_removed", "fuzzy_removed", "total_removed")


def missing_report(spark, d):
    holes = _with_holes(spark, d)
    return clean.missing_counts(holes, ["revenue", "qty", "payment_method", "date", "store_id"])


def filled(spark, d):
    return clean.fill_missing(_with_holes(spark, d)).groupBy("payment_method", "store_id").agg(
        F.count(F.lit(1)).alias("sales"), F.count("date").alias("dated"), F.sum("qty").alias("qty"),
        msum("revenue").alias("revenue"))


def interpolated(spark, d):
    """Row-position interpolation over the whole frame, compared per store."""
    s = rt.sales(spark, d).select("store_id", "ingest_ord", "qty", F.when(
        F.col("qty") % 3 == 0, None).otherwise(F.col("revenue")).alias("revenue"))
    return clean.interpolate(s, ["revenue"]).groupBy("store_id").agg(
        F.count("revenue").alias("known"), F.round(F.sum("revenue"), 2).alias("revenue"),
        F.round(F.max("revenue"), 4).alias("highest"))


def negatives(mode):
    def query(spark, d):
        return _fingerprint(clean.handle_negatives(rt.sales(spark, d), mode))
    return query


def ranges(spark, d):
    return clean.range_counts(rt.sales(spark, d), CONFIG)


def dates(spark, d):
    return clean.date_counts(rt.sales(spark, d), CONFIG)


def iqr(spark, d):
    return clean.outlier_counts(rt.sales(spark, d).withColumn("flag", F.col("qty") % 2), ["qty", "revenue", "flag"])


def zscore(spark, d):
    return clean.outlier_counts(rt.sales(spark, d), ["qty", "revenue"],
                                CONFIG.with_(outlier_method="zscore", zscore_limit=1.6))


def outlier_flags(spark, d):
    flagged = clean.flag_outliers(rt.sales(spark, d), ["revenue"])
    return flagged.groupBy("store_id").agg(F.count_if("revenue_outlier").alias("outliers"))


def gaps(spark, d):
    out = clean.fill_missing_dates(rt.sales(spark, d))
    return out.groupBy("store_id", "is_interpolated").agg(
        F.count(F.lit(1)).alias("sales"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.count_distinct("date").alias("days"), msum("revenue").alias("revenue"),
        F.max("product_id").alias("last_product"))


def texts(spark, d):
    messy = rt.sales(spark, d, with_orders=True).select(
        "store_id", "customer_id", F.concat(F.lit("  "), F.lower("payment_method"), F.lit("\t ")).alias("payment"),
        F.concat(F.lit(" a/"), "product_id").alias("source_file"), F.concat(F.lit(" x"), "product_id").alias("sku"))
    return clean.standardize_text(messy).groupBy("payment").agg(
        F.count(F.lit(1)).alias("sales"), F.min("source_file").alias("source_file"), F.min("sku").alias("sku"))


def report(spark, d):
    """The whole cleaning step on sales with copies: its quality report."""
    return clean.clean(_with_copies(spark, d), CONFIG)[1].withColumn("value", F.round("value", 6)).where("value <> 0")


def cleaned(spark, d):
    return _fingerprint(clean.clean(_with_copies(spark, d), CONFIG)[0])


QUERIES = {
    "clean_exact_copies": exact_copies,
    "clean_key_copies": key_copies,
    "clean_duplicate_counts": duplicate_report,
    "clean_missing_counts": missing_report,
    "clean_fill_missing": filled,
    "clean_interpolate": interpolated,
    "clean_negative_absolute": negatives("absolute"),
    "clean_negative_zero": negatives("zero"),
    "clean_range_counts": ranges,
    "clean_date_counts": dates,
    "clean_iqr_outliers": iqr,
    "clean_zscore_outliers": zscore,
    "clean_outlier_flags": outlier_flags,
    "clean_fill_dates": gaps,
    "clean_standard_text": texts,
    "clean_report": report,
    "clean_frame": cleaned,
}

_COPIES = """copies AS (SELECT * FROM sales UNION ALL SELECT * FROM sales WHERE qty % 10 = 0)"""
_PRINT = f"count(*) AS sales, CAST(sum(qty) AS BIGINT) AS qty, {money_sum('revenue')} AS revenue"
_FIRST = """first_rows AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY store_id, date, product_id ORDER BY ingest_ord) AS rn FROM copies) WHERE rn = 1)"""
_HOLES = """holes AS (SELECT store_id, product_id,
    CASE WHEN qty = 21 THEN NULL ELSE date END AS date,
    CASE WHEN qty = 13 THEN NULL ELSE revenue END AS revenue, CASE WHEN qty = 7 THEN NULL ELSE qty END AS qty,
    CASE WHEN payment_method = 'DEBIT' THEN NULL ELSE payment_method END AS payment_method FROM order_sales)"""
_GAPS = """
    per_store AS (SELECT store_id, count(*) AS n, min(date) AS a, max(date) AS b, count(DISTINCT date) AS days
                  FROM rows_in GROUP BY store_id),
    chosen AS (SELECT * FROM per_store WHERE n >= 3 AND (b - a + 1 - days) BETWEEN 1 AND 29),
    wanted AS (SELECT store_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM chosen),
    missing AS (SELECT * FROM wanted ANTI JOIN rows_in USING (store_id, date)),
    last_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY ingest_ord DESC) AS lr
                  FROM rows_in) WHERE lr = 1)"""


def _bounds(column: str, source: str) -> str:
    return (f"SELECT '{column}' AS \"column\", count(*) AS outliers FROM {source}, (SELECT quantile_cont({column}, 0.25) AS q1,"
            f" quantile_cont({column}, 0.75) AS q3 FROM {source}) q WHERE {column} < q1 - 1.5 * (q3 - q1)"
            f" OR {column} > q3 + 1.5 * (q3 - q1)")


SQL = {
    "clean_exact_copies": f"""
        WITH {_COPIES} SELECT store_id, {_PRINT} FROM (
            SELECT DISTINCT store_id, date, product_id, qty, revenue FROM copies) GROUP BY store_id""",
    "clean_key_copies": f"WITH {_COPIES}, {_FIRST} SELECT store_id, {_PRINT} FROM first_rows GROUP BY store_id",
    "clean_duplicate_counts": f"""
        WITH {_COPIES}, d AS (SELECT DISTINCT store_id, date, product_id, qty, revenue FROM copies),
        n AS (SELECT (SELECT count(*) FROM copies) AS a, (SELECT count(*) FROM d) AS b,
              (SELECT count(*) FROM (SELECT DISTINCT store_id, date, product_id FROM d)) AS c)
        SELECT a AS initial_rows, a - b AS exact_removed, b - c AS fuzzy_removed, a - c AS total_removed FROM n""",
    "clean_missing_counts": f"""
        WITH {_HOLES} SELECT count_if(revenue IS NULL)::BIGINT AS revenue, count_if(qty IS NULL)::BIGINT AS qty,
            count_if(payment_method IS NULL)::BIGINT AS payment_method, count_if(date IS NULL)::BIGINT AS date,
            count_if(store_id IS NULL)::BIGINT AS store_id FROM holes""",
    "clean_fill_missing": f"""
        WITH {_HOLES} SELECT coalesce(payment_method, 'UNKNOWN') AS payment_method, store_id, count(*) AS sales,
            count(date) AS dated, CAST(sum(coalesce(qty, 0)) AS BIGINT) AS qty,
            {money_sum('coalesce(revenue, 0)')} AS revenue
        FROM holes GROUP BY ALL""",
    "clean_interpolate": """
        WITH s AS (SELECT store_id, row_number() OVER (ORDER BY ingest_ord) AS pos,
                   CASE WHEN qty % 3 = 0 THEN NULL ELSE revenue END AS v FROM sales),
        w AS (SELECT *, last_value(v IGNORE NULLS) OVER b AS pv,
                  last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER b AS pp,
                  first_value(v IGNORE NULLS) OVER f AS nv,
                  first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER f AS np
              FROM s WINDOW b AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                            f AS (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        i AS (SELECT store_id, CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
                  ELSE pv + (nv - pv) / (np - pp) * (pos - pp) END AS v FROM w)
        SELECT store_id, count(v) AS known, round(sum(v), 2) AS revenue, round(max(v), 4) AS highest
        FROM i GROUP BY store_id""",
    "clean_negative_absolute": f"""
        SELECT store_id, count(*) AS sales, CAST(sum(qty) AS BIGINT) AS qty, {money_sum('abs(revenue)')} AS revenue
        FROM sales GROUP BY store_id""",
    "clean_negative_zero": f"""
        SELECT store_id, count(*) AS sales, CAST(sum(qty) AS BIGINT) AS qty,
               {money_sum('greatest(revenue, 0)')} AS revenue FROM sales GROUP BY store_id""",
    "clean_range_counts": """
        SELECT count_if(revenue < 0)::BIGINT AS revenue_negative, count_if(abs(revenue) > 90000)::BIGINT AS revenue_too_high,
               count_if(qty < 2)::BIGINT AS qty_below_min, count_if(qty > 48)::BIGINT AS qty_above_max FROM sales""",
    "clean_date_counts": """
        SELECT count_if(date > DATE '2001-06-30')::BIGINT AS date_future_dates,
               count_if(date < DATE '1996-01-01')::BIGINT AS date_too_old_dates FROM sales""",
    "clean_iqr_outliers": f"{_bounds('qty', 'sales')} UNION ALL {_bounds('revenue', 'sales')}",
    "clean_zscore_outliers": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS outliers FROM sales, (SELECT avg({c}) AS m, stddev_pop({c}) AS s"
        f" FROM sales) q WHERE abs(({c} - m) / s) > 1.6" for c in ("qty", "revenue")),
    "clean_outlier_flags": """
        WITH q AS (SELECT quantile_cont(revenue, 0.25) AS q1, quantile_cont(revenue, 0.75) AS q3 FROM sales)
        SELECT store_id, count_if(revenue < q1 - 1.5 * (q3 - q1) OR revenue > q3 + 1.5 * (q3 - q1))::BIGINT AS outliers
        FROM sales, q GROUP BY store_id""",
    "clean_fill_dates": f"""
        WITH rows_in AS (SELECT * FROM sales), {_GAPS},
        filled AS (SELECT store_id, date, product_id, revenue, false AS is_interpolated FROM rows_in
                   UNION ALL SELECT m.store_id, m.date, product_id, revenue, true
                   FROM missing m JOIN last_rows l ON m.store_id = l.store_id)
        SELECT store_id, is_interpolated, count(*) AS sales, min(date) AS first_day, max(date) AS last_day,
               count(DISTINCT date) AS days, {money_sum('revenue')} AS revenue, max(product_id) AS last_product
        FROM filled GROUP BY ALL""",
    "clean_standard_text": """
        SELECT payment_method AS payment, count(*) AS sales, min(' a/' || product_id) AS source_file,
               min(' x' || product_id) AS sku FROM order_sales GROUP BY payment_method""",
    "clean_report": f"""
        WITH {_COPIES},
        {_FIRST}, rows_in AS (SELECT store_id, date, product_id, qty, abs(revenue) AS revenue, revenue AS raw, ingest_ord
                            FROM first_rows), {_GAPS},
        d AS (SELECT DISTINCT store_id, date, product_id, qty, revenue FROM copies),
        n AS (SELECT (SELECT count(*) FROM copies) AS a, (SELECT count(*) FROM d) AS b,
              (SELECT count(*) FROM rows_in) AS c, (SELECT count(*) FROM missing) AS f),
        facts AS (
            SELECT 'duplicates' AS "check", NULL AS "column", 'exact_removed' AS metric, CAST(a - b AS DOUBLE) AS value FROM n
            UNION ALL SELECT 'duplicates', NULL, 'fuzzy_removed', b - c FROM n
            UNION ALL SELECT 'duplicates', NULL, 'total_removed', a - c FROM n
            UNION ALL SELECT 'range_validation', 'revenue', 'negative', count_if(raw < 0) FROM rows_in
            UNION ALL SELECT 'range_validation', 'revenue', 'too_high', count_if(revenue > 90000) FROM rows_in
            UNION ALL SELECT 'range_validation', 'qty', 'below_min', count_if(qty < 2) FROM rows_in
            UNION ALL SELECT 'range_validation', 'qty', 'above_max', count_if(qty > 48) FROM rows_in
            UNION ALL SELECT 'date_validation', 'date', 'future_dates', count_if(date > DATE '2001-06-30') FROM rows_in
            UNION ALL SELECT 'date_validation', 'date', 'too_old_dates', count_if(date < DATE '1996-01-01') FROM rows_in
            UNION ALL SELECT 'outlier_detection', "column", 'iqr', outliers FROM (
                {_bounds('qty', 'rows_in')} UNION ALL {_bounds('revenue', 'rows_in')})
            UNION ALL SELECT 'missing_dates_filled', NULL, 'filled_count', f FROM n
            UNION ALL SELECT 'summary', NULL, 'initial_rows', a FROM n
            UNION ALL SELECT 'summary', NULL, 'final_rows', c + f FROM n
            UNION ALL SELECT 'summary', NULL, 'rows_removed', a - c - f FROM n
            UNION ALL SELECT 'summary', NULL, 'retention_rate', CAST(c + f AS DOUBLE) / a FROM n)
        SELECT "check", "column", metric, round(CAST(value AS DOUBLE), 6) AS value FROM facts WHERE value <> 0""",
    "clean_frame": f"""
        WITH {_COPIES},
        {_FIRST}, rows_in AS (SELECT store_id, date, product_id, qty, abs(revenue) AS revenue, ingest_ord FROM first_rows),
        {_GAPS},
        filled AS (SELECT store_id, qty, revenue FROM rows_in
                   UNION ALL SELECT m.store_id, qty, revenue FROM missing m JOIN last_rows l ON m.store_id = l.store_id)
        SELECT store_id, {_PRINT} FROM filled GROUP BY store_id""",
}
