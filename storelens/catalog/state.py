"""Checks of state, dead letters, loads, staging reads and the transform chain."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.materialize import checkpointed, ensure_checkpoint_dir
from ..functions.money import money_sum as msum
from ..operators import clean, kpi, loads, state
from ..plans import transform as tf
from ..sources import retail_tables as rt
from ..sources.tables import Warehouse
from . import frames as fr
from .cleaning import _COPIES, _FIRST, _GAPS
from .kpis import SQL as KPI_SQL
from .sql import exact, money, money_sum, ratio


def _file_events(spark, d):
    """Extraction events from orders: one file per order, its status from the order's."""
    o = rt.table(spark, d, "orders")
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    file_hash = F.concat(F.lit("hash-"), (key % 997).cast("string"))
    store = F.concat(F.lit("store_"), (key % 23).cast("string"))
    none = F.lit(None).cast("string")
    minutes = F.make_interval(mins=(key % 600).cast("int"))
    begun = o.select(
        file_hash.alias("file_hash"), F.concat(F.lit("f"), key.cast("string")).alias("file_path"),
        F.concat(F.lit("store_"), (key % 997 % 23).cast("string")).alias("store_id"),
        F.lit(state.IN_PROGRESS).alias("status"), (at.cast("timestamp") + minutes).alias("event_ts"))
    ended = o.where(F.col("o_orderstatus").isin("F", "O")).select(
        file_hash.alias("file_hash"), F.lit(None).cast("string").alias("file_path"), none.alias("store_id"),
        F.when(F.col("o_orderstatus") == "F", state.FAILED).otherwise(state.COMPLETED).alias("status"),
        (at.cast("timestamp") + minutes + F.make_interval(secs=(key + 1).cast("decimal(18,6)"))).alias("event_ts"))
    return begun.unionByName(ended)


def _failures(spark, d):
    """Dead letters from events, resolutions from a part of them."""
    e = rt.table(spark, d, "events")
    failures = e.select(
        F.format_string("id-%010d", "event_id").alias("failure_id"), F.col("event_type").alias("error_type"),
        F.when(F.col("user_id") % 4 > 0, F.concat(F.lit("store_"), (F.col("user_id") % 11).cast("string"))).alias("store_id"),
        F.col("ts").alias("failed_at"))
    resolved = e.where(F.col("event_id") % 3 == 0).select(
        F.format_string("id-%010d", "event_id").alias("failure_id"),
        F.explode(F.array(F.lit("FAILED"), F.lit("SUCCESS"))).alias("outcome"), "ts", "event_id")
    resolved = resolved.where((F.col("outcome") == "FAILED") | (F.col("event_id") % 2 == 0)).select(
        "failure_id", "outcome", (F.col("ts").cast("timestamp") + F.when(
            F.col("outcome") == "SUCCESS", F.make_interval(hours=F.lit(1))).otherwise(
            F.make_interval(hours=F.lit(0)))).alias("resolved_at"))
    return failures, resolved


def pending(spark, d):
    return state.pending_failures(*_failures(spark, d)).select("failure_id", "error_type", "store_id")


def failure_status(spark, d):
    return state.failure_status(*_failures(spark, d)).groupBy("error_type", "outcome").agg(
        F.count(F.lit(1)).alias("failures"))


def dead_letter_statistics(spark, d):
    return state.dead_letter_statistics(*_failures(spark, d))


def event_statistics(spark, d):
    return state.event_statistics(_file_events(spark, d))


def state_statistics(spark, d):
    return state.state_statistics(_file_events(spark, d))


def _sheets(spark, d):
    """Sheets of files: one file per store and month, one sheet per line number."""
    li = rt.table(spark, d, "lineitem")
    store = rt.store_key(F.col("l_suppkey"))
    file = F.concat_ws("/", store, F.date_format("l_shipdate", "yyyy-MM"))
    return li.groupBy(F.md5(file).alias("file_hash"), file.alias("source_file"), store.alias("store_id"),
                      F.concat(F.lit("sheet_"), (F.col("l_linenumber") % 3).cast("string")).alias("sheet_type")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.when(F.max("l_orderkey") % 9 == 0, F.lit("bad sheet")).alias("error"))


def results(spark, d):
    r = state.extraction_results(_sheets(spark, d))
    return r.groupBy("store_id", "success").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"),
        F.sum(F.size("errors")).cast("bigint").alias("errors"),
        F.max(F.concat_ws(",", "sheets_extracted")).alias("widest"))


def summary(spark, d):
    return state.batch_summary(state.extraction_results(_sheets(spark, d)))


def manifest(spark, d):
    rows = rt.sales(spark, d).select(
        F.concat_ws("/", "store_id", F.date_format("date", "yyyy")).alias("source_file"), "store_id",
        F.lit("sales").alias("sheet_type"), "product_id", "qty")
    return state.staging_manifest(rows).select(
        "source_file", "store_id", "sheet_type", "row_count", F.col("column_count").cast("bigint").alias("column_count"))


def _old_and_new(spark, d):
    stores = fr.located_stores(spark, d)
    old = loads.store_rows(stores.where(F.col("s_suppkey") % 3 > 0).withColumn("urban_rural", F.lit("OLD")))
    again = stores.unionByName(stores.withColumn("country", F.lit("ZZ")))
    new = loads.store_rows(again.where(F.col("s_suppkey") % 2 == 0), order_by="country")
    return old, new


def merged(mode):
    def query(spark, d):
        out = loads.merge_stores(*_old_and_new(spark, d), mode)
        return out.select("store_id", "country", "economic_region", "urban_rural")
    return query


def staged_read(spark, d):
    """Sales staged in two batches, an edited file in both, and read back: the newest version of each file counts."""
    wh = Warehouse(spark, f"{ensure_checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}")
    names = [c.strip().split(" ")[0] for c in tf.STAGED_SALES.split(",")]
    sales = rt.sales(spark, d).withColumns({
        "source_file": F.concat_ws("/", "store_id", F.year("date")), "extraction_date": F.col("date"),
        "sheet_type": F.lit("sales_transactions"), "ingest_ord": F.col("ingest_ord").cast("string")})
    sales = sales.select(*[c for c in names if c in sales.columns])
    for n, batch in enumerate(("b1", "b2")):
        part = sales if n else sales.where(F.year("date") % 2 == 0).withColumn("revenue", F.lit(-1.0))
        wh.append("staging", part, batch, ("sheet_type",))
        done = part.select("source_file").distinct().select(
            F.col("source_file").alias("file_hash"), F.col("source_file").alias("file_path"), F.lit(None).cast("string").alias("store_id"),
            F.lit(state.COMPLETED).alias("status"), F.lit(batch).alias("extraction_id"), F.lit(1).cast("bigint").alias("sheets_extracted"),
            F.lit(0).cast("bigint").alias("errors"), F.lit(None).cast("string").alias("error"),
            F.lit(f"2024-01-0{n + 1}").cast("timestamp").alias("event_ts"))
        wh.append("extraction_state", done, batch)
    return tf.staged_sales(wh).groupBy("date").agg(F.count(F.lit(1)).alias("sales"), msum("revenue").alias("revenue"))


def incremental_kpis(spark, d):
    """The KPI table from stored sums by day, a file per country: one file is edited and changed back, one edited twice."""
    wh = Warehouse(spark, f"{ensure_checkpoint_dir(spark)}/figures-{uuid.uuid4().hex}")
    sales = fr.usd_sales(spark, d, "country").withColumn("source_file", F.col("country"))
    names = checkpointed(sales.select("source_file").distinct())  # a row per country, read by every look
    back, twice = F.col("source_file") == "CN", F.col("source_file") == "JP"
    # (batch, files looked at, content found there, revenue extracted from it; none where the content was known)
    looks = (("b1", F.lit(True), "first", F.col("revenue_usd")), ("b2", back | twice, "edited", F.lit(-1.0)),
             ("b3", back, "first", None), ("b4", twice, "again", F.col("revenue_usd")))
    for n, (batch, which, content, revenue) in enumerate(looks):
        at, file = F.lit(f"2024-01-0{n + 1}").cast("timestamp"), F.col("source_file")
        file_hash = F.concat_ws("-", F.lit(content), file)
        seen = names.where(which)
        wh.append("file_versions", seen.select(file.alias("path"), F.lit(n + 1).cast("bigint").alias("version"), F.lit(1).cast("bigint").alias("size"),
                                               at.alias("modified"), file_hash.alias("file_hash"), at.alias("seen_at")), batch)
        if revenue is None:
            continue
        part = sales.where(which).withColumns({"revenue_usd": revenue, "staged_batch": F.lit(batch)})
        loads.load_day_sums(wh, part, f"load-{batch}")
        loads.mark_loaded(wh, seen.withColumn("staged_batch", F.lit(batch)), f"load-{batch}")
        none = F.lit(None).cast("string")
        wh.append("extraction_state", seen.select(
            file_hash.alias("file_hash"), file.alias("file_path"), none.alias("store_id"), F.lit(state.COMPLETED).alias("status"), F.lit(batch).alias("extraction_id"),
            F.lit(1).cast("bigint").alias("sheets_extracted"), F.lit(0).cast("bigint").alias("errors"), none.alias("error"), at.alias("event_ts")), batch)
    days = loads.loaded_day_sums(wh, tf.current_versions(wh))
    stores = fr.located_stores(spark, d).select("store_id", "economic_region")
    return fr.big(kpi.store_kpi_table(stores, days, fr.REFERENCE_DATE, upper_bound=True, days=True), "rank_in_region")


def transform_regional(spark, d):
    return _transformed(spark, d).regional_summary.select(
        "economic_region", "period", "revenue_sum", "revenue_count", "store_count")


def transform_cleaned(spark, d):
    return _transformed(spark, d).cleaned.groupBy("store_id", "economic_region", "country", "original_currency").agg(
        F.count(F.lit(1)).alias("sales"), msum("revenue_usd").alias("revenue_usd"),
        F.count_if("is_interpolated").alias("interpolated"))


def transform_same_store(spark, d):
    return _transformed(spark, d, copies=False).same_store_sales


def _transformed(spark, d, copies=True):
    """The chain on all sales, with later copies of some."""
    sales = rt.sales(spark, d)
    if copies:
        later = (F.col("ingest_ord") + F.expr("50000000000000000000000000000000000000BD")).cast("decimal(38,0)")
        sales = sales.unionByName(sales.where(F.col("qty") % 10 == 0).withColumn("ingest_ord", later))
    stores = rt.stores(spark, d).select("store_id", "country", "latitude", "longitude")
    return tf.transform(sales.join(stores, "store_id"))


QUERIES = {
    "state_pending_failures": pending,
    "state_failure_status": failure_status,
    "state_dead_letter_statistics": dead_letter_statistics,
    "state_event_statistics": event_statistics,
    "state_file_statistics": state_statistics,
    "state_extraction_results": results,
    "state_batch_summary": summary,
    "state_staging_manifest": manifest,
    "load_stores_upsert": merged("upsert"),
    "load_stores_append": merged("append"),
    "load_stores_replace": merged("replace"),
    "staged_sales_by_day": staged_read,
    "load_incremental_kpis": incremental_kpis,
    "transform_regional": transform_regional,
    "transform_cleaned": transform_cleaned,
    "transform_same_store": transform_same_store,
}

_EVENTS = """
    ev AS (SELECT 'hash-' || (o_orderkey % 997) AS file_hash, 'store_' || (o_orderkey % 997 % 23) AS store_id,
                  'IN_PROGRESS' AS status, 0 AS k,
                  o_orderdate + to_minutes(CAST(o_orderkey % 600 AS INTEGER)) AS event_ts FROM orders
           UNION ALL SELECT 'hash-' || (o_orderkey % 997), NULL,
                  CASE o_orderstatus WHEN 'F' THEN 'FAILED' ELSE 'COMPLETED' END, 1,
                  o_orderdate + to_minutes(CAST(o_orderkey % 600 AS INTEGER))
                      + to_seconds(o_orderkey + 1)
           FROM orders WHERE o_orderstatus IN ('F', 'O'))"""
_LETTERS = """
    f AS (SELECT printf('id-%010d', event_id) AS failure_id, event_type AS error_type,
                 CASE WHEN user_id % 4 > 0 THEN 'store_' || (user_id % 11) END AS store_id, ts AS failed_at, event_id
          FROM events),
    st AS (SELECT *, CASE WHEN event_id % 3 = 0 AND event_id % 2 = 0 THEN 'SUCCESS' WHEN event_id % 3 = 0 THEN 'FAILED'
                     ELSE 'PENDING' END AS outcome FROM f)"""
_SHEETS = """
    sh AS (SELECT 'store_' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS store_id,
                  strftime(l_shipdate, '%Y-%m') AS m, 'sheet_' || (l_linenumber % 3) AS sheet_type,
                  count(*) AS rows, max(l_orderkey) % 9 = 0 AS bad FROM lineitem GROUP BY ALL),
    fl AS (SELECT store_id, m, NOT bool_or(bad) AS success, count_if(bad)::BIGINT AS errors,
                  CAST(coalesce(sum(rows) FILTER (NOT bad), 0) AS BIGINT) AS rows,
                  coalesce(string_agg(sheet_type, ',' ORDER BY sheet_type) FILTER (NOT bad), '') AS names
           FROM sh GROUP BY ALL)"""


def _count(status: str) -> str:
    return f"count_if(status = '{status}')::BIGINT"


_STATS = (f"{_count('COMPLETED')} AS total_processed, {_count('IN_PROGRESS')} AS in_progress,"
          f" {_count('FAILED')} AS failed")
_OLD = """old AS (SELECT store_id, country, economic_region, 'OLD' AS urban_rural FROM geo_stores WHERE s_suppkey % 3 > 0),
    new AS (SELECT store_id, country, economic_region, urban_rural FROM geo_stores WHERE s_suppkey % 2 = 0)"""
_CHAIN = f"""{_COPIES},
    {_FIRST}, rows_in AS (SELECT store_id, date, product_id, abs(revenue) AS revenue, ingest_ord FROM first_rows), {_GAPS},
    done AS (SELECT store_id, date, revenue, false AS is_interpolated FROM rows_in
             UNION ALL SELECT m.store_id, m.date, revenue, true FROM missing m JOIN last_rows l ON m.store_id = l.store_id),
    chain AS (SELECT d.*, economic_region, country, original_currency,
                     CASE WHEN original_currency = 'USD' THEN revenue ELSE revenue * usd_rate END AS revenue_usd
              FROM done d JOIN geo_stores g USING (store_id) JOIN fixed_rates f ON g.original_currency = f.currency)"""

SQL = {
    "state_pending_failures": f"""
        WITH {_LETTERS} SELECT failure_id, error_type, store_id FROM st WHERE outcome = 'PENDING'
        ORDER BY failed_at, failure_id LIMIT 100""",
    "state_failure_status": f"""
        WITH {_LETTERS} SELECT error_type, outcome, count(*) AS failures FROM st GROUP BY ALL""",
    "state_dead_letter_statistics": f"""
        WITH {_LETTERS}
        SELECT 'total' AS dimension, 'all' AS value, count(*) AS entries FROM st
        UNION ALL SELECT 'error_type', error_type, count(*) FROM st GROUP BY error_type
        UNION ALL SELECT 'store', coalesce(store_id, 'Unknown'), count(*) FROM st GROUP BY store_id
        UNION ALL SELECT 'state', CASE outcome WHEN 'PENDING' THEN 'pending' ELSE 'resolved' END AS s, count(*)
        FROM st GROUP BY s""",
    "state_event_statistics": f"WITH {_EVENTS} SELECT {_STATS} FROM ev",
    "state_file_statistics": f"""
        WITH {_EVENTS}, cur AS (SELECT file_hash, arg_max(status, (event_ts, k)) AS status, max(store_id) AS store_id
                                FROM ev GROUP BY file_hash)
        SELECT store_id, {_STATS} FROM cur GROUP BY store_id""",
    "state_extraction_results": f"""
        WITH {_SHEETS} SELECT store_id, success, count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows,
            CAST(sum(errors) AS BIGINT) AS errors, max(names) AS widest FROM fl GROUP BY ALL""",
    "state_batch_summary": f"""
        WITH {_SHEETS} SELECT count(*) AS files, count_if(success)::BIGINT AS succeeded,
            count_if(NOT success)::BIGINT AS failed, CAST(sum(rows) AS BIGINT) AS rows FROM fl""",
    "state_staging_manifest": """
        SELECT store_id || '/' || strftime(date, '%Y') AS source_file, store_id, 'sales' AS sheet_type,
               count(*) AS row_count, CAST(5 AS BIGINT) AS column_count FROM sales GROUP BY ALL""",
    "load_stores_upsert": f"""
        WITH {_OLD} SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (store_id)""",
    "load_stores_append": f"""
        WITH {_OLD} SELECT * FROM old UNION ALL SELECT * FROM new ANTI JOIN old USING (store_id)""",
    "load_stores_replace": f"WITH {_OLD} SELECT * FROM new",
    "staged_sales_by_day": f"""
        SELECT date, count(*) AS sales, {money_sum('revenue')} AS revenue FROM sales GROUP BY date""",
    "load_incremental_kpis": KPI_SQL["kpi_table"],
    "transform_regional": f"""
        WITH {_CHAIN} SELECT economic_region, last_day(date) AS period, {money_sum('revenue_usd')} AS revenue_sum,
            count(*) AS revenue_count, count(DISTINCT store_id) AS store_count FROM chain GROUP BY ALL""",
    "transform_cleaned": f"""
        WITH {_CHAIN} SELECT store_id, economic_region, country, original_currency, count(*) AS sales,
            {money_sum('revenue_usd')} AS revenue_usd, count_if(is_interpolated)::BIGINT AS interpolated
        FROM chain GROUP BY ALL""",
    "transform_same_store": f"""
        WITH one AS (SELECT *, row_number() OVER (PARTITION BY store_id, date, product_id ORDER BY ingest_ord) AS k
                     FROM usd_sales),
        o AS (SELECT store_id, abs(revenue_usd) AS revenue_usd, row_number() OVER (
                  PARTITION BY store_id ORDER BY date DESC, ingest_ord DESC) AS rn FROM one WHERE k = 1),
        s AS (SELECT store_id, {money_sum('CASE WHEN rn <= 365 THEN revenue_usd END')} AS c,
                     {money_sum('CASE WHEN rn > 365 AND rn <= 730 THEN revenue_usd END')} AS p, count(*) AS n
              FROM o GROUP BY store_id)
        SELECT store_id, CASE WHEN p > 0 THEN c / p - 1 END AS same_store_sales_growth, c AS current_revenue,
               p AS prior_revenue, 'YoY' AS comparison_period FROM s WHERE n > 365""",
}
