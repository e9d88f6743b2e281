"""Checks of the currency operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import dimensions as dim
from ..functions.joins import join_dimension
from ..functions.money import money_sum as msum
from ..operators import fx
from ..sources import retail_tables as rt
from . import frames as fr
from .sql import money_sum


def _sales(spark, d):
    stores = rt.stores(spark, d).select("store_id", "country")
    return join_dimension(rt.sales(spark, d), stores, ["store_id"], "inner")


def order_day_rates(spark, d):
    """Rates with holes: some order days per currency, moved around the fixed rate in millionths."""
    days = rt.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("rate_date")).distinct()
    number = F.datediff("rate_date", F.lit("1990-01-01").cast("date"))
    rates = F.array(*[
        F.struct(F.lit(c).alias("currency"), F.lit(i).alias("i"), F.lit(round(rate * 1e6)).alias("micro"))
        for i, (c, rate) in enumerate(dim.FALLBACK_USD_RATES) if c not in ("USD", "NZD", "MYR")])
    return (days.withColumn("n", number).select("rate_date", "n", F.inline(rates))
            .where((F.col("n") + F.col("i")) % 7 < 2)
            .select("currency", "rate_date",
                    (F.floor(F.col("micro") * (900 + F.col("n") % 200) / 1000) / 1000000.0).alias("usd_rate")))


def row_currency(spark, d):
    return fx.normalize(_sales(spark, d)).groupBy("original_currency", "country").agg(
        F.count(F.lit(1)).alias("sales"))


def row_currency_column(spark, d):
    """A currency column of the sales wins over the country."""
    own = F.when(F.col("qty") % 5 == 0, F.lit(None)).when(F.col("qty") % 2 == 0, "EUR").otherwise("JPY")
    out = fx.normalize(_sales(spark, d).withColumn("ccy", own), currency_column="ccy")
    return out.groupBy("original_currency", "rate_source").agg(
        F.count(F.lit(1)).alias("sales"), msum("revenue_usd").alias("revenue_usd"))


def usd_amounts(spark, d):
    return fx.normalize(_sales(spark, d)).groupBy("store_id", "original_currency").agg(
        msum("revenue_usd").alias("revenue_usd"), F.round(F.min("revenue_usd"), 6).alias("lowest"))


def reporting_amounts(spark, d):
    out = fx.normalize(_sales(spark, d), reporting="SGD")
    return out.groupBy("store_id").agg(
        F.round(F.min("revenue_sgd"), 4).alias("lowest"), F.round(F.max("revenue_sgd"), 4).alias("highest"),
        F.round(F.avg("revenue_sgd"), 4).alias("mean"))


def rate_used(spark, d):
    return fx.normalize(_sales(spark, d)).select(
        "original_currency", "exchange_rate_usd", "rate_source").distinct()


def dated_amounts(spark, d):
    out = fx.normalize(_sales(spark, d), rates=order_day_rates(spark, d))
    return out.groupBy("store_id", "rate_source").agg(
        F.count(F.lit(1)).alias("sales"), msum("revenue_usd").alias("revenue_usd"),
        F.min("exchange_rate_usd").alias("lowest_rate"), F.max("exchange_rate_usd").alias("highest_rate"))


def ranked_sources(spark, d):
    """Two sources with gaps of weeks: the second covers part of what the first leaves out."""
    rates, number = order_day_rates(spark, d), F.datediff("rate_date", F.lit("1990-01-01").cast("date"))
    market = rates.where(F.floor(number / 60) % 3 != 0)
    bank = rates.where(F.floor(number / 45) % 4 != 1).withColumn("usd_rate", F.col("usd_rate") * 1.01)
    return [("market", market), ("bank", bank)]


def chained_amounts(spark, d):
    """Amounts by the first source that covers a day, crossed into SGD by the same chain."""
    out = fx.normalize(_sales(spark, d), sources=ranked_sources(spark, d), tolerance_days=2, reporting="SGD")
    return out.groupBy("store_id", "rate_source", "target_rate_source").agg(
        F.count(F.lit(1)).alias("sales"), msum("revenue_usd").alias("revenue_usd"),
        F.min("exchange_rate_usd").alias("lowest_rate"), F.max("exchange_rate_usd").alias("highest_rate"),
        msum("revenue_sgd").alias("revenue_sgd"))


def fixed_rates(spark, d):
    """Rates between each store's currency and the reporting currencies."""
    stores = rt.stores(spark, d).select("store_id", fx.country_currency(F.col("country")).alias("source"))
    targets = F.explode(F.array(*[F.lit(c) for c in (*dim.REPORTING_CURRENCIES, "EUR")])).alias("target")
    return stores.select("store_id", "source", targets).withColumn(
        "rate", F.round(fx.fallback_rate(F.col("source"), F.col("target")), 9))


QUERIES = {
    "fx_row_currency": row_currency,
    "fx_currency_column": row_currency_column,
    "fx_usd_amounts": usd_amounts,
    "fx_reporting_amounts": reporting_amounts,
    "fx_rate_used": rate_used,
    "fx_dated_amounts": dated_amounts,
    "fx_chained_amounts": chained_amounts,
    "fx_fixed_rates": fixed_rates,
}

_MICRO = ", ".join(f"('{c}', {i}, {round(rate * 1e6)})" for i, (c, rate) in enumerate(dim.FALLBACK_USD_RATES)
                   if c not in ("USD", "NZD", "MYR"))

SQL = {
    "fx_row_currency": """
        SELECT original_currency, country, count(*) AS sales FROM usd_sales GROUP BY ALL""",
    "fx_currency_column": f"""
        WITH s AS (SELECT revenue, CASE WHEN qty % 5 = 0 THEN NULL WHEN qty % 2 = 0 THEN 'EUR' ELSE 'JPY' END
                   AS original_currency FROM sales)
        SELECT original_currency, CASE WHEN original_currency = 'JPY' THEN 'fallback' ELSE 'unknown' END AS rate_source,
               count(*) AS sales,
               {money_sum("CASE WHEN original_currency = 'JPY' THEN revenue * 0.0067::DOUBLE ELSE revenue END")}
                   AS revenue_usd
        FROM s GROUP BY original_currency""",
    "fx_usd_amounts": f"""
        SELECT store_id, original_currency, {money_sum('revenue_usd')} AS revenue_usd,
               round(min(revenue_usd), 6) AS lowest
        FROM usd_sales GROUP BY ALL""",
    "fx_reporting_amounts": """
        WITH s AS (SELECT store_id, CASE WHEN original_currency = 'SGD' THEN revenue
                   ELSE revenue * (exchange_rate_usd / 0.74::DOUBLE) END AS v FROM usd_sales)
        SELECT store_id, round(min(v), 4) AS lowest, round(max(v), 4) AS highest, round(avg(v), 4) AS mean
        FROM s GROUP BY store_id""",
    "fx_rate_used": """
        SELECT DISTINCT original_currency, exchange_rate_usd, 'fallback' AS rate_source FROM usd_sales""",
    "fx_dated_amounts": f"""
        WITH micro AS (SELECT * FROM (VALUES {_MICRO}) t(currency, i, micro)),
        days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders),
        rates AS (SELECT currency, rate_date,
                      floor(micro * (900 + n % 200) / 1000) / 1000000.0::DOUBLE AS usd_rate
                  FROM (SELECT *, date_diff('day', DATE '1990-01-01', rate_date) AS n FROM days) CROSS JOIN micro
                  WHERE (n + i) % 7 < 2),
        earliest AS (SELECT currency, arg_min(usd_rate, rate_date) AS first_rate FROM rates GROUP BY currency),
        priced AS (SELECT s.*, coalesce(r.usd_rate, e.first_rate) AS dated
                   FROM usd_sales s ASOF LEFT JOIN rates r
                        ON s.original_currency = r.currency AND s.date >= r.rate_date
                   LEFT JOIN earliest e ON s.original_currency = e.currency),
        used AS (SELECT *, coalesce(dated, exchange_rate_usd) AS rate,
                        CASE WHEN dated IS NULL THEN 'fallback' ELSE 'dated' END AS rate_source FROM priced)
        SELECT store_id, rate_source, count(*) AS sales,
               {money_sum("CASE WHEN original_currency = 'USD' THEN revenue ELSE revenue * rate END")} AS revenue_usd,
               min(rate) AS lowest_rate, max(rate) AS highest_rate
        FROM used GROUP BY store_id, rate_source""",
    "fx_chained_amounts": f"""
        WITH micro AS (SELECT * FROM (VALUES {_MICRO}) t(currency, i, micro)),
        days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders),
        rates AS (SELECT currency, rate_date, n, floor(micro * (900 + n % 200) / 1000) / 1000000.0::DOUBLE AS usd_rate
                  FROM (SELECT *, date_diff('day', DATE '1990-01-01', rate_date) AS n FROM days) CROSS JOIN micro
                  WHERE (n + i) % 7 < 2),
        sources AS (SELECT 0 AS rank, 'market' AS source, currency, rate_date, usd_rate FROM rates WHERE (n // 60) % 3 <> 0
                    UNION ALL
                    SELECT 1, 'bank', currency, rate_date, usd_rate * 1.01::DOUBLE FROM rates WHERE (n // 45) % 4 <> 1),
        needed AS (SELECT DISTINCT original_currency AS currency, CAST(date AS DATE) AS day FROM usd_sales
                   UNION SELECT DISTINCT 'SGD', CAST(date AS DATE) FROM usd_sales),
        chosen AS (SELECT currency, day, usd_rate, source
                   FROM needed JOIN sources USING (currency) WHERE abs(date_diff('day', rate_date, day)) <= 2
                   QUALIFY row_number() OVER (PARTITION BY currency, day
                                              ORDER BY rank, abs(date_diff('day', rate_date, day)), rate_date) = 1),
        used AS (SELECT s.store_id, s.original_currency, s.revenue, coalesce(r.usd_rate, s.exchange_rate_usd) AS rate,
                        coalesce(r.source, 'fallback') AS rate_source, coalesce(t.usd_rate, 0.74::DOUBLE) AS target,
                        coalesce(t.source, 'fallback') AS target_rate_source
                 FROM usd_sales s LEFT JOIN chosen r ON s.original_currency = r.currency AND CAST(s.date AS DATE) = r.day
                 LEFT JOIN chosen t ON t.currency = 'SGD' AND CAST(s.date AS DATE) = t.day)
        SELECT store_id, rate_source, target_rate_source, count(*) AS sales,
               {money_sum("CASE WHEN original_currency = 'USD' THEN revenue ELSE revenue * rate END")} AS revenue_usd,
               min(rate) AS lowest_rate, max(rate) AS highest_rate,
               {money_sum("CASE WHEN original_currency = 'SGD' THEN revenue ELSE revenue * (rate / target) END")} AS revenue_sgd
        FROM used GROUP BY store_id, rate_source, target_rate_source""",
    "fx_fixed_rates": """
        WITH t(target) AS (VALUES ('USD'), ('SGD'), ('HKD'), ('JPY'), ('EUR')),
        pairs AS (SELECT store_id, original_currency AS source, target, f.usd_rate AS a,
                         coalesce(g.usd_rate, 1.0) AS b
                  FROM geo_stores CROSS JOIN t JOIN fixed_rates f ON original_currency = f.currency
                  LEFT JOIN fixed_rates g ON target = g.currency)
        SELECT store_id, source, target,
               round(CASE WHEN source = target THEN 1.0::DOUBLE ELSE a / b END, 9) AS rate FROM pairs""",
}
