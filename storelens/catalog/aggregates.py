"""Checks of the regional aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.joins import join_dimension
from ..operators import aggregate as agg
from ..operators import spatial
from ..sources import retail_tables as rt
from . import frames as fr
from .sql import money, money_sum, ratio, exact

YEAR = (dt.date(1999, 1, 1), dt.date(1999, 12, 31))


def _series(df, **options):
    return agg.aggregate_by_region(df, **options)


def by_period(period):
    def query(spark, d):
        return _series(fr.usd_sales(spark, d, "economic_region"), period=period)
    return query


def sparse_weeks(spark, d):
    """Weekly rows per store, where whole weeks may be empty."""
    return _series(fr.usd_sales(spark, d, "country"), group_by="store_id", period="W", yoy_lag=2)


def same_store(period, by="rows"):
    def query(spark, d):
        return agg.same_store_sales(fr.usd_sales(spark, d, "country"), period, by=by)
    return query


def penetration(spark, d):
    sales = fr.usd_sales(spark, d, "economic_region", "gdp_per_capita_usd")
    return agg.market_penetration(sales)


def concentration(spark, d):
    return fr.rounded(agg.herfindahl_index(rt.sales(spark, d), "store_id", "revenue"), "hhi")


def concentration_by_region(spark, d):
    sales = fr.usd_sales(spark, d, "economic_region")
    return fr.rounded(agg.herfindahl_index(sales, "store_id", "revenue_usd", within=["economic_region"]), "hhi")


def exposure(spark, d):
    return fr.rounded(agg.currency_exposure(fr.usd_sales(spark, d)), "percentage_of_total")


def summary(spark, d):
    """Region totals with concentration and competition index."""
    stores = spatial.with_density(rt.stores(spark, d)).select("store_id", "stores_within_10km")
    sales = join_dimension(fr.usd_sales(spark, d, "economic_region"), stores, ["store_id"])
    return fr.rounded(agg.region_totals(sales), "market_concentration_hhi")


def best_and_worst(spark, d):
    places = agg.best_and_worst_stores(agg.region_store_totals(fr.usd_sales(spark, d, "economic_region")))
    return fr.big(places, "place")


def split(column):
    def query(spark, d):
        return agg.revenue_split(fr.usd_sales(spark, d, "economic_region", "urban_rural"), column)
    return query


def full_summary(spark, d):
    """The nested record, its lists and maps as text."""
    out = agg.full_regional_summary(fr.usd_sales(spark, d, "economic_region", "urban_rural"), *YEAR)
    return out.select(
        "economic_region", "period_start", "period_end", "total_revenue_usd", "total_stores", "total_transactions",
        F.concat_ws(",", "top_performing_stores").alias("top_stores"),
        F.concat_ws(",", "bottom_performing_stores").alias("bottom_stores"),
        F.concat_ws(",", F.map_keys("currency_exposure")).alias("currencies"),
        F.round(F.aggregate(F.map_values("currency_exposure"), F.lit(0.0), lambda a, x: a + x), 2).alias("exposure"),
        F.try_element_at("urban_rural_split", F.lit("Urban")).alias("urban_revenue"))


QUERIES = {
    "region_monthly": by_period("M"),
    "region_weekly": by_period("W"),
    "region_quarterly": by_period("Q"),
    "store_weekly_with_gaps": sparse_weeks,
    "same_store_yoy": same_store("YoY"),
    "same_store_qoq": same_store("QoQ"),
    "same_store_mom": same_store("MoM"),
    "same_store_yoy_days": same_store("YoY", "days"),
    "market_penetration": penetration,
    "concentration_index": concentration,
    "concentration_by_region": concentration_by_region,
    "currency_exposure": exposure,
    "region_summary_totals": summary,
    "region_best_worst_stores": best_and_worst,
    "region_currency_split": split("original_currency"),
    "region_urban_split": split("urban_rural"),
    "region_full_summary": full_summary,
}

_END = {
    "M": "last_day({0})",
    "W": "CAST(date_trunc('week', {0}) AS DATE) + 6",
    "Q": "last_day(CAST(date_trunc('quarter', {0}) AS DATE) + INTERVAL 2 MONTH)",
}
_STEP = {
    "M": "SELECT last_day(unnest(generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH)))",
    "W": "SELECT CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE)",
    "Q": "SELECT last_day(unnest(generate_series(date_trunc('month', a), b, INTERVAL 3 MONTH)))",
}


def _series_sql(key: str, source: str, period: str, lag: int) -> str:
    step = _STEP[period].replace("SELECT ", "")
    return f"""
        WITH src AS ({source}),
        t AS (SELECT {key}, {_END[period].format('date')} AS period, sum({exact('revenue_usd')}) AS s,
                     count(*) AS n, count(DISTINCT store_id) AS stores FROM src GROUP BY ALL),
        span AS (SELECT {key}, min(period) AS a, max(period) AS b FROM t GROUP BY ALL),
        cal AS (SELECT {key}, {step} AS period FROM span),
        f AS (SELECT {key}, CAST(period AS DATE) AS period, {money('coalesce(s, 0)')} AS revenue_sum,
                     coalesce({ratio(money('s'), 'n')}, 0) AS mean, coalesce(n, 0) AS revenue_count,
                     coalesce(stores, 0) AS store_count
              FROM cal LEFT JOIN t USING ({key}, period))
        SELECT {key}, period, revenue_sum, mean AS revenue_mean, revenue_count, store_count,
               {ratio('revenue_sum', 'lag(revenue_sum) OVER w')} - 1 AS revenue_growth_mom,
               {ratio('revenue_sum', f'lag(revenue_sum, {lag}) OVER w')} - 1 AS revenue_growth_yoy
        FROM f WINDOW w AS (PARTITION BY {key} ORDER BY period)"""


def _same_store_sql(n: int, label: str) -> str:
    return f"""
        WITH o AS (SELECT store_id, revenue_usd, row_number() OVER (
                       PARTITION BY store_id ORDER BY date DESC, ingest_ord DESC) AS rn FROM usd_sales),
        s AS (SELECT store_id, {money_sum(f'CASE WHEN rn <= {n} THEN revenue_usd END')} AS c,
                     {money_sum(f'CASE WHEN rn > {n} AND rn <= {2 * n} THEN revenue_usd END')} AS p, count(*) AS rows
              FROM o GROUP BY store_id)
        SELECT store_id, CASE WHEN p > 0 THEN c / p - 1 END AS same_store_sales_growth,
               c AS current_revenue, p AS prior_revenue, '{label}' AS comparison_period
        FROM s WHERE rows > {n}"""


_YEAR = "date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'"
_REGION_STORES = f"""rs AS (SELECT economic_region, store_id, sum({exact('revenue_usd')}) AS t, count(*) AS n,
    min(date) AS a, max(date) AS b FROM usd_sales GROUP BY ALL)"""
_REGION_STORES_YEAR = _REGION_STORES.replace("GROUP BY ALL", f"WHERE {_YEAR} GROUP BY ALL")
_HHI = "sum(CAST(t AS DOUBLE) * CAST(t AS DOUBLE)) / (sum(CAST(t AS DOUBLE)) * sum(CAST(t AS DOUBLE))) * 10000"
_PLACES = """places AS (
    SELECT economic_region, store_id, CAST(round(t, 4) AS DOUBLE) AS revenue_usd,
           row_number() OVER (PARTITION BY economic_region ORDER BY CAST(round(t, 4) AS DOUBLE) DESC, store_id) AS top,
           row_number() OVER (PARTITION BY economic_region ORDER BY CAST(round(t, 4) AS DOUBLE), store_id) AS bottom
    FROM rs)"""


def _split_sql(column: str) -> str:
    return (f"SELECT economic_region, {column}, {money_sum('revenue_usd')} AS revenue_usd"
            " FROM usd_sales GROUP BY ALL")


SQL = {
    "region_monthly": _series_sql("economic_region", "SELECT * FROM usd_sales", "M", 12),
    "region_weekly": _series_sql("economic_region", "SELECT * FROM usd_sales", "W", 4),
    "region_quarterly": _series_sql("economic_region", "SELECT * FROM usd_sales", "Q", 4),
    "store_weekly_with_gaps": _series_sql(
        "store_id", "SELECT * FROM usd_sales", "W", 2).replace("count(DISTINCT store_id)", "CAST(1 AS BIGINT)"),
    "same_store_yoy": _same_store_sql(365, "YoY"),
    "same_store_qoq": _same_store_sql(90, "QoQ"),
    "same_store_mom": _same_store_sql(30, "MoM"),
    "same_store_yoy_days": f"""
        WITH l AS (SELECT store_id, max(date) AS last FROM usd_sales GROUP BY store_id),
        a AS (SELECT store_id, revenue_usd, last - date AS age FROM usd_sales JOIN l USING (store_id)),
        s AS (SELECT store_id, {money_sum('CASE WHEN age < 365 THEN revenue_usd END')} AS c,
                     {money_sum('CASE WHEN age >= 365 THEN revenue_usd END')} AS p,
                     count_if(age >= 365) AS prior_rows FROM a WHERE age < 730 GROUP BY store_id)
        SELECT store_id, CASE WHEN p > 0 THEN c / p - 1 END AS same_store_sales_growth,
               c AS current_revenue, p AS prior_revenue, 'YoY' AS comparison_period FROM s WHERE prior_rows > 0""",
    "market_penetration": f"""
        WITH p AS (SELECT economic_region, country, {money_sum('revenue_usd')} AS total,
                          count(DISTINCT store_id) AS stores, count(*) AS n, max(gdp_per_capita_usd) AS gdp
                   FROM usd_sales GROUP BY ALL)
        SELECT economic_region, country, total AS total_revenue_usd, stores AS store_count, gdp AS gdp_per_capita,
               total / n AS avg_revenue_per_store, total / n AS avg_transaction_value,
               total / stores AS revenue_per_store, total / n / gdp AS revenue_to_gdp_ratio FROM p""",
    "concentration_index": f"""
        WITH m AS (SELECT store_id, sum({exact('revenue')}) AS t FROM sales GROUP BY store_id)
        SELECT round({_HHI}, 6) AS hhi, count(*) AS members FROM m""",
    "concentration_by_region": f"""
        WITH m AS (SELECT economic_region, store_id, sum({exact('revenue_usd')}) AS t FROM usd_sales GROUP BY ALL)
        SELECT economic_region, round({_HHI}, 6) AS hhi, count(*) AS members FROM m GROUP BY economic_region""",
    "currency_exposure": f"""
        WITH e AS (SELECT original_currency, {money_sum('revenue_usd')} AS revenue_usd, count(*) AS n
                   FROM usd_sales GROUP BY original_currency)
        SELECT original_currency, revenue_usd, n AS transaction_count, revenue_usd / n AS avg_transaction,
               round(revenue_usd / (SELECT sum(revenue_usd) FROM e) * 100, 6) AS percentage_of_total,
               original_currency IN ('IDR', 'INR', 'PHP', 'VND', 'THB') AS high_volatility FROM e""",
    "region_summary_totals": f"""
        WITH {_REGION_STORES}
        SELECT economic_region, min(a) AS period_start, max(b) AS period_end, {money('sum(t)')} AS total_revenue_usd,
               count(*) AS total_stores, CAST(sum(n) AS BIGINT) AS total_transactions,
               {money('sum(t)')} / count(*) AS avg_revenue_per_store,
               {money('sum(t)')} / sum(n) AS avg_transaction_value,
               CAST(sum(stores_within_10km * n) AS DOUBLE) / sum(n) AS competition_index,
               round(CASE WHEN count(*) > 1 THEN {_HHI} ELSE 10000 END, 6) AS market_concentration_hhi
        FROM rs JOIN density USING (store_id) GROUP BY economic_region""",
    "region_best_worst_stores": f"""
        WITH {_REGION_STORES}, {_PLACES}
        SELECT economic_region, store_id, revenue_usd, 'top' AS side, top AS place FROM places WHERE top <= 5
        UNION ALL SELECT economic_region, store_id, revenue_usd, 'bottom', bottom FROM places WHERE bottom <= 5""",
    "region_currency_split": _split_sql("original_currency"),
    "region_urban_split": _split_sql("urban_rural"),
    "region_full_summary": f"""
        WITH {_REGION_STORES_YEAR}, {_PLACES},
        lists AS (SELECT economic_region, string_agg(store_id, ',' ORDER BY top) FILTER (top <= 5) AS top_stores,
                         string_agg(store_id, ',' ORDER BY bottom) FILTER (bottom <= 5) AS bottom_stores
                  FROM places GROUP BY economic_region),
        ccy AS (SELECT economic_region, original_currency, {money_sum('revenue_usd')} AS v FROM usd_sales
                WHERE {_YEAR} GROUP BY ALL),
        maps AS (SELECT economic_region, string_agg(original_currency, ',' ORDER BY original_currency) AS currencies,
                        round(sum(v), 2) AS exposure FROM ccy GROUP BY economic_region),
        urban AS (SELECT economic_region, {money_sum('revenue_usd')} AS urban_revenue FROM usd_sales
                  WHERE {_YEAR} AND urban_rural = 'Urban' GROUP BY economic_region)
        SELECT economic_region, DATE '1999-01-01' AS period_start, DATE '1999-12-31' AS period_end,
               {money('sum(t)')} AS total_revenue_usd, count(*) AS total_stores, CAST(sum(n) AS BIGINT) AS total_transactions,
               any_value(top_stores) AS top_stores, any_value(bottom_stores) AS bottom_stores,
               any_value(currencies) AS currencies, any_value(exposure) AS exposure,
               any_value(urban_revenue) AS urban_revenue
        FROM rs JOIN lists USING (economic_region) JOIN maps USING (economic_region)
             LEFT JOIN urban USING (economic_region) GROUP BY economic_region""",
}
