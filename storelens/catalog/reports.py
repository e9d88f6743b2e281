"""Checks of the dashboard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.joins import join_dimension
from ..functions.materialize import checkpointed
from ..operators import aggregate as agg
from ..operators import dashboard as dash
from ..operators import spatial
from ..sources import retail_tables as rt
from . import frames as fr
from .sql import exact, money, money_sum


def _growth(spark, d):
    growth = agg.same_store_sales(fr.usd_sales(spark, d, "country"), "QoQ")
    return checkpointed(growth.select("store_id", "same_store_sales_growth"))


def _sales_with_growth(spark, d, *columns):
    """Sales carrying their store's growth, as the dashboard frame does."""
    return join_dimension(fr.usd_sales(spark, d, *columns), _growth(spark, d), ["store_id"])


def headline(spark, d):
    return fr.rounded(dash.headline_metrics(_sales_with_growth(spark, d, "economic_region")), "avg_sss_growth")


def filtered(spark, d):
    sales = dash.apply_filters(fr.usd_sales(spark, d, "economic_region", "urban_rural"),
                               {"region": "Greater China", "country": "CN", "urban_rural": "Urban", "tier": "All"})
    return sales.groupBy("economic_region", "country", "urban_rural").agg(
        F.count(F.lit(1)).alias("sales"), F.min("date").alias("first_day"))


def filter_values(spark, d):
    stores = fr.located_stores(spark, d)
    parts = [dash.filter_values(stores, c).select(F.lit(c).alias("filter"), F.col(c).alias("value"))
             for c in ("economic_region", "country", "urban_rural")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _store_rows(spark, d, *columns):
    return dash.store_map(fr.usd_sales(spark, d, *columns))


def store_map(spark, d):
    rows = dash.store_map(_sales_with_growth(
        spark, d, "latitude", "longitude", "economic_region", "nearest_city", "urban_rural"))
    return fr.rounded(rows, "latitude", "longitude", "same_store_sales_growth")


def map_center(spark, d):
    return fr.rounded(dash.map_center(rt.stores(spark, d)), "center_lat", "center_lon")


def colors(spark, d):
    """Colour by revenue band and by growth band."""
    by_revenue = _store_rows(spark, d, "country")
    by_growth = dash.store_map(_sales_with_growth(spark, d, "country"))
    a = by_revenue.select("store_id", dash.marker_color(by_revenue).alias("by_revenue"))
    return a.join(by_growth.select("store_id", dash.marker_color(by_growth).alias("by_growth")), "store_id")


def heat(spark, d):
    return fr.rounded(dash.heat_points(_store_rows(spark, d, "latitude", "longitude")), "latitude", "longitude")


def by_region(spark, d):
    return dash.revenue_by_region(fr.usd_sales(spark, d, "economic_region"))


def growth_points(spark, d):
    density = spatial.with_density(rt.stores(spark, d)).select("store_id", "stores_within_10km")
    rows = _store_rows(spark, d, "economic_region").join(_growth(spark, d), "store_id", "left")
    return dash.growth_vs_competition(join_dimension(rows, density, ["store_id"]))


def currencies(spark, d):
    return fr.rounded(dash.currency_breakdown(fr.usd_sales(spark, d)), "percentage")


def pivot(spark, d):
    return dash.region_urban_pivot(fr.usd_sales(spark, d, "economic_region", "urban_rural"))


def daily(spark, d):
    return dash.daily_revenue_with_means(fr.usd_sales(spark, d, "country"))


def daily_by_region(spark, d):
    return dash.daily_revenue_by_region(fr.usd_sales(spark, d, "economic_region"))


def ranking(spark, d):
    rows = _store_rows(spark, d, "economic_region", "nearest_city").select(
        "store_id", "economic_region", "nearest_city", "country", "revenue_usd")
    top, bottom = dash.store_ranking(rows, 10, growth=_growth(spark, d))
    return top.withColumn("side", F.lit("top")).unionByName(bottom.withColumn("side", F.lit("bottom")))


def urban(spark, d):
    return fr.rounded(dash.urban_split(fr.usd_sales(spark, d, "urban_rural")), "percentage")


def declining(spark, d):
    return fr.rounded(dash.declining_stores(_sales_with_growth(spark, d, "country")), "sss")


def per_region(spark, d):
    return dash.stores_per_region(fr.usd_sales(spark, d, "economic_region"))


QUERIES = {
    "report_headline": headline,
    "report_filtered": filtered,
    "report_filter_values": filter_values,
    "report_store_map": store_map,
    "report_map_center": map_center,
    "report_marker_colors": colors,
    "report_heat_points": heat,
    "report_revenue_by_region": by_region,
    "report_growth_vs_competition": growth_points,
    "report_currency_breakdown": currencies,
    "report_region_urban_pivot": pivot,
    "report_daily_revenue": daily,
    "report_daily_by_region": daily_by_region,
    "report_store_ranking": ranking,
    "report_urban_split": urban,
    "report_declining_stores": declining,
    "report_stores_per_region": per_region,
}

_GROWTH = f"""o AS (SELECT store_id, revenue_usd, row_number() OVER (
        PARTITION BY store_id ORDER BY date DESC, ingest_ord DESC) AS rn FROM usd_sales),
    q AS (SELECT store_id, {money_sum('CASE WHEN rn <= 90 THEN revenue_usd END')} AS c,
                 {money_sum('CASE WHEN rn > 90 AND rn <= 180 THEN revenue_usd END')} AS p, count(*) AS n
          FROM o GROUP BY store_id),
    growth AS (SELECT store_id, CASE WHEN p > 0 THEN c / p - 1 END AS g FROM q WHERE n > 90)"""
_STORE = f"store_sums AS (SELECT store_id, {money_sum('revenue_usd')} AS revenue_usd FROM usd_sales GROUP BY store_id)"

SQL = {
    "report_headline": f"""
        WITH {_GROWTH}
        SELECT {money_sum('revenue_usd')} AS total_revenue, {money_sum('revenue_usd')} / count(*) AS avg_transaction,
               count(DISTINCT store_id) AS total_stores, count(*) AS total_transactions,
               round(avg(g), 6) AS avg_sss_growth, count(DISTINCT economic_region) AS num_regions,
               count(DISTINCT original_currency) AS num_currencies
        FROM usd_sales LEFT JOIN growth USING (store_id)""",
    "report_filtered": """
        SELECT economic_region, country, urban_rural, count(*) AS sales, min(date) AS first_day FROM usd_sales
        WHERE economic_region = 'Greater China' AND country = 'CN' AND urban_rural = 'Urban' GROUP BY ALL""",
    "report_filter_values": " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS filter, {c} AS value FROM geo_stores"
        for c in ("economic_region", "country", "urban_rural")),
    "report_store_map": f"""
        WITH {_GROWTH}, {_STORE}
        SELECT s.store_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, economic_region,
               nearest_city, country, urban_rural, revenue_usd, round(g, 6) AS same_store_sales_growth
        FROM geo_stores s JOIN store_sums USING (store_id) LEFT JOIN growth USING (store_id)""",
    "report_map_center": """
        SELECT round(avg(latitude), 6) AS center_lat, round(avg(longitude), 6) AS center_lon FROM stores""",
    "report_marker_colors": f"""
        WITH {_GROWTH}, {_STORE}
        SELECT store_id, CASE WHEN revenue_usd > 1000000 THEN '#22c55e' WHEN revenue_usd > 500000 THEN '#3b82f6'
                   WHEN revenue_usd > 100000 THEN '#f59e0b' ELSE '#ef4444' END AS by_revenue,
               CASE WHEN g IS NULL THEN '#969696' WHEN g > 0.10 THEN '#22c55e' WHEN g > 0 THEN '#3b82f6'
                    WHEN g > -0.05 THEN '#f59e0b' ELSE '#ef4444' END AS by_growth
        FROM store_sums LEFT JOIN growth USING (store_id)""",
    "report_heat_points": f"""
        WITH {_STORE} SELECT round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
               revenue_usd / 1000 AS weight FROM stores JOIN store_sums USING (store_id)""",
    "report_revenue_by_region": f"""
        SELECT economic_region, {money_sum('revenue_usd')} AS revenue FROM usd_sales GROUP BY economic_region""",
    "report_growth_vs_competition": f"""
        WITH {_GROWTH}, {_STORE}
        SELECT store_id, economic_region, stores_within_10km AS nearby_competitors, g AS same_store_sales_growth,
               revenue_usd AS revenue, g < 0 AS below_zero_growth, stores_within_10km > 5 AS high_competition
        FROM geo_stores JOIN store_sums USING (store_id) JOIN density USING (store_id)
             LEFT JOIN growth USING (store_id)""",
    "report_currency_breakdown": f"""
        WITH c AS (SELECT original_currency, {money_sum('revenue_usd')} AS revenue, count(DISTINCT store_id) AS stores
                   FROM usd_sales GROUP BY original_currency)
        SELECT original_currency, revenue, stores,
               round(revenue / (SELECT sum(revenue) FROM c) * 100, 6) AS percentage FROM c""",
    "report_region_urban_pivot": "SELECT economic_region, " + ", ".join(
        "coalesce({}, 0) AS \"{}\"".format(money_sum(f"CASE WHEN urban_rural = '{c}' THEN revenue_usd END"), c)
        for c in ("Urban", "Suburban", "Rural", "Remote")) + " FROM usd_sales GROUP BY economic_region",
    "report_daily_revenue": f"""
        WITH t AS (SELECT date, {money_sum('revenue_usd')} AS revenue FROM usd_sales GROUP BY date)
        SELECT date, revenue, {money(f"sum({exact('revenue')}) OVER a")} / count(*) OVER a AS ma_7,
               {money(f"sum({exact('revenue')}) OVER b")} / count(*) OVER b AS ma_30
        FROM t WINDOW a AS (ORDER BY date ROWS 6 PRECEDING), b AS (ORDER BY date ROWS 29 PRECEDING)""",
    "report_daily_by_region": f"""
        SELECT date, economic_region AS region, {money_sum('revenue_usd')} AS revenue FROM usd_sales GROUP BY ALL""",
    "report_store_ranking": f"""
        WITH {_GROWTH}, {_STORE},
        r AS (SELECT store_id, economic_region, nearest_city, country, revenue_usd, g AS same_store_sales_growth,
                     row_number() OVER (ORDER BY revenue_usd DESC, store_id) AS a,
                     row_number() OVER (ORDER BY revenue_usd, store_id DESC) AS b
              FROM geo_stores JOIN store_sums USING (store_id) LEFT JOIN growth USING (store_id))
        SELECT * EXCLUDE (a, b), 'top' AS side FROM r WHERE a <= 10
        UNION ALL SELECT * EXCLUDE (a, b), 'bottom' FROM r WHERE b <= 10""",
    "report_urban_split": f"""
        WITH c AS (SELECT urban_rural, {money_sum('revenue_usd')} AS revenue FROM usd_sales GROUP BY urban_rural)
        SELECT urban_rural, revenue, round(revenue / (SELECT sum(revenue) FROM c) * 100, 6) AS percentage FROM c""",
    "report_declining_stores": f"""
        WITH {_GROWTH}, {_STORE} SELECT store_id, round(g, 6) AS sss, revenue_usd AS revenue
        FROM store_sums JOIN growth USING (store_id) WHERE g < -0.05""",
    "report_stores_per_region": """
        SELECT economic_region, count(DISTINCT store_id) AS stores FROM usd_sales GROUP BY economic_region
        ORDER BY economic_region LIMIT 5""",
}
