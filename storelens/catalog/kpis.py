"""Checks of the store KPIs and the query surface over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.materialize import checkpointed
from ..operators import kpi, lookup, spatial
from ..sources import retail_tables as rt
from . import frames as fr
from .sql import exact, money, money_sum, ratio

REF = fr.REFERENCE_DATE


def kpi_table(spark, d):
    stores = fr.located_stores(spark, d).select("store_id", "economic_region")
    return fr.big(kpi.store_kpi_table(stores, fr.usd_sales(spark, d, "country"), REF, upper_bound=True),
                  "rank_in_region")


def kpi_table_open(spark, d):
    """Without an upper date, the default: month and year run to the newest sale."""
    stores = fr.located_stores(spark, d).select("store_id", "economic_region")
    return fr.big(kpi.store_kpi_table(stores, fr.usd_sales(spark, d, "country"), REF), "rank_in_region")


def _records(spark, d):
    stores = spatial.with_density(fr.located_stores(spark, d))
    records = kpi.calculate_store_kpis(fr.usd_sales(spark, d, "country"), REF, stores=stores, upper_bound=True)
    return checkpointed(records)


def _flat(df):
    out = df.withColumn("alert_flags", F.concat_ws(",", "alert_flags"))
    return fr.rounded(out, "latitude", "longitude", "percentile", "avg_items_per_transaction")


def records(spark, d):
    return _flat(_records(spark, d)).drop("tooltip_summary")


def record_sums(spark, d):
    """Month and year sums, basket and items."""
    return records(spark, d).select("store_id", "revenue_mtd_usd", "revenue_ytd_usd", "transaction_count_mtd",
                                    "avg_basket_size_usd", "avg_items_per_transaction")


def record_ranks(spark, d):
    return records(spark, d).select("store_id", "economic_region", "market_share_region", "rank_in_region",
                                    "total_stores_in_region", "percentile", "performance_tier", "alert_flags")


def latest_attributes(spark, d):
    """Attributes as of each store's last sale; the product of that sale proves which row won."""
    sales = fr.usd_sales(spark, d, "economic_region", "urban_rural").withColumn("store_name", F.col("product_id"))
    return kpi.latest_attributes(sales).select("store_id", "store_name", "country", "economic_region", "urban_rural")


def tooltips(spark, d):
    return _records(spark, d).select("store_id", "tooltip_summary")


def markers(spark, d):
    m = kpi.marker_rows(_records(spark, d))
    return m.select("id", "country", "region", "tier", "color", F.round("size", 6).alias("size"),
                    F.concat_ws(",", "alerts").alias("alerts"), F.round(F.col("position")[0], 6).alias("latitude"),
                    F.round(F.col("position")[1], 6).alias("longitude"))


def region_summary(spark, d):
    return fr.rounded(kpi.region_summary(_records(spark, d)), "avg_sss_growth")


def find_markers(spark, d):
    found = lookup.markers(_records(spark, d), country="CN", tier="market_perform", min_sss_growth=-0.9, limit=5)
    return found.select("id", "color", "sss_growth_formatted", "total_count").drop("sss_growth_formatted")


def store_detail(spark, d):
    detail = lookup.store_detail(_records(spark, d), "store_000007")
    return detail.select(
        "store_id", "store_name", "location.region", "location.nearest_city", "financials.revenue_mtd_usd",
        "financials.same_store_sales_growth", "competitive.rank_in_region", "competitive.competition_density",
        "performance.tier", F.concat_ws(",", "performance.alerts").alias("alerts"), "calculated_at")


def alerts(severity):
    def query(spark, d):
        found = lookup.alerts(_records(spark, d), severity)
        return found.withColumn("alerts", F.concat_ws(",", "alerts"))
    return query


def search(spark, d):
    return lookup.search_stores(_records(spark, d), "TOKY")


def search_all_regions(spark, d):
    return lookup.search_stores(_records(spark, d), "china", "region")


def ad_hoc(spark, d):
    """Parameterised SQL over the loaded tables."""
    tables = {"stores": fr.located_stores(spark, d).select("store_id", "country", "economic_region"),
              "sales_transactions": fr.usd_sales(spark, d, "country").drop("country")}
    return lookup.run_sql(spark, tables, """
        SELECT s.country, count(DISTINCT s.store_id) AS stores, count(*) AS sales,
               cast(round(sum(cast(t.revenue_usd AS decimal(28,10))), 4) AS double) AS revenue_usd
        FROM stores s JOIN sales_transactions t ON s.store_id = t.store_id
        WHERE s.economic_region = :region AND t.date >= :since
        GROUP BY s.country""", {"region": "ASEAN Core", "since": REF})


QUERIES = {
    "kpi_table": kpi_table,
    "kpi_table_open": kpi_table_open,
    "kpi_records": records,
    "kpi_record_sums": record_sums,
    "kpi_record_ranks": record_ranks,
    "kpi_latest_attributes": latest_attributes,
    "kpi_tooltips": tooltips,
    "kpi_markers": markers,
    "kpi_region_summary": region_summary,
    "lookup_markers": find_markers,
    "lookup_store_detail": store_detail,
    "lookup_regions": lambda spark, d: fr.rounded(lookup.regions(_records(spark, d)), "avg_sss_growth"),
    "lookup_alerts_critical": alerts("critical"),
    "lookup_alerts_warning": alerts("warning"),
    "lookup_search_all": search,
    "lookup_search_region": search_all_regions,
    "lookup_ad_hoc_sql": ad_hoc,
}


def _case(condition: str) -> str:
    return f"CASE WHEN {condition} THEN revenue_usd END"


_MTD, _YTD = "date >= DATE '2000-06-01'", "date >= DATE '2000-01-01'"
_PRIOR = "date >= DATE '1999-06-01' AND date < DATE '1999-07-01'"
_PRIOR_31 = "date >= DATE '1999-06-01' AND date < DATE '1999-07-02'"

RECORDS = f"""
    past AS (SELECT * FROM usd_sales WHERE date <= DATE '2000-06-30'),
    sums AS (SELECT store_id, {money_sum('revenue_usd')} AS total, coalesce({money_sum(_case(_MTD))}, 0) AS mtd,
                    coalesce({money_sum(_case(_YTD))}, 0) AS ytd, coalesce({money_sum(_case(_PRIOR_31))}, 0) AS prior,
                    count_if({_MTD})::BIGINT AS n, avg(CASE WHEN {_MTD} THEN CAST(qty AS DOUBLE) END) AS items
             FROM past GROUP BY store_id),
    base AS (SELECT g.*, s.*, d.stores_within_10km AS competition_density,
                    CASE WHEN prior > 0 THEN mtd / prior - 1 ELSE 0 END AS sss,
                    sum(CAST(total AS DECIMAL(38,4))) OVER (PARTITION BY economic_region) AS region_total,
                    count(*) OVER (PARTITION BY economic_region) AS region_stores,
                    rank() OVER (PARTITION BY economic_region ORDER BY mtd DESC) AS place,
                    (rank() OVER (ORDER BY total) + (count(*) OVER (PARTITION BY total) - 1) / 2.0::DOUBLE)
                        / count(*) OVER () AS percentile
             FROM geo_stores g JOIN sums s USING (store_id) JOIN density d USING (store_id)),
    graded AS (SELECT *, CASE WHEN sss < -0.10 AND percentile < 0.10 THEN 'critical'
                              WHEN percentile > 0.75 THEN 'outperforming' WHEN percentile < 0.25 THEN 'underperforming'
                              ELSE 'market_perform' END AS tier,
                      ytd / CAST(region_total AS DOUBLE) * 100 AS share FROM base),
    flagged AS (SELECT *, concat_ws(',', CASE WHEN sss < -0.05 THEN 'SSS_DECLINE' END,
                      CASE WHEN share < 1.0 AND region_stores > 10 THEN 'LOW_MARKET_SHARE' END,
                      CASE WHEN competition_density > 10 THEN 'HIGH_COMPETITION' END) AS flags FROM graded),
    records AS (SELECT store_id, store_name, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
                       country, economic_region, urban_rural, nearest_city, mtd AS revenue_mtd_usd,
                       ytd AS revenue_ytd_usd, sss AS revenue_growth_yoy, sss AS same_store_sales_growth,
                       n AS transaction_count_mtd, coalesce(mtd / nullif(n, 0), 0) AS avg_basket_size_usd,
                       round(coalesce(items, 0), 6) AS avg_items_per_transaction, share AS market_share_region,
                       competition_density, place AS rank_in_region, region_stores AS total_stores_in_region,
                       round(percentile, 6) AS percentile, tier AS performance_tier, flags AS alert_flags,
                       DATE '2000-06-30' AS calculated_at FROM flagged)"""

_COLORS = """CASE performance_tier WHEN 'outperforming' THEN '#22c55e' WHEN 'market_perform' THEN '#3b82f6'
    WHEN 'underperforming' THEN '#f59e0b' ELSE '#ef4444' END"""

_SUMMARY = f"""WITH {RECORDS}
    SELECT economic_region, count(*) AS total_stores, {money_sum('revenue_mtd_usd')} AS total_revenue_mtd,
           round(avg(same_store_sales_growth), 6) AS avg_sss_growth,
           count_if(performance_tier = 'outperforming')::BIGINT AS outperforming,
           count_if(performance_tier = 'critical')::BIGINT AS critical,
           arg_min(store_id, (-revenue_mtd_usd, store_id)) AS top_store,
           arg_min(store_id, (same_store_sales_growth, store_id)) AS worst_store
    FROM records GROUP BY economic_region"""


def _alerts(level: int) -> str:
    return f"""WITH {RECORDS}
        SELECT store_id, alert_flags AS alerts, performance_tier AS tier, same_store_sales_growth AS sss_growth,
               revenue_mtd_usd AS revenue_mtd, nearest_city AS city
        FROM records WHERE alert_flags <> '' AND (CASE WHEN performance_tier = 'critical' THEN 0
             WHEN same_store_sales_growth < -0.05 THEN 1 ELSE 2 END) <= {level}"""


def _search(condition: str) -> str:
    return f"""WITH {RECORDS}, hits AS (SELECT *, count(*) OVER () AS total_found FROM records WHERE {condition})
        SELECT store_id, nearest_city AS city, economic_region AS region, performance_tier AS tier,
               same_store_sales_growth AS sss_growth, total_found FROM hits ORDER BY store_id LIMIT 50"""


def _table(dates: str) -> str:
    return f"""
        WITH p AS (SELECT store_id, coalesce({money_sum(_case(_MTD))}, 0) AS mtd,
                          coalesce({money_sum(_case(_YTD))}, 0) AS ytd, {money_sum(_case(_PRIOR))} AS prior,
                          count_if({_MTD})::BIGINT AS n FROM usd_sales{dates} GROUP BY store_id)
        SELECT g.store_id, economic_region, DATE '2000-06-30' AS calculation_date,
               coalesce(mtd, 0) / nullif(prior, 0) - 1 AS same_store_sales_growth,
               coalesce(mtd, 0) AS revenue_mtd, coalesce(ytd, 0) AS revenue_ytd,
               coalesce(n, 0) AS transaction_count_mtd, mtd / nullif(n, 0) AS avg_basket_size,
               rank() OVER (PARTITION BY economic_region ORDER BY coalesce(mtd, 0) DESC) AS rank_in_region
        FROM geo_stores g LEFT JOIN p ON g.store_id = p.store_id"""


SQL = {
    "kpi_table": _table(" WHERE date <= DATE '2000-06-30'"),
    "kpi_table_open": _table(""),
    "kpi_records": f"WITH {RECORDS} SELECT * FROM records",
    "kpi_record_sums": f"""WITH {RECORDS} SELECT store_id, revenue_mtd_usd, revenue_ytd_usd, transaction_count_mtd,
        avg_basket_size_usd, avg_items_per_transaction FROM records""",
    "kpi_record_ranks": f"""WITH {RECORDS} SELECT store_id, economic_region, market_share_region, rank_in_region,
        total_stores_in_region, percentile, performance_tier, alert_flags FROM records""",
    "kpi_latest_attributes": """
        SELECT store_id, arg_max(product_id, ingest_ord) AS store_name, any_value(country) AS country,
               any_value(economic_region) AS economic_region, any_value(urban_rural) AS urban_rural
        FROM usd_sales GROUP BY store_id""",
    "kpi_tooltips": f"""WITH {RECORDS} SELECT store_id, concat_ws(chr(10), store_id || ' | ' || coalesce(nearest_city, 'Unknown'),
        'MTD Revenue: $' || format('{{:,.0f}}', revenue_mtd_usd), 'SSS Growth: ' || printf('%+.1f%%', same_store_sales_growth * 100),
        'Region Rank: #' || rank_in_region || '/' || total_stores_in_region, 'Tier: ' || upper(performance_tier)) AS tooltip_summary
        FROM records""",
    "kpi_markers": f"""WITH {RECORDS} SELECT store_id AS id, country, economic_region AS region,
        performance_tier AS tier, {_COLORS} AS color,
        round(least(10.0::DOUBLE * (1 + ln(greatest(revenue_mtd_usd, 1.0)) / 10), 40.0), 6) AS size,
        alert_flags AS alerts, latitude, longitude FROM records""",
    "kpi_region_summary": _SUMMARY,
    "lookup_markers": f"""WITH {RECORDS}, hits AS (SELECT *, count(*) OVER () AS total_count FROM records
            WHERE country = 'CN' AND performance_tier = 'market_perform' AND same_store_sales_growth >= -0.9)
        SELECT store_id AS id, {_COLORS} AS color, total_count FROM hits ORDER BY store_id LIMIT 5""",
    "lookup_store_detail": f"""WITH {RECORDS} SELECT store_id, store_name, economic_region AS region, nearest_city,
        revenue_mtd_usd, same_store_sales_growth, rank_in_region, competition_density, performance_tier AS tier,
        alert_flags AS alerts, calculated_at FROM records WHERE store_id = 'store_000007'""",
    "lookup_regions": _SUMMARY,
    "lookup_alerts_critical": _alerts(0),
    "lookup_alerts_warning": _alerts(1),
    "lookup_search_all": _search("contains(lower(store_id), 'toky') OR contains(lower(nearest_city), 'toky')"
                                 " OR contains(lower(economic_region), 'toky')"),
    "lookup_search_region": _search("contains(lower(economic_region), 'china')"),
    "lookup_ad_hoc_sql": f"""
        SELECT country, count(DISTINCT store_id) AS stores, count(*) AS sales, {money_sum('revenue_usd')} AS revenue_usd
        FROM usd_sales WHERE economic_region = 'ASEAN Core' AND date >= DATE '2000-06-30' GROUP BY country""",
}
