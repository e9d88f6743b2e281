"""The query surface over the KPI table: markers, details, alerts, search, ad hoc SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import kpi

MAX_MARKERS = 5000
SEARCH_RESULTS = 50

# Alert severities, most severe first.
SEVERITIES = {"critical": 0, "warning": 1, "info": 2}

SEARCH_FIELDS = {"store_id": "store_id", "city": "nearest_city", "region": "economic_region"}


def markers(
    kpis: DataFrame, *, region: str | None = None, country: str | None = None, tier: str | None = None,
    min_sss_growth: float | None = None, limit: int = 1000,
) -> DataFrame:
    """Marker rows that pass the filters, first ``limit`` by store, with the total before the limit."""
    if limit > MAX_MARKERS:
        raise ValueError(f"limit must be at most {MAX_MARKERS}")
    found = kpis
    for column, wanted in (("economic_region", region), ("country", country), ("performance_tier", tier)):
        if wanted:
            found = found.where(F.col(column) == wanted)
    if min_sss_growth is not None:
        found = found.where(F.col("same_store_sales_growth") >= min_sss_growth)
    total = found.agg(F.count(F.lit(1))).scalar()
    first = found.orderBy("store_id").limit(limit)
    return kpi.marker_rows(first).withColumn("total_count", total)


def store_detail(kpis: DataFrame, store_id: str) -> DataFrame:
    """One store's KPIs in nested groups; no row when the store is unknown."""
    return kpis.where(F.col("store_id") == store_id).select(
        "store_id", "store_name",
        F.struct("latitude", "longitude", "country", F.col("economic_region").alias("region"),
                 "urban_rural", "nearest_city").alias("location"),
        F.struct("revenue_mtd_usd", "revenue_ytd_usd", "same_store_sales_growth",
                 "avg_basket_size_usd").alias("financials"),
        F.struct("market_share_region", "rank_in_region", "total_stores_in_region",
                 "competition_density").alias("competitive"),
        F.struct(F.col("performance_tier").alias("tier"),
                 F.col("alert_flags").alias("alerts")).alias("performance"),
        "calculated_at")


def regions(kpis: DataFrame) -> DataFrame:
    return kpi.region_summary(kpis)


def severity():
    return (F.when(F.col("performance_tier") == "critical", 0)
            .when(F.col("same_store_sales_growth") < -0.05, 1).otherwise(2))


def alerts(kpis: DataFrame, min_severity: str = "critical") -> DataFrame:
    """Stores with alert flags at or above a severity; an unknown severity means all."""
    threshold = SEVERITIES.get(min_severity.lower(), SEVERITIES["info"])
    return kpis.where((F.size("alert_flags") > 0) & (severity() <= threshold)).select(
        "store_id", F.col("alert_flags").alias("alerts"), F.col("performance_tier").alias("tier"),
        F.col("same_store_sales_growth").alias("sss_growth"), F.col("revenue_mtd_usd").alias("revenue_mtd"),
        F.col("nearest_city").alias("city"))


def search_stores(kpis: DataFrame, query: str, field: str = "all", limit: int = SEARCH_RESULTS) -> DataFrame:
    """Case-insensitive substring search: the first ``limit`` hits by store and the number of all hits."""
    columns = list(SEARCH_FIELDS.values()) if field == "all" else [
        SEARCH_FIELDS[field]] if field in SEARCH_FIELDS else []
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(query.lower())), F.lit(False))
    found = kpis.where(hit)
    total = found.agg(F.count(F.lit(1))).scalar()
    return found.orderBy("store_id").limit(limit).select(
        "store_id", F.col("nearest_city").alias("city"), F.col("economic_region").alias("region"),
        F.col("performance_tier").alias("tier"), F.col("same_store_sales_growth").alias("sss_growth")
    ).withColumn("total_found", total)


def run_sql(spark: SparkSession, tables: dict[str, DataFrame], query: str, params: dict | None = None) -> DataFrame:
    """Parameterised SQL over the given tables (named markers, never string pasting)."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(query, args=params or {})
