"""The tables behind the dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.materialize import checkpointed
from ..functions.money import as_money, exact, exact_sum, money_sum, ratio
from .kpi import TIER_COLORS

# Colours of the growth and revenue bands, best first; grey for unknown.
BANDS = ("#22c55e", "#3b82f6", "#f59e0b", "#ef4444")
GREY = "#969696"

FILTER_COLUMNS = {"region": "economic_region", "country": "country", "tier": "performance_tier",
                  "urban_rural": "urban_rural"}


def _known(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None)


def headline_metrics(df: DataFrame, revenue: str = "revenue_usd") -> DataFrame:
    """One row of headline figures; a figure whose column is absent is null or zero.

    Stores are reduced to one row each first, so no distinct count sees the sales.
    """
    present = [c for c in ("economic_region", "original_currency") if c in df.columns]
    sss = _column(df, "same_store_sales_growth").cast("double")
    per = df.groupBy("store_id", *present).agg(
        exact_sum(revenue).alias("_sum"), F.count(revenue).alias("_n"), F.count(F.lit(1)).alias("_rows"),
        F.sum(sss).alias("_sss"), F.count(sss).alias("_sss_n"))
    counts = {"economic_region": "num_regions", "original_currency": "num_currencies"}
    total = as_money(F.sum("_sum"))
    return per.agg(
        total.alias("total_revenue"), ratio(total, F.sum("_n")).alias("avg_transaction"),
        F.count_distinct("store_id").alias("total_stores"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_transactions"),
        ratio(F.sum("_sss"), F.sum("_sss_n")).alias("avg_sss_growth"),
        *[(F.count_distinct(c) if c in present else F.lit(0)).cast("bigint").alias(n) for c, n in counts.items()])


def apply_filters(df: DataFrame, filters: dict[str, str | None]) -> DataFrame:
    """Equality filters; ``All``, empty and absent columns switch a filter off."""
    for name, column in FILTER_COLUMNS.items():
        wanted = filters.get(name)
        if wanted and wanted != "All" and column in df.columns:
            df = df.where(F.col(column) == wanted)
    return df


def filter_values(df: DataFrame, column: str) -> DataFrame:
    return _known(df.select(column), column).distinct().orderBy(column)


def store_map(df: DataFrame, *, revenue: str = "revenue_usd", order_by: str = "ingest_ord",
              attributes: Sequence[str] = ("latitude", "longitude", "economic_region", "nearest_city",
                                           "country", "urban_rural", "stores_within_10km")) -> DataFrame:
    """One row per store: first attributes, total revenue, mean growth where present.

    Rows are first reduced to one per store and set of attributes (usually one per store).
    """
    present = [c for c in attributes if c in df.columns]
    has_growth = "same_store_sales_growth" in df.columns
    sss = F.col("same_store_sales_growth") if has_growth else F.lit(None).cast("double")
    sets = _known(df, "store_id").groupBy("store_id", *present).agg(
        F.min(order_by).alias("_first"), exact_sum(revenue).alias("_sum"),
        F.sum(sss).alias("_sss"), F.count(sss).alias("_sss_n"))
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_first"))).alias(c) for c in present]
    extra = [ratio(F.sum("_sss"), F.sum("_sss_n")).alias("same_store_sales_growth")] if has_growth else []
    return sets.groupBy("store_id").agg(
        *firsts, F.coalesce(as_money(F.sum("_sum")), F.lit(0.0)).alias(revenue), *extra)


def map_center(store_rows: DataFrame) -> DataFrame:
    return store_rows.agg(F.avg("latitude").alias("center_lat"), F.avg("longitude").alias("center_lon"))


def _band(value: Column, limits: tuple[float, float, float]) -> Column:
    out = F.when(value.isNull(), GREY)
    for limit, color in zip(limits, BANDS):
        out = out.when(value > limit, color)
    return out.otherwise(BANDS[3])


def marker_color(store_rows: DataFrame, revenue: str = "revenue_usd") -> Column:
    """Colour by tier, else by growth, else by revenue, as far as the columns exist."""
    if "same_store_sales_growth" in store_rows.columns:
        fallback = _band(F.col("same_store_sales_growth"), (0.10, 0.0, -0.05))
    elif revenue in store_rows.columns:
        fallback = _band(F.col(revenue), (1_000_000.0, 500_000.0, 100_000.0))
    else:
        fallback = F.lit(BANDS[1])
    if "performance_tier" not in store_rows.columns:
        return fallback
    tiers = F.create_map(*[F.lit(x) for pair in TIER_COLORS.items() for x in pair])
    return F.coalesce(F.try_element_at(tiers, "performance_tier"), fallback)


def heat_points(store_rows: DataFrame, revenue: str = "revenue_usd") -> DataFrame:
    return store_rows.dropna(subset=["latitude", "longitude"]).select(
        "latitude", "longitude", (F.col(revenue) / 1000).alias("weight"))


def revenue_by_region(df: DataFrame, revenue: str = "revenue_usd") -> DataFrame:
    return (_known(df, "economic_region").groupBy("economic_region")
            .agg(money_sum(revenue).alias("revenue")).orderBy("revenue", "economic_region"))


def growth_vs_competition(store_rows: DataFrame, revenue: str = "revenue_usd") -> DataFrame:
    """Scatter points with the two reference lines (zero growth, five competitors) as flags."""
    return store_rows.select(
        "store_id", "economic_region", F.col("stores_within_10km").alias("nearby_competitors"),
        "same_store_sales_growth", F.col(revenue).alias("revenue"),
        (F.col("same_store_sales_growth") < 0).alias("below_zero_growth"),
        (F.col("stores_within_10km") > 5).alias("high_competition"))


def currency_breakdown(df: DataFrame, revenue: str = "revenue_usd") -> DataFrame:
    per_store = _known(df, "original_currency").groupBy("original_currency", "store_id").agg(
        exact_sum(revenue).alias("_sum"))
    out = per_store.groupBy("original_currency").agg(
        as_money(F.sum("_sum")).alias("revenue"), F.count("store_id").alias("stores"))
    # one row per currency
    total = F.sum("revenue").over(W.partitionBy())
    return out.withColumn("percentage", ratio("revenue", total) * 100).orderBy(
        F.col("revenue").desc(), "original_currency")


def region_urban_pivot(
    df: DataFrame, revenue: str = "revenue_usd",
    classes: Sequence[str] = ("Urban", "Suburban", "Rural", "Remote"),
) -> DataFrame:
    cells = _known(df, "economic_region", "urban_rural").groupBy("economic_region").pivot(
        "urban_rural", list(classes)).agg(exact_sum(revenue))
    return cells.select("economic_region", *[
        F.coalesce(as_money(c), F.lit(0.0)).alias(c) for c in classes])


def daily_revenue(df: DataFrame, revenue: str = "revenue_usd") -> DataFrame:
    return _known(df, "date").groupBy(F.to_date("date").alias("date")).agg(money_sum(revenue).alias("revenue"))


def daily_revenue_with_means(df: DataFrame, revenue: str = "revenue_usd") -> DataFrame:
    """Daily totals with 7- and 30-row moving means.

    The one un-partitioned window here sees one row per calendar day.
    """
    def mean(rows: int) -> Column:
        w = W.orderBy("date").rowsBetween(1 - rows, 0)
        return ratio(as_money(F.sum(exact("revenue")).over(w)), F.count("revenue").over(w))
    return daily_revenue(df, revenue).withColumns({"ma_7": mean(7), "ma_30": mean(30)}).orderBy("date")


def daily_revenue_by_region(df: DataFrame, revenue: str = "revenue_usd") -> DataFrame:
    return (_known(df, "date", "economic_region")
            .groupBy(F.to_date("date").alias("date"), F.col("economic_region").alias("region"))
            .agg(money_sum(revenue).alias("revenue")).orderBy("date", "region"))


def store_ranking(store_rows: DataFrame, n: int = 10, *, revenue: str = "revenue_usd",
                  growth: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The n best and the n worst stores by revenue, both in descending order.

    ``growth`` (store_id, same_store_sales_growth rows) adds each store's mean growth.
    """
    rows = store_rows
    if growth is not None:
        means = growth.groupBy("store_id").agg(F.avg("same_store_sales_growth").alias("same_store_sales_growth"))
        rows = rows.drop("same_store_sales_growth").join(means, "store_id", "left")
    down, up = [F.col(revenue).desc(), F.col("store_id")], [F.col(revenue).asc(), F.col("store_id").desc()]
    rows = checkpointed(rows)  # a row per store, read from both ends
    return rows.orderBy(*down).limit(n), rows.orderBy(*up).limit(n).orderBy(*down)


def urban_split(df: DataFrame, revenue: str = "revenue_usd") -> DataFrame:
    out = _known(df, "urban_rural").groupBy("urban_rural").agg(money_sum(revenue).alias("revenue"))
    # one row per class
    total = F.sum("revenue").over(W.partitionBy())
    return out.withColumn("percentage", ratio("revenue", total) * 100)


def declining_stores(df: DataFrame, threshold: float = -0.05, revenue: str = "revenue_usd") -> DataFrame:
    return (_known(df, "store_id").where(F.col("same_store_sales_growth") < threshold).groupBy("store_id")
            .agg(F.avg("same_store_sales_growth").alias("sss"), money_sum(revenue).alias("revenue")))


def stores_per_region(df: DataFrame, n: int = 5, order_by: str | None = None) -> DataFrame:
    """Stores per region for the first ``n`` regions, by first appearance or by name."""
    named = _known(df, "economic_region")
    if order_by is None:
        pairs = named.select("economic_region", "store_id").distinct()
        out = pairs.groupBy("economic_region").agg(F.count("store_id").alias("stores"))
        return out.orderBy("economic_region").limit(n)
    pairs = named.groupBy("economic_region", "store_id").agg(F.min(order_by).alias("_first"))
    out = pairs.groupBy("economic_region").agg(F.count("store_id").alias("stores"), F.min("_first").alias("_first"))
    return out.orderBy("_first").limit(n).drop("_first")
