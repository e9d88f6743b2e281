"""Store KPIs, tiers, alerts, markers and their region summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import join_dimension
from ..functions.materialize import checkpointed
from ..functions.money import as_money, exact_sum, growth, ratio
from ..functions.ranks import join_ranks, rank_table, with_rank

# Marker colour per tier.
TIER_COLORS = {
    "outperforming": "#22c55e", "market_perform": "#3b82f6",
    "underperforming": "#f59e0b", "critical": "#ef4444",
}

STORE_ATTRIBUTES = ("store_name", "latitude", "longitude", "country", "economic_region",
                    "urban_rural", "nearest_city", "stores_within_10km")


def _months(reference_date) -> dict[str, dt.date]:
    ref = dt.date.fromisoformat(str(reference_date)[:10])
    prior = ref.replace(year=ref.year - 1, day=1)
    following = prior.replace(day=28) + dt.timedelta(days=4)
    return {"ref": ref, "month": ref.replace(day=1), "year": ref.replace(month=1, day=1),
            "prior": prior, "prior_end": following.replace(day=1),
            "prior_end_31": prior + dt.timedelta(days=31)}


def _since(start: dt.date) -> Column:
    return F.col("date") >= F.lit(start)


def _added(days: bool):
    """(sum of USD, rows, rows with USD) where a condition holds, over sales or over their sums by day."""
    if days:
        return (lambda on: F.sum(F.when(on, F.col("usd"))).cast("decimal(38,10)"),
                lambda on: F.coalesce(F.sum(F.when(on, F.col("n"))), F.lit(0)),
                lambda on: F.coalesce(F.sum(F.when(on, F.col("n_usd"))), F.lit(0)))
    usd = F.col("revenue_usd")
    return lambda on: exact_sum(F.when(on, usd)), F.count_if, lambda on: F.count(F.when(on, usd))


def store_kpi_table(
    stores: DataFrame, sales: DataFrame, reference_date, *, upper_bound: bool = False, days: bool = False,
) -> DataFrame:
    """The persisted KPI table: month and year to date, growth over the same month last year, rank.

    Sales are reduced to one row per store before they meet the stores. With ``days`` they are sums by store and day
    (``loads.day_sums``); the figures are the same to the last digit.
    """
    m = _months(reference_date)
    if upper_bound:
        sales = sales.where(F.col("date") <= F.lit(m["ref"]))
    (total, rows, with_usd), mtd = _added(days), _since(m["month"])
    last_year = _since(m["prior"]) & (F.col("date") < F.lit(m["prior_end"]))
    # only this year and the month a year ago matter, and the predicate reaches the scan
    recent = sales.where(_since(min(m["year"], m["prior"])))
    sums = recent.groupBy("store_id").agg(
        total(mtd).alias("_mtd"), total(_since(m["year"])).alias("_ytd"), total(last_year).alias("_prior"),
        rows(mtd).alias("_n"), with_usd(mtd).alias("_n_usd"))
    zero = F.lit(0.0)
    per_store = stores.select("store_id", "economic_region").distinct().join(sums, "store_id", "left").select(
        "store_id", "economic_region",
        F.lit(m["ref"]).alias("calculation_date"),
        growth(F.coalesce(as_money("_mtd"), zero), as_money("_prior")).alias("same_store_sales_growth"),
        F.coalesce(as_money("_mtd"), zero).alias("revenue_mtd"),
        F.coalesce(as_money("_ytd"), zero).alias("revenue_ytd"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("transaction_count_mtd"),
        ratio(as_money("_mtd"), "_n_usd").alias("avg_basket_size"))
    keyed = per_store.withColumn("_region", F.coalesce("economic_region", F.lit("")))
    return with_rank(keyed, ["_region"], "revenue_mtd", rank="rank_in_region").drop("_region")


def latest_attributes(df: DataFrame, order_by: str = "ingest_ord") -> DataFrame:
    """Store attributes as of the store's last row.

    Rows are first reduced to one per store and set of attributes, with the last position of each.
    """
    present = [c for c in STORE_ATTRIBUTES if c in df.columns]
    sets = df.where(F.col("store_id").isNotNull()).groupBy("store_id", *present).agg(F.max(order_by).alias("_last"))
    picked = F.max_by(F.struct(*present), "_last").alias("a")
    return sets.groupBy("store_id").agg(picked).select("store_id", "a.*")


def performance_tier(sss: Column, percentile: Column) -> Column:
    return (F.when((sss < -0.10) & (percentile < 0.10), "critical")
            .when(percentile > 0.75, "outperforming")
            .when(percentile < 0.25, "underperforming")
            .otherwise("market_perform"))


def alert_flags(sss: Column, share: Column, region_stores: Column, density: Column) -> Column:
    return F.array_compact(F.array(
        F.when(sss < -0.05, "SSS_DECLINE"),
        F.when((share < 1.0) & (region_stores > 10), "LOW_MARKET_SHARE"),
        F.when(density > 10, "HIGH_COMPETITION")))


def percent_text(value: Column, digits: int = 1) -> Column:
    return F.format_string(f"%+.{digits}f%%", value * 100)


def dollars_text(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, 0))


def tooltip(k: dict[str, Column]) -> Column:
    return F.concat_ws(
        "\n",
        F.concat_ws(" | ", k["store_id"], F.coalesce(k["city"], F.lit("Unknown"))),
        F.concat(F.lit("MTD Revenue: "), dollars_text(k["mtd"])),
        F.concat(F.lit("SSS Growth: "), percent_text(k["sss"])),
        F.concat(F.lit("Region Rank: #"), k["rank"].cast("string"), F.lit("/"), k["stores"].cast("string")),
        F.concat(F.lit("Tier: "), F.upper(k["tier"])))


def store_sums(df: DataFrame, reference_date, *, upper_bound: bool = False, days: bool = False) -> DataFrame:
    """Per store: month, year and all-time sums, last year's month, counts and items, of sales or sums by day."""
    m = _months(reference_date)
    if upper_bound:
        df = df.where(F.col("date") <= F.lit(m["ref"]))
    (total, rows, with_usd), mtd = _added(days), _since(m["month"])
    last_year = _since(m["prior"]) & (F.col("date") < F.lit(m["prior_end_31"]))
    if days:
        items = ratio(F.sum(F.when(mtd, F.col("qty"))), F.sum(F.when(mtd, F.col("n_qty"))))
    else:
        items = F.avg(F.when(mtd, F.col("qty").cast("double"))) if "qty" in df.columns else F.lit(None).cast("double")
    return df.where(F.col("store_id").isNotNull()).groupBy("store_id").agg(
        total(F.lit(True)).alias("_total"), total(mtd).alias("_mtd"), total(_since(m["year"])).alias("_ytd"),
        total(last_year).alias("_prior"), rows(mtd).alias("transaction_count_mtd"), with_usd(mtd).alias("_n_usd"),
        items.alias("_items"))


def calculate_store_kpis(
    df: DataFrame, reference_date, *, stores: DataFrame | None = None, order_by: str = "ingest_ord",
    upper_bound: bool = False, share_period: str = "all", days: bool = False,
) -> DataFrame:
    """The full KPI record, one row per store.

    ``df`` is the enriched sales frame. With ``stores`` the attributes come from that table and
    ``df`` needs only store_id, date, revenue_usd and qty, or, with ``days``, is their sums by store and day;
    otherwise from each store's last row.
    All rankings and shares run at store grain on a stored frame.
    """
    attributes = latest_attributes(df, order_by) if stores is None else stores.select(
        "store_id", *[c for c in STORE_ATTRIBUTES if c in stores.columns])
    for c, t in (("store_name", "string"), ("nearest_city", "string"), ("urban_rural", "string"),
                 ("stores_within_10km", "bigint"), ("latitude", "double"), ("longitude", "double"),
                 ("country", "string"), ("economic_region", "string")):
        if c not in attributes.columns:
            attributes = attributes.withColumn(c, F.lit(None).cast(t))
    zero = F.lit(0.0)
    sums = store_sums(df, reference_date, upper_bound=upper_bound, days=days)
    mtd, ytd = F.coalesce(as_money("_mtd"), zero), F.coalesce(as_money("_ytd"), zero)
    prior = F.coalesce(as_money("_prior"), zero)
    base = attributes.join(sums, "store_id").select(
        *attributes.columns,
        F.coalesce(as_money("_total"), zero).alias("_total"), mtd.alias("revenue_mtd_usd"), ytd.alias("revenue_ytd_usd"),
        F.coalesce(F.when(prior > 0, growth(mtd, prior)), zero).alias("same_store_sales_growth"),
        "transaction_count_mtd",
        F.coalesce(ratio(as_money("_mtd"), "_n_usd"), zero).alias("avg_basket_size_usd"),
        F.coalesce("_items", zero).alias("avg_items_per_transaction"))
    base = base.withColumn("economic_region", F.coalesce("economic_region", F.lit("Unknown")))
    base = checkpointed(base)
    regions = base.groupBy("economic_region").agg(
        F.sum(F.col("_total").cast("decimal(38,4)")).alias("_region_all"),
        F.sum(F.col("revenue_ytd_usd").cast("decimal(38,4)")).alias("_region_ytd"),
        F.count(F.lit(1)).alias("total_stores_in_region"))
    ranked = with_rank(base, ["economic_region"], "revenue_mtd_usd", rank="rank_in_region", is_stored=True)
    by_total = rank_table(base, [], "_total", ascending=True)
    ranked = join_ranks(ranked, by_total, [], "_total", percentile="percentile")
    out = join_dimension(ranked, regions, ["economic_region"])
    region_total = F.col("_region_ytd" if share_period == "ytd" else "_region_all").cast("double")
    share = F.coalesce(F.when(region_total > 0, ratio("revenue_ytd_usd", region_total) * 100), zero)
    density = F.coalesce("stores_within_10km", F.lit(0)).cast("bigint")
    out = out.withColumns({
        "market_share_region": share, "competition_density": density,
        "performance_tier": performance_tier(F.col("same_store_sales_growth"), F.col("percentile")),
        "calculated_at": F.lit(_months(reference_date)["ref"])})
    out = out.withColumn("alert_flags", alert_flags(
        F.col("same_store_sales_growth"), F.col("market_share_region"),
        F.col("total_stores_in_region"), F.col("competition_density")))
    out = out.withColumn("tooltip_summary", tooltip({
        "store_id": F.col("store_id"), "city": F.col("nearest_city"), "mtd": F.col("revenue_mtd_usd"),
        "sss": F.col("same_store_sales_growth"), "rank": F.col("rank_in_region"),
        "stores": F.col("total_stores_in_region"), "tier": F.col("performance_tier")}))
    return out.select(
        "store_id", "store_name", "latitude", "longitude", "country", "economic_region", "urban_rural",
        "nearest_city", "revenue_mtd_usd", "revenue_ytd_usd",
        F.col("same_store_sales_growth").alias("revenue_growth_yoy"), "same_store_sales_growth",
        "transaction_count_mtd", "avg_basket_size_usd", "avg_items_per_transaction", "market_share_region",
        "competition_density", "rank_in_region", "total_stores_in_region", "percentile", "performance_tier",
        "tooltip_summary", "alert_flags", "calculated_at")


def marker_rows(kpis: DataFrame) -> DataFrame:
    """One map marker per store: colour, size and formatted figures."""
    colors = F.create_map(*[F.lit(x) for pair in TIER_COLORS.items() for x in pair])
    size = F.lit(10.0) * (1 + F.log(F.greatest(F.col("revenue_mtd_usd"), F.lit(1.0))) / 10)
    return kpis.select(
        F.col("store_id").alias("id"), F.array("latitude", "longitude").alias("position"),
        "store_id", "country", F.col("economic_region").alias("region"),
        F.col("performance_tier").alias("tier"),
        F.coalesce(F.try_element_at(colors, "performance_tier"), F.lit("#gray")).alias("color"),
        F.least(size, F.lit(40.0)).alias("size"), F.col("tooltip_summary").alias("tooltip"),
        F.col("alert_flags").alias("alerts"), "same_store_sales_growth",
        dollars_text(F.col("revenue_mtd_usd")).alias("revenue_mtd_formatted"),
        percent_text(F.col("same_store_sales_growth")).alias("sss_growth_formatted"))


def region_summary(kpis: DataFrame) -> DataFrame:
    """Per region: stores, revenue, mean growth, tier counts, best and worst store."""
    return kpis.groupBy("economic_region").agg(
        F.count(F.lit(1)).alias("total_stores"),
        as_money(exact_sum("revenue_mtd_usd")).alias("total_revenue_mtd"),
        F.avg("same_store_sales_growth").alias("avg_sss_growth"),
        F.count_if(F.col("performance_tier") == "outperforming").alias("outperforming"),
        F.count_if(F.col("performance_tier") == "critical").alias("critical"),
        F.min(F.struct((-F.col("revenue_mtd_usd")).alias("r"), "store_id")).alias("_top"),
        F.min(F.struct("same_store_sales_growth", "store_id")).alias("_worst"),
    ).select("economic_region", "total_stores", "total_revenue_mtd", "avg_sss_growth", "outperforming",
             "critical", F.col("_top.store_id").alias("top_store"), F.col("_worst.store_id").alias("worst_store"))
