"""Regional aggregates: time series, same-store growth, concentration, exposure, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import dimensions as dim
from ..functions.materialize import checkpointed
from ..functions.money import as_money, exact_sum, growth, money_sum, ratio
from ..functions.periods import LONG_LAG, period_end, period_ends_between
from ..functions.ranks import top_rows

SAME_STORE_ROWS = {"YoY": 365, "QoQ": 90, "MoM": 30}


def period_totals(
    df: DataFrame, *, group_by: str = "economic_region", date_column: str = "date",
    revenue_column: str = "revenue_usd", store_column: str = "store_id", period: str = "M",
) -> DataFrame:
    """Revenue, count and distinct stores per group and period that has sales.

    Rows are first reduced to one per store and period, which also makes the distinct count a
    plain count: one wide shuffle of pre-aggregated rows and one small one.
    """
    value = F.col(revenue_column)
    per_store = (
        df.where(F.col(group_by).isNotNull() & F.col(date_column).isNotNull())
        .groupBy(group_by, period_end(F.to_date(date_column), period).alias("period"), store_column)
        .agg(exact_sum(value).alias("_sum"), F.count(value).alias("_count")))
    return per_store.groupBy(group_by, "period").agg(
        F.sum("_sum").alias("_sum"), F.sum("_count").alias("revenue_count"),
        F.count(store_column).alias("store_count"))


def aggregate_by_region(
    df: DataFrame, *, group_by: str = "economic_region", date_column: str = "date",
    revenue_column: str = "revenue_usd", store_column: str = "store_id", period: str = "M",
    yoy_lag: int | None = None,
) -> DataFrame:
    """One row per group and calendar period, empty periods filled with zero, with growth rates.

    The windows run per group over calendar periods, so their size is bounded by the calendar.
    """
    totals = period_totals(df, group_by=group_by, date_column=date_column,
                           revenue_column=revenue_column, store_column=store_column, period=period)
    calendar = totals.groupBy(group_by).agg(
        F.min("period").alias("_from"), F.max("period").alias("_to")).select(
        group_by, F.explode(period_ends_between(F.col("_from"), F.col("_to"), period)).alias("period"))
    filled = calendar.join(totals, [group_by, "period"], "left").select(
        group_by, "period",
        as_money(F.coalesce("_sum", F.lit(0))).alias("revenue_sum"),
        F.coalesce(ratio(as_money("_sum"), "revenue_count"), F.lit(0.0)).alias("revenue_mean"),
        F.coalesce("revenue_count", F.lit(0)).alias("revenue_count"),
        F.coalesce("store_count", F.lit(0)).alias("store_count"))
    w = W.partitionBy(group_by).orderBy("period")
    return filled.withColumns({
        "revenue_growth_mom": growth("revenue_sum", F.lag("revenue_sum", 1).over(w)),
        "revenue_growth_yoy": growth("revenue_sum", F.lag("revenue_sum", yoy_lag or LONG_LAG[period]).over(w)),
    })


def same_store_sales(
    df: DataFrame, comparison_period: str = "YoY", *, by: str = "rows",
    order_by: Sequence[str] = ("ingest_ord",), revenue_column: str = "revenue_usd",
) -> DataFrame:
    """Growth of each store's current slice over the slice before it.

    ``by="rows"``: the last N sales against the N before them. ``by="days"``: the last N calendar
    days against the N days before; both must have sales.
    """
    n = SAME_STORE_ROWS[comparison_period]
    value = F.col(revenue_column)
    known = df.where(F.col("store_id").isNotNull())
    if by == "rows":
        newest = [F.col("date").desc_nulls_first(), *[F.col(c).desc() for c in order_by]]
        last = top_rows(known.select("store_id", "date", *order_by, value.alias("_value")),
                        ["store_id"], newest, 2 * n, number="_rn")
        recent, prior = F.col("_rn") <= n, F.col("_rn") > n
    elif by == "days":
        last_day = known.groupBy("store_id").agg(F.max("date").alias("_last"))
        last = (known.join(last_day, "store_id")
                .withColumn("_value", value).withColumn("_age", F.datediff("_last", "date"))
                .where(F.col("_age") < 2 * n))
        recent, prior = F.col("_age") < n, F.col("_age") >= n
    else:
        raise ValueError("by must be rows or days")
    sums = last.groupBy("store_id").agg(
        exact_sum(F.when(recent, F.col("_value"))).alias("_cur"),
        exact_sum(F.when(prior, F.col("_value"))).alias("_pri"),
        F.count_if(recent).alias("_n_cur"), F.count_if(prior).alias("_n_pri"))
    complete = (F.col("_n_cur") >= (n if by == "rows" else 1)) & (F.col("_n_pri") > 0)
    current = F.coalesce(as_money("_cur"), F.lit(0.0))
    base = F.coalesce(as_money("_pri"), F.lit(0.0))
    return sums.where(complete).select(
        "store_id",
        F.when(base > 0, growth(current, base)).alias("same_store_sales_growth"),
        current.alias("current_revenue"), base.alias("prior_revenue"),
        F.lit(comparison_period).alias("comparison_period"))


def market_penetration(df: DataFrame) -> DataFrame:
    """Revenue, stores and spending power per region and country.

    ``avg_revenue_per_store`` keeps its historical meaning (mean sale); ``revenue_per_store`` is
    the mean over stores.
    """
    has_gdp = "gdp_per_capita_usd" in df.columns
    first_gdp = [F.max("gdp_per_capita_usd").alias("_gdp")] if has_gdp else []
    again = [F.max("_gdp").alias("gdp_per_capita")] if has_gdp else []
    per_store = (df.where(F.col("economic_region").isNotNull() & F.col("country").isNotNull())
                 .groupBy("economic_region", "country", "store_id")
                 .agg(exact_sum("revenue_usd").alias("_sum"), F.count("revenue_usd").alias("_n"), *first_gdp))
    out = per_store.groupBy("economic_region", "country").agg(
        as_money(F.sum("_sum")).alias("total_revenue_usd"),
        F.count("store_id").alias("store_count"), F.sum("_n").alias("_n"), *again)
    mean = ratio("total_revenue_usd", "_n")
    out = out.withColumns({
        "avg_revenue_per_store": mean, "avg_transaction_value": mean,
        "revenue_per_store": ratio("total_revenue_usd", "store_count")})
    if has_gdp:
        out = out.withColumn("revenue_to_gdp_ratio", ratio("avg_revenue_per_store", "gdp_per_capita"))
    return out.drop("_n")


def _hhi(total: str) -> Column:
    """Concentration from the per-member totals of a group, in one aggregate."""
    share = F.col(total).cast("double")
    return ratio(F.sum(share * share), F.sum(share) * F.sum(share)) * 10000


def herfindahl_index(df: DataFrame, group_column: str, value_column: str, *, within: Sequence[str] = ()) -> DataFrame:
    """Herfindahl-Hirschman index (0-10000) of ``value_column`` over ``group_column``."""
    keyed = df.where(F.col(group_column).isNotNull())
    members = keyed.groupBy(*within, group_column).agg(F.coalesce(exact_sum(value_column), F.lit(0)).alias("_total"))
    return members.groupBy(*within).agg(_hhi("_total").alias("hhi"), F.count(F.lit(1)).alias("members"))


def currency_exposure(
    df: DataFrame, revenue_column: str = "revenue_usd", currency_column: str = "original_currency",
) -> DataFrame:
    out = df.where(F.col(currency_column).isNotNull()).groupBy(currency_column).agg(
        money_sum(revenue_column).alias("revenue_usd"),
        F.count(revenue_column).alias("transaction_count"))
    # one row per currency from here, so the one-partition window is small
    total = F.sum("revenue_usd").over(W.partitionBy())
    return out.withColumns({
        "avg_transaction": ratio("revenue_usd", "transaction_count"),
        "percentage_of_total": ratio("revenue_usd", total) * 100,
        "high_volatility": F.col(currency_column).isin(*dim.HIGH_VOLATILITY_CURRENCIES),
    }).orderBy(F.col("revenue_usd").desc(), currency_column)


def in_range(df: DataFrame, start=None, end=None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start))
    return df if end is None else df.where(F.col("date") <= F.lit(end))


def region_store_totals(df: DataFrame) -> DataFrame:
    return (df.where(F.col("economic_region").isNotNull() & F.col("store_id").isNotNull())
            .groupBy("economic_region", "store_id").agg(exact_sum("revenue_usd").alias("revenue_usd")))


def best_and_worst_stores(store_totals: DataFrame, n: int = 5) -> DataFrame:
    """(economic_region, side, place, store_id, revenue_usd): the n best and n worst per region.

    The totals are read for both sides, so they are stored once.
    """
    revenue = F.coalesce(as_money("revenue_usd"), F.lit(0.0))
    rows = checkpointed(store_totals.select("economic_region", "store_id", revenue.alias("revenue_usd")))
    group = ["economic_region"]
    top = top_rows(rows, group, [F.col("revenue_usd").desc(), F.col("store_id")], n, number="place")
    low = top_rows(rows, group, [F.col("revenue_usd").asc(), F.col("store_id")], n, number="place")
    return top.withColumn("side", F.lit("top")).unionByName(low.withColumn("side", F.lit("bottom")))


def revenue_split(df: DataFrame, column: str) -> DataFrame:
    """Revenue per region and value of ``column``."""
    return (df.where(F.col("economic_region").isNotNull() & F.col(column).isNotNull())
            .groupBy("economic_region", column).agg(money_sum("revenue_usd").alias("revenue_usd")))


def _as_map(split: DataFrame, column: str, name: str) -> DataFrame:
    return split.groupBy("economic_region").agg(F.map_from_entries(F.sort_array(
        F.collect_list(F.struct(column, "revenue_usd")))).alias(name))


def _per_store(df: DataFrame, *keys: str, days: bool = False) -> DataFrame:
    """Sales, or their sums by day, reduced to one row per region, store and ``keys``: all the regional record is made of."""
    has_density = "stores_within_10km" in df.columns
    density = F.col("stores_within_10km") if has_density else F.lit(None).cast("bigint")
    if days:
        n = F.col("n")
        return (df.where(F.col("economic_region").isNotNull())
                .groupBy("economic_region", "store_id", *keys).agg(
                    F.sum("usd").cast("decimal(38,10)").alias("_total"), F.sum("n_usd").alias("_n"), F.sum(n).alias("_rows"),
                    F.sum(density * n).alias("_near"), F.coalesce(F.sum(F.when(density.isNotNull(), n)), F.lit(0)).alias("_near_n"),
                    F.min("date").alias("_from"), F.max("date").alias("_to")))
    return (df.where(F.col("economic_region").isNotNull())
            .groupBy("economic_region", "store_id", *keys).agg(
                exact_sum("revenue_usd").alias("_total"), F.count("revenue_usd").alias("_n"),
                F.count(F.lit(1)).alias("_rows"), F.sum(density).alias("_near"), F.count(density).alias("_near_n"),
                F.min("date").alias("_from"), F.max("date").alias("_to")))


def _region_totals(per_store: DataFrame) -> DataFrame:
    stores = F.count("store_id")
    total = as_money(F.sum("_total"))
    return per_store.groupBy("economic_region").agg(
        F.min("_from").alias("period_start"), F.max("_to").alias("period_end"),
        F.coalesce(total, F.lit(0.0)).alias("total_revenue_usd"),
        stores.alias("total_stores"), F.sum("_rows").alias("total_transactions"),
        F.coalesce(ratio(total, stores), F.lit(0.0)).alias("avg_revenue_per_store"),
        ratio(total, F.sum("_n")).alias("avg_transaction_value"),
        F.coalesce(ratio(F.sum("_near"), F.sum("_near_n")), F.lit(0.0)).alias("competition_index"),
        F.when(stores > 1, _hhi("_total")).otherwise(F.lit(10000.0)).alias("market_concentration_hhi"))


def region_totals(df: DataFrame) -> DataFrame:
    """Totals, means, competition index and concentration per region from one pass over the sales."""
    return _region_totals(_per_store(df))


def full_regional_summary(df: DataFrame, period_start=None, period_end=None, *, days: bool = False) -> DataFrame:
    """The nested regional record: totals, store lists and revenue maps.

    The sales, or with ``days`` their sums by store, day and currency, are read once; all parts come from the stored
    rows per store.
    """
    pieces = checkpointed(_per_store(in_range(df, period_start, period_end), "original_currency", "urban_rural", days=days))
    per_store = pieces.groupBy("economic_region", "store_id").agg(
        *[F.sum(c).alias(c) for c in ("_total", "_n", "_rows", "_near", "_near_n")],
        F.min("_from").alias("_from"), F.max("_to").alias("_to"))
    out = _region_totals(per_store)
    if period_start is not None:
        out = out.withColumn("period_start", F.lit(period_start).cast("date"))
    if period_end is not None:
        out = out.withColumn("period_end", F.lit(period_end).cast("date"))
    totals = per_store.where(F.col("store_id").isNotNull()).select(
        "economic_region", "store_id", F.col("_total").alias("revenue_usd"))
    places = best_and_worst_stores(totals).groupBy("economic_region").agg(*[
        F.sort_array(F.collect_list(F.when(F.col("side") == side, F.struct("place", "store_id")))).alias(side)
        for side in ("top", "bottom")])
    places = places.select("economic_region", F.col("top.store_id").alias("top_performing_stores"),
                           F.col("bottom.store_id").alias("bottom_performing_stores"))

    def split(column: str) -> DataFrame:
        return pieces.where(F.col(column).isNotNull()).groupBy("economic_region", column).agg(
            as_money(F.sum("_total")).alias("revenue_usd"))

    for frame in (places,
                  _as_map(split("original_currency"), "original_currency", "currency_exposure"),
                  _as_map(split("urban_rural"), "urban_rural", "urban_rural_split")):
        out = out.join(frame, "economic_region", "left")
    return out
