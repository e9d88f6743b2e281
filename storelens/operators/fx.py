"""Currency normalisation with dated rates and fixed fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import dimensions as dim
from ..functions.joins import join_dimension


def country_currency(country: Column) -> Column:
    return F.coalesce(dim.lookup(dim.COUNTRIES, country, 4), F.lit(dim.DEFAULT_CURRENCY))


def fallback_usd_rate(currency: Column) -> Column:
    """USD per unit; an unknown currency counts as 1."""
    return F.coalesce(dim.lookup(dim.FALLBACK_USD_RATES, currency), F.lit(1.0))


def fallback_rate(source: Column, target: Column) -> Column:
    """Fixed rate between two currencies: to USD, from USD, or crossed through USD."""
    return (F.when(source == target, F.lit(1.0))
            .when(target == "USD", fallback_usd_rate(source))
            .when(source == "USD", F.lit(1.0) / fallback_usd_rate(target))
            .otherwise(fallback_usd_rate(source) / fallback_usd_rate(target)))


def rate_days(rates: DataFrame) -> DataFrame:
    """(currency, day, usd_rate) for every day from a currency's first to its last rate date.

    ``rates`` holds (currency, rate_date, usd_rate). A day takes the latest rate on or before it.
    One currency has at most one row per day, so the window is bounded by the calendar.
    """
    clean = (rates.where(F.col("currency").isNotNull() & F.col("rate_date").isNotNull())
             .groupBy("currency", F.to_date("rate_date").alias("rate_date"))
             .agg(F.max("usd_rate").alias("usd_rate")))
    after = F.lead("rate_date").over(W.partitionBy("currency").orderBy("rate_date"))
    until = F.coalesce(F.date_sub(after, 1), F.col("rate_date"))
    return (clean.withColumn("_until", until)
            .select("currency", F.explode(F.sequence("rate_date", "_until")).alias("day"), "usd_rate"))


def with_dated_rate(
    df: DataFrame, rates: DataFrame, *, currency: str = "original_currency", date: str = "date",
    name: str = "usd_rate",
) -> DataFrame:
    """As-of join: the latest rate on or before the date, else the earliest one after it.

    The rates become one row per currency and day, and a date outside a currency's span is moved
    to its edge, so the as-of join is an equi-join with a small table and the facts need no sort.
    """
    days = rate_days(rates).withColumnsRenamed({"currency": currency, "usd_rate": name})
    span = days.groupBy(currency).agg(F.min("day").alias("_from"), F.max("day").alias("_to"))
    out = join_dimension(df, span, [currency])
    out = out.withColumn("day", F.greatest(F.least(F.to_date(date), "_to"), "_from"))
    # a missing date has no rate: greatest/least skip nulls
    out = out.withColumn("day", F.when(F.col(date).isNotNull(), F.col("day")))
    return join_dimension(out, days, [currency, "day"]).drop("day", "_from", "_to")


def rate_calendar(sources: list[tuple[str, DataFrame]], tolerance_days: int = 3) -> DataFrame:
    """(currency, day, usd_rate, rate_source): each day's rate from the first of ``sources`` that covers it.

    ``sources`` are (name, rates) in order of preference, rates as in ``rate_days``. A source covers a day if it has a
    rate within ``tolerance_days`` of it; the nearest counts, of two equally near ones the earlier. Rates reach
    out to the days around them, so the choice is a minimum per currency and day: no sort, no range join, and the
    result is bounded by the calendar. Rates without a value, currency or date cover nothing.
    """
    if tolerance_days < 0:
        raise ValueError("tolerance_days must not be negative")
    reach = None
    for rank, (name, rates) in enumerate(sources):
        known = (rates.where(F.col("currency").isNotNull() & F.col("rate_date").isNotNull() & F.col("usd_rate").isNotNull())
                 .groupBy("currency", F.to_date("rate_date").alias("rate_date")).agg(F.max("usd_rate").alias("usd_rate")))
        around = known.select(
            "currency", "rate_date", "usd_rate", F.lit(rank).alias("rank"), F.lit(name).alias("rate_source"),
            F.explode(F.sequence(F.date_sub("rate_date", tolerance_days), F.date_add("rate_date", tolerance_days))).alias("day"))
        reach = around if reach is None else reach.unionByName(around)
    if reach is None:
        raise ValueError("no rate source given")
    order = F.struct("rank", F.abs(F.datediff("day", "rate_date")).alias("away"), "rate_date", "usd_rate", "rate_source")
    return (reach.groupBy("currency", "day").agg(F.min(order).alias("best"))
            .select("currency", "day", "best.usd_rate", "best.rate_source"))


def with_chained_rate(
    df: DataFrame, calendar: DataFrame, *, currency: str = "original_currency", date: str = "date",
    name: str = "usd_rate", origin: str = "rate_source",
) -> DataFrame:
    """The rate of a ``rate_calendar`` at each row's currency and date, and the source it comes from; null without one."""
    named = calendar.select(F.col("currency").alias(currency), F.col("day").alias("_day"), F.col("usd_rate").alias(name),
                            F.col("rate_source").alias(origin))
    return join_dimension(df.withColumn("_day", F.to_date(date)), named, [currency, "_day"]).drop("_day")


def normalize(
    df: DataFrame, *, amount_column: str = "revenue", currency_column: str | None = None,
    country_column: str = "country", date_column: str = "date", reporting: str = "USD",
    rates: DataFrame | None = None, sources: list[tuple[str, DataFrame]] | None = None, tolerance_days: int = 3,
) -> DataFrame:
    """Add original_currency, revenue_usd, revenue_<reporting>, exchange_rate_usd, rate_source.

    Rates are fixed, or dated by ``rates`` (nearest earlier one), or by ranked ``sources`` (see ``rate_calendar``), whose
    names then stand in ``rate_source`` and, for the reporting currency, in ``target_rate_source``. Where no
    dated rate is found the fixed one counts.
    """
    if rates is not None and sources is not None:
        raise ValueError("give rates or sources, not both")
    if reporting not in dim.REPORTING_CURRENCIES:
        raise ValueError(f"reporting currency must be one of {dim.REPORTING_CURRENCIES}")
    if currency_column and currency_column in df.columns:
        source = F.col(currency_column)
    else:
        source = country_currency(F.col(country_column))
    out = df.withColumn("original_currency", source)
    currency, amount = F.col("original_currency"), F.col(amount_column)
    known = dim.lookup(dim.FALLBACK_USD_RATES, currency)
    fixed_source = F.when(known.isNotNull(), "fallback").otherwise("unknown")
    if sources is not None:
        calendar = rate_calendar(sources, tolerance_days)
        out = with_chained_rate(out, calendar, date=date_column, name="_dated", origin="_origin")
        dated = F.col("_dated").isNotNull() & (currency != "USD")
        usd = F.when(dated, F.col("_dated")).otherwise(fallback_usd_rate(currency))
        origin = F.when(dated, F.col("_origin")).otherwise(fixed_source)
        target_usd = fallback_usd_rate(F.lit(reporting))
        if reporting != "USD":
            out = out.withColumn("_target", F.lit(reporting))
            out = with_chained_rate(out, calendar, currency="_target", date=date_column, name="_target_rate",
                                    origin="target_rate_source")
            target_usd = F.coalesce(F.col("_target_rate"), target_usd)
            out = out.withColumn("target_rate_source", F.coalesce("target_rate_source", F.lit("fallback")))
    elif rates is None:
        usd, origin = fallback_usd_rate(currency), fixed_source
        target_usd = fallback_usd_rate(F.lit(reporting))
    else:
        out = with_dated_rate(out, rates, date=date_column, name="_dated")
        dated = F.col("_dated").isNotNull() & (currency != "USD")
        usd = F.when(dated, F.col("_dated")).otherwise(fallback_usd_rate(currency))
        origin = F.when(dated, "dated").otherwise(fixed_source)
        target_usd = fallback_usd_rate(F.lit(reporting))
        if reporting != "USD":
            out = out.withColumn("_target", F.lit(reporting))
            out = with_dated_rate(out, rates, currency="_target", date=date_column, name="_target_rate")
            target_usd = F.coalesce(F.col("_target_rate"), target_usd)
    out = out.withColumns({
        "revenue_usd": F.when(currency == "USD", amount).otherwise(amount * usd),
        "exchange_rate_usd": F.when(currency == "USD", F.lit(1.0)).otherwise(usd),
        "rate_source": origin,
    })
    if reporting != "USD":
        out = out.withColumn(
            f"revenue_{reporting.lower()}",
            F.when(currency == reporting, amount).otherwise(amount * (usd / target_usd)))
    return out.drop("_dated", "_origin", "_target", "_target_rate")
