"""Data cleaning with a quality report.

The report is a long table (check, column, metric, value). Its figures come from one wide
aggregate per stage, not one job per column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions.joins import BROADCAST_ROWS, join_dimension
from ..functions.materialize import checkpointed, stored
from ..functions.quantiles import exact_quantiles

REPORT_SCHEMA = "check string, column string, metric string, value double"
UNKNOWN = "UNKNOWN"
WHITESPACE = " \t\n\r\f\x0b"
NEGATIVE_MODES = ("absolute", "zero", "raise", "keep")


@dataclass(frozen=True)
class CleanConfig:
    """Cleaning limits and switches."""

    revenue_max: float = 1_000_000.0
    handle_negative: str = "absolute"
    quantity_min: float = 1.0
    quantity_max: float = 10_000.0
    min_date: dt.date = dt.date(2020, 1, 1)
    max_date: dt.date | None = None
    deduplicate: bool = True
    dedupe_keys: tuple[str, ...] = ("store_id", "date", "product_id")
    detect_outliers: bool = True
    outlier_method: str = "iqr"
    outlier_threshold: float = 1.5
    zscore_limit: float = 3.0
    fill_missing_dates: bool = True
    max_gap_days: int = 30
    interpolate_missing: bool = False
    order_by: str = "ingest_ord"
    keep_case: tuple[str, ...] = ("source_file",)

    def with_(self, **changes) -> "CleanConfig":
        return replace(self, **changes)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def _named(df: DataFrame, *parts: str) -> list[str]:
    return [c for c in numeric_columns(df) if any(p in c.lower() for p in parts)]


def revenue_columns(df: DataFrame) -> list[str]:
    return _named(df, "revenue", "sales")


def quantity_columns(df: DataFrame) -> list[str]:
    return _named(df, "qty", "quantity")


SLICE_ROWS = 2_000_000


# duplicates -----------------------------------------------------------------------------------

def drop_exact_copies(df: DataFrame, order_by: str | None = "ingest_ord") -> DataFrame:
    """Rows equal in every column but ``order_by`` become one, the earliest.

    A grouped minimum: copies are merged inside the map tasks, before anything is shuffled.
    """
    if not order_by or order_by not in df.columns:
        return df.dropDuplicates()
    content = [c for c in df.columns if c != order_by]
    return df.groupBy(*content).agg(F.min(order_by).alias(order_by)).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: str = "ingest_ord") -> DataFrame:
    """The earliest row of each key (null keys count as equal).

    Keys and order alone tell which keys occur more than once and where they begin. Only the rows at those beginnings are
    compared further (of several there one stays); all other rows pass where they are, unsorted. Repeated keys too many to
    be sent to every task are not joined at all: then all rows are shuffled once by key, each map task keeping one of a key.
    """
    several = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"), F.min(order_by).alias("_begin"))
                     .where("_times > 1"), "repeated-keys")
    if several.isEmpty():
        return df
    if several.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return df.withColumn("_place", F.row_number().over(W.partitionBy(*keys).orderBy(order_by))).where("_place = 1").drop("_place")
    marked = join_dimension(df, several, keys)
    begins = marked.where(F.col("_times").isNotNull() & F.col(order_by).eqNullSafe(F.col("_begin")))
    first = begins.withColumn("_place", F.row_number().over(W.partitionBy(*keys).orderBy(order_by))).where("_place = 1")
    return marked.where(F.col("_times").isNull()).select(*df.columns).unionByName(first.select(*df.columns))


def remove_duplicates(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    keys = [k for k in config.dedupe_keys if k in df.columns]
    if len(keys) == len(config.dedupe_keys) and keys:
        # the earliest row of a key is never a later copy, so one step removes both kinds
        return first_per_key(df, keys, config.order_by)
    return drop_exact_copies(df, config.order_by)


def duplicate_counts(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """One row: exact copies and later rows of a key."""
    content = [c for c in df.columns if c != config.order_by]
    keys = [k for k in config.dedupe_keys if k in df.columns]
    # two hashes stand for the whole row, so a few fixed-width columns are shuffled and not the wide rows
    hashes = {"_h1": F.xxhash64(*content), "_h2": F.xxhash64(F.lit(7), *content)}
    by_key = len(keys) == len(config.dedupe_keys) and bool(keys)
    copies = df.select(*(keys if by_key else ()), *[h.alias(n) for n, h in hashes.items()]).groupBy(
        *(keys if by_key else ()), *hashes).agg(F.count(F.lit(1)).alias("_rows"))
    if by_key:
        per_key = copies.groupBy(*keys).agg(
            F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_distinct"))
        fuzzy = F.sum("_distinct") - F.count(F.lit(1))
        rows, distinct = F.sum("_rows"), F.sum("_distinct")
    else:
        per_key, fuzzy = copies, F.lit(0)
        rows, distinct = F.sum("_rows"), F.count(F.lit(1))
    return per_key.agg(
        F.coalesce(rows, F.lit(0)).alias("initial_rows"),
        F.coalesce(rows - distinct, F.lit(0)).alias("exact_removed"),
        F.coalesce(fuzzy, F.lit(0)).alias("fuzzy_removed"),
        F.coalesce(rows - distinct + fuzzy, F.lit(0)).alias("total_removed"))


# missing values -------------------------------------------------------------------------------

def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of nulls per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def fill_missing(df: DataFrame, exclude: Sequence[str] = ("ingest_ord",)) -> DataFrame:
    """Numbers become 0, texts UNKNOWN; dates stay null."""
    numbers = numeric_columns(df, exclude)
    texts = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.StringType) and f.name not in exclude]
    return df.fillna(0, subset=numbers).fillna(UNKNOWN, subset=texts)


def interpolate(df: DataFrame, columns: Sequence[str], order_by: str = "ingest_ord",
                slices: int | None = None) -> DataFrame:
    """Linear interpolation by row position over the whole frame's order.

    Nulls before the first value stay null, nulls after the last value repeat it. The rows are cut
    into ordered slices; what a slice needs from its neighbours is one small row per slice.
    """
    n = slices or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // SLICE_ROWS))
    # the place in a sorted slice without a window: the number of the slice in the upper bits, from 0 in the 33 lower ones
    cut = df.repartitionByRange(n, order_by).sortWithinPartitions(order_by).withColumn("_place", F.monotonically_increasing_id())
    placed = stored(cut.select(*df.columns, F.shiftright("_place", 33).cast("int").alias("_slice"),
                               (F.col("_place").bitwiseAND((1 << 33) - 1) + 1).alias("_pos")), "interpolate")
    ends = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        at = F.when(F.col(c).isNotNull(), F.col("_pos"))
        ends += [F.min_by(F.struct(F.col("_pos").alias("p"), F.col(c).alias("v")), at).alias(f"_first_{c}"),
                 F.max_by(F.struct(F.col("_pos").alias("p"), F.col(c).alias("v")), at).alias(f"_last_{c}")]
    # one row per slice from here
    summary = placed.groupBy("_slice").agg(*ends)
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy(F.col("_slice").desc()).rowsBetween(W.unboundedPreceding, -1)
    summary = summary.withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    carried = []
    for c in columns:
        for kind in ("first", "last"):
            e = F.col(f"_{kind}_{c}")
            summary = summary.withColumn(f"_{kind}_{c}", F.when(
                e.isNotNull(), F.struct((e.p + F.col("_base")).alias("p"), e.v.cast("double").alias("v"))))
        carried += [F.last(f"_last_{c}", True).over(before).alias(f"_prev_{c}"),
                    F.last(f"_first_{c}", True).over(after).alias(f"_next_{c}")]
    summary = summary.select("_slice", "_base", *carried)
    out = placed.join(F.broadcast(summary), "_slice").withColumn("_pos", F.col("_pos") + F.col("_base"))
    # by the place, which sorts as the order does and is a plain number
    back = W.partitionBy("_slice").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    # the same running frame from the other end: a frame that shrinks from the left is quadratic
    ahead = W.partitionBy("_slice").orderBy(F.col("_pos").desc()).rowsBetween(W.unboundedPreceding, 0)
    here = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(c).cast("double").alias("v"))) for c in columns}
    # one sort for all columns each way
    out = out.withColumns({f"_p_{c}": F.coalesce(F.last(h, True).over(back), F.col(f"_prev_{c}")) for c, h in here.items()})
    out = out.withColumns({f"_n_{c}": F.coalesce(F.last(h, True).over(ahead), F.col(f"_next_{c}")) for c, h in here.items()})

    def filled(c: str) -> Column:
        p, following = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        slope = (following.v - p.v) / (following.p - p.p)
        return (F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
                .when(p.isNull(), F.lit(None).cast("double"))
                .when(following.isNull(), p.v)
                .otherwise(p.v + slope * (F.col("_pos") - p.p)))
    return out.withColumns({c: filled(c) for c in columns}).select(*df.columns)


# ranges and dates -----------------------------------------------------------------------------

def handle_negatives(df: DataFrame, mode: str = "absolute") -> DataFrame:
    """Negative amounts become positive, zero, an error, or stay."""
    if mode not in NEGATIVE_MODES:
        raise ValueError(f"handle_negative must be one of {NEGATIVE_MODES}")
    if mode == "keep":
        return df
    changes = {}
    for c in revenue_columns(df):
        v = F.col(c)
        changes[c] = {
            "absolute": F.abs(v),
            "zero": F.when(v < 0, F.lit(0).cast(df.schema[c].dataType)).otherwise(v),
            "raise": F.when(v < 0, F.raise_error(F.lit(f"negative {c} values found"))).otherwise(v),
        }[mode]
    return df.withColumns(changes) if changes else df


def _range_checks(df: DataFrame, config: CleanConfig) -> dict[tuple[str, str], Column]:
    checks: dict[tuple[str, str], Column] = {}
    for c in revenue_columns(df):
        v = F.col(c)
        level = F.abs(v) if config.handle_negative == "absolute" else v
        checks[(c, "negative")] = F.count_if(v < 0)
        checks[(c, "too_high")] = F.count_if(level > config.revenue_max)
    for c in quantity_columns(df):
        checks[(c, "below_min")] = F.count_if(F.col(c) < config.quantity_min)
        checks[(c, "above_max")] = F.count_if(F.col(c) > config.quantity_max)
    return checks


def _date_checks(df: DataFrame, config: CleanConfig) -> dict[tuple[str, str], Column]:
    newest = F.lit(config.max_date) if config.max_date else F.current_timestamp()
    checks: dict[tuple[str, str], Column] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType)):
            checks[(f.name, "future_dates")] = F.count_if(F.col(f.name) > newest)
            checks[(f.name, "too_old_dates")] = F.count_if(F.col(f.name) < F.lit(config.min_date))
    return checks


def range_counts(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """One row: negatives and too high per revenue column, below/above per quantity column."""
    return df.agg(*[e.alias(f"{c}_{m}") for (c, m), e in _range_checks(df, config).items()])


def date_counts(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """One row: dates after the limit (default now) and before the minimum, per zone-less date column."""
    return df.agg(*[e.alias(f"{c}_{m}") for (c, m), e in _date_checks(df, config).items()])


# outliers -------------------------------------------------------------------------------------

def outlier_bounds(df: DataFrame, columns: Sequence[str], config: CleanConfig = CleanConfig()
                   ) -> dict[str, tuple[float, float]]:
    """Lower and upper bound per column with more than two distinct values."""
    stats = df.agg(*[a for c in columns for a in (
        F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}"),
        F.avg(c).cast("double").alias(f"avg_{c}"), F.stddev_pop(c).alias(f"std_{c}"))]).first()
    spread = [c for c in columns if stats[f"lo_{c}"] is not None and stats[f"lo_{c}"] < stats[f"hi_{c}"]]
    if spread:
        # a third value exists exactly when something lies strictly between the extremes
        between = df.agg(*[F.max((F.col(c) > stats[f"lo_{c}"]) & (F.col(c) < stats[f"hi_{c}"])).alias(c)
                           for c in spread]).first()
        spread = [c for c in spread if between[c]]
    bounds = {}
    if config.outlier_method == "iqr":
        for c, (q1, q3) in exact_quantiles(df, spread, [0.25, 0.75]).items():
            reach = config.outlier_threshold * (q3 - q1)
            bounds[c] = (q1 - reach, q3 + reach)
    elif config.outlier_method == "zscore":
        for c in spread:
            reach = config.zscore_limit * stats[f"std_{c}"]
            bounds[c] = (stats[f"avg_{c}"] - reach, stats[f"avg_{c}"] + reach)
    else:
        raise ValueError("outlier_method must be iqr or zscore")
    return bounds


def _outside(c: str, bounds: tuple[float, float]) -> Column:
    return (F.col(c) < bounds[0]) | (F.col(c) > bounds[1])


def outlier_counts(df: DataFrame, columns: Sequence[str], config: CleanConfig = CleanConfig()) -> DataFrame:
    """(column, outliers) per numeric column with more than two distinct values. Flags only."""
    bounds = outlier_bounds(df, columns, config)
    if not bounds:
        return df.sparkSession.createDataFrame([], "column string, outliers bigint")
    wide = df.agg(*[F.count_if(_outside(c, b)).alias(c) for c, b in bounds.items()])
    return wide.unpivot([], list(bounds), "column", "outliers")


def flag_outliers(df: DataFrame, columns: Sequence[str], config: CleanConfig = CleanConfig()) -> DataFrame:
    """Add ``<column>_outlier`` flags; no row is removed."""
    bounds = outlier_bounds(df, columns, config)
    return df.withColumns({f"{c}_outlier": F.coalesce(_outside(c, b), F.lit(False)) for c, b in bounds.items()})


# calendar gaps --------------------------------------------------------------------------------

def gap_stores(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Stores whose gaps are filled: three rows or more and 1 to max_gap_days - 1 missing days."""
    days = (df.where(F.col("store_id").isNotNull())
            .groupBy("store_id", F.to_date("date").alias("date"))
            .agg(F.count(F.lit(1)).alias("_rows"), F.max(config.order_by).alias("_last")))
    per_store = days.groupBy("store_id").agg(
        F.sum("_rows").alias("_rows"), F.min("date").alias("_from"), F.max("date").alias("_to"),
        F.count("date").alias("_days"), F.max("_last").alias("_last"))
    gap = F.datediff("_to", "_from") + 1 - F.col("_days")
    return per_store.where((F.col("_rows") >= 3) & (gap > 0) & (gap < config.max_gap_days))


def fill_missing_dates(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Repeat each store's last row on its missing days, marked ``is_interpolated``.

    Stores are chosen before any calendar is built, so a calendar never spans a long gap.
    """
    if "date" not in df.columns or "store_id" not in df.columns:
        return df
    chosen = gap_stores(df, config)
    calendar = chosen.select("store_id", F.explode(F.sequence("_from", "_to")).alias("_day"))
    present = df.select("store_id", F.to_date("date").alias("_day")).distinct()
    missing = calendar.join(present, ["store_id", "_day"], "left_anti")
    last = chosen.select("store_id", F.col("_last").alias("_ord"))
    template = (df.join(last, (df["store_id"] == last["store_id"]) & (df[config.order_by] == last["_ord"]))
                .drop(last["store_id"]).drop("_ord"))
    kind = df.schema["date"].dataType
    added = (missing.join(template, "store_id")
             .withColumn("date", F.col("_day").cast(kind)).drop("_day")
             .select(*df.columns).withColumn("is_interpolated", F.lit(True)))
    return df.withColumn("is_interpolated", F.lit(False)).unionByName(added)


# text -----------------------------------------------------------------------------------------

def text_columns(df: DataFrame, config: CleanConfig = CleanConfig()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
            and "id" not in f.name.lower() and "sku" not in f.name.lower()
            and f.name not in (*config.keep_case, config.order_by)]


def standardize_text(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Upper-case and trim texts, except names with ``id`` or ``sku`` and the ``keep_case`` list."""
    changes = {c: F.btrim(F.upper(F.col(c)), F.lit(WHITESPACE)) for c in text_columns(df, config)}
    return df.withColumns(changes) if changes else df


# the whole step -------------------------------------------------------------------------------

def _long(wide: DataFrame, check: str, names: dict[str, tuple[str, str]]) -> DataFrame:
    """One wide row to (check, column, metric, value) rows."""
    entries = [F.struct(F.lit(c).cast("string").alias("column"), F.lit(m).alias("metric"),
                        F.col(n).cast("double").alias("value")) for n, (c, m) in names.items()]
    return wide.select(F.lit(check).alias("check"), F.inline(F.array(*entries)))


def clean(df: DataFrame, config: CleanConfig = CleanConfig()) -> tuple[DataFrame, DataFrame]:
    """Run all steps in order; return the cleaned frame and the quality report."""
    out, report = clean_steps(df, config)
    return out, report()


def clean_steps(df: DataFrame, config: CleanConfig = CleanConfig()) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The cleaned frame, and what makes the quality report: its passes over the rows run only where it is called.

    The deduplicated frame is stored once, because the report and the remaining steps read it.
    """
    deduped = stored(remove_duplicates(df, config) if config.deduplicate else df, "deduplicated")
    numbers = numeric_columns(deduped, [config.order_by])
    filled = fill_missing(deduped, [config.order_by])
    if config.interpolate_missing:
        filled = fill_missing(interpolate(deduped, numbers, config.order_by), [config.order_by, *numbers])
    positive = handle_negatives(filled, config.handle_negative)
    out = fill_missing_dates(positive, config) if config.fill_missing_dates else positive
    out = standardize_text(out, config)
    return out, lambda: _report(df, deduped, filled, positive, out, config)


def _report(df: DataFrame, deduped: DataFrame, filled: DataFrame, positive: DataFrame, out: DataFrame,
            config: CleanConfig) -> DataFrame:
    """The quality report from the frames that the steps leave behind."""
    parts: list[DataFrame] = []
    start = checkpointed(duplicate_counts(df, config))  # one row, read by two parts of the report
    names = {n: (None, n) for n in ("exact_removed", "fuzzy_removed", "total_removed")}
    if config.deduplicate:
        parts.append(_long(start, "duplicates", names))
    counted = [c for c in deduped.columns if c != config.order_by]
    checks = {**_range_checks(filled, config), **_date_checks(filled, config)}
    # nulls, ranges and dates from one pass: what was null is marked before it is filled
    missing = {f"_null_{c}": F.count_if(F.col(f"_null_{c}")).alias(f"_null_{c}") for c in counted}
    figures = [F.count(F.lit(1)).alias("_rows"), *[e.alias(f"{c}_{m}") for (c, m), e in checks.items()]]
    if config.interpolate_missing:
        nulls, wide = deduped.withColumns({f"_null_{c}": F.col(c).isNull() for c in counted}).agg(*missing.values()), filled.agg(*figures)
    else:
        marked = deduped.withColumns({f"_null_{c}": F.col(c).isNull() for c in counted})
        wide = checkpointed(fill_missing(marked, [config.order_by]).agg(*missing.values(), *figures))  # read by three parts of the report
        nulls = wide
    parts.append(_long(nulls, "missing_values", {f"_null_{c}": (c, "missing") for c in counted}))
    ranges = {f"{c}_{m}": (c, m) for c, m in _range_checks(filled, config)}
    dates = {f"{c}_{m}": (c, m) for c, m in _date_checks(filled, config)}
    if ranges:
        parts.append(_long(wide, "range_validation", ranges))
    if dates:
        parts.append(_long(wide, "date_validation", dates))
    if config.detect_outliers:
        parts.append(outlier_counts(positive, numeric_columns(deduped, [config.order_by]), config).select(
            F.lit("outlier_detection").alias("check"), "column", F.lit(config.outlier_method).alias("metric"),
            F.col("outliers").cast("double").alias("value")))
    if config.fill_missing_dates:
        added = gap_stores(positive, config).agg(F.coalesce(F.sum(
            F.datediff("_to", "_from") + 1 - F.col("_days")), F.lit(0)).alias("filled_count"))
        parts.append(_long(added, "missing_dates_filled", {"filled_count": (None, "filled_count")}))
    totals = start.select(F.col("initial_rows").alias("initial_rows")).withColumn(
        "final_rows", out.agg(F.count(F.lit(1))).scalar())
    totals = totals.withColumns({
        "rows_removed": F.col("initial_rows") - F.col("final_rows"),
        "retention_rate": F.coalesce(F.try_divide(
            F.col("final_rows").cast("double"), F.col("initial_rows").cast("double")), F.lit(0.0))})
    parts.append(_long(totals, "summary", {n: (None, n) for n in totals.columns}))
    return reduce(lambda a, b: a.unionByName(b), parts)
