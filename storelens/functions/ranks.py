"""Rankings that never sort one unbounded group in one task.

A window over (region) puts every store of the largest region in a single task. The functions
here collapse ties first, then cut each group into range slices of (group, value); a rank is the
slice's offset plus the position inside the slice. Only frames whose largest group was counted and
found small take the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .materialize import checkpointed

# A group with at most this many distinct values is ranked by one window.
WINDOW_ROWS = 1_000_000

_EVERYTHING = "_one_group"


def _counts(base: DataFrame, group: list[str], value: str) -> DataFrame:
    return base.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))


def _running(counts: DataFrame, group: list[str], order: Column) -> DataFrame:
    w = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return (counts
            .withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
            .withColumn("_dense", F.row_number().over(W.partitionBy(*group).orderBy(order)).cast("bigint")))


def _sliced(counts: DataFrame, group: list[str], order: Column, slice_rows: int, total: int) -> DataFrame:
    slices = max(2, -(-total // slice_rows) * 2)
    # the slice number is stored before it is used twice, so both uses see the same cut
    cut = checkpointed(
        counts.repartitionByRange(slices, *[F.col(g) for g in group], order)
        .withColumn("_slice", F.spark_partition_id())
    )
    inner = _running(cut, [*group, "_slice"], order)
    totals = cut.groupBy(*group, "_slice").agg(
        F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    # at most one row per slice and group
    w = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *group, "_slice",
        F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_values").over(w), F.lit(0)).alias("_values_before"),
    )
    return (inner.join(offsets, [*group, "_slice"])
            .withColumn("_before", F.col("_before") + F.col("_rows_before"))
            .withColumn("_dense", F.col("_dense") + F.col("_values_before"))
            .drop("_slice", "_rows_before", "_values_before"))


def rank_table(
    stored: DataFrame, group: Sequence[str], value: str, *, ascending: bool = False,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """(group, value, _n, _before, _dense): rows that tie, rows before them, dense number.

    ``stored`` is read more than once and must be cheap to read (a checkpoint or a table). The
    size of its largest group, in distinct values, decides between the window and the sliced way.
    """
    group = list(group)
    keys = group or [_EVERYTHING]
    keyed = stored if group else stored.withColumn(_EVERYTHING, F.lit(0))
    counts = _counts(keyed, keys, value)
    order = F.col(value).asc() if ascending else F.col(value).desc()
    # a frame this small has no large group; only beyond that are the groups counted
    if stored.limit(window_rows + 1).count() > window_rows:
        sizes = (counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                 .agg(F.max("n").alias("largest"), F.sum("n").alias("total")).first())
        if sizes["largest"] > window_rows:
            return _sliced(counts, keys, order, window_rows, sizes["total"])
    return _running(counts, keys, order)


def with_rank(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    *,
    ascending: bool = False,
    rank: str | None = None,
    dense_rank: str | None = None,
    percentile: str | None = None,
    window_rows: int = WINDOW_ROWS,
    is_stored: bool = False,
) -> DataFrame:
    """Add ``rank``, ``dense_rank`` and/or an average-rank ``percentile`` of ``value`` in ``group``.

    ``value`` must not be null. ``df`` should be at its final grain (stores, days); it is stored
    once unless it already is.
    """
    base = df if is_stored else checkpointed(df)
    return join_ranks(base, rank_table(base, group, value, ascending=ascending, window_rows=window_rows),
                      group, value, rank=rank, dense_rank=dense_rank, percentile=percentile)


def join_ranks(
    df: DataFrame, ranked: DataFrame, group: Sequence[str], value: str, *,
    rank: str | None = None, dense_rank: str | None = None, percentile: str | None = None,
) -> DataFrame:
    group = list(group)
    keys = group or [_EVERYTHING]
    keyed = df if group else df.withColumn(_EVERYTHING, F.lit(0))
    out = keyed.join(ranked.select(*keys, value, "_n", "_before", "_dense"), [*keys, value])
    if rank:
        out = out.withColumn(rank, F.col("_before") + 1)
    if dense_rank:
        out = out.withColumn(dense_rank, F.col("_dense"))
    if percentile:
        # ties share the mean of the ranks they cover
        sizes = ranked.groupBy(*keys).agg(F.sum("_n").alias("_size"))
        out = out.join(sizes, keys).withColumn(
            percentile, (F.col("_before") + (F.col("_n") + 1) / 2) / F.col("_size"))
    extras = [c for c in (rank, dense_rank, percentile) if c]
    return out.select(*df.columns, *extras)


def top_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, *,
    number: str = "row_number", salts: int | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1.

    Spark cuts each group to ``n`` rows inside every map task. With many map tasks that is still a
    lot for one reducer, so groups are then cut in ``salts`` shares before the last step, whose
    task sees at most ``n * salts`` rows of a group. By default the shares follow the width of the
    cluster's shuffles; a narrow one (a test) needs none.
    """
    group = list(group)
    if salts is None:
        salts = min(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 50)
    if salts > 1:
        df = _first_per_share(df, group, order, n, salts)
    return (df.withColumn(number, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
            .where(F.col(number) <= n))


def _first_per_share(df: DataFrame, group: list[str], order: Sequence[Column], n: int, salts: int) -> DataFrame:
    # the input partition, so equal copies spread too and a retried task repeats its shares
    return (df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
            .withColumn("_rn", F.row_number().over(W.partitionBy(*group, "_salt").orderBy(*order)))
            .where(F.col("_rn") <= n).drop("_rn", "_salt"))
