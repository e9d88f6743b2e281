"""Joining fact rows with a dimension whose size is not known up front."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 200_000


def join_dimension(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str = "left", *,
    broadcast_rows: int = BROADCAST_ROWS, salts: int = 16,
) -> DataFrame:
    """Join on ``keys``; nulls match nulls.

    The dimension is counted (at most ``broadcast_rows`` + 1 rows are looked at). A small one is
    broadcast. A large one is shuffled with the facts, whose rows are split into ``salts`` shares
    per key so that one hot key does not end in one task; the dimension is repeated per share. It is
    never broadcast: Spark would decide by the size of its files, which knows nothing of the shares.
    """
    keys = list(keys)
    renamed = dimension.select(
        *[F.col(k).alias(f"_dim_{k}") for k in keys],
        *[c for c in dimension.columns if c not in keys],
    )
    matches = [F.col(k).eqNullSafe(F.col(f"_dim_{k}")) for k in keys]
    drop = [f"_dim_{k}" for k in keys]
    if dimension.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return facts.join(F.broadcast(renamed), matches, how).drop(*drop)
    # the input partition decides the share, so equal copies of a row spread too
    left = facts.withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(salts)))
    right = renamed.withColumn("_dim_share", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    matches.append(F.col("_share") == F.col("_dim_share"))
    return left.join(right, matches, how).drop("_share", "_dim_share", *drop)
