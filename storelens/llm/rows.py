"""Keys of rows whose ids may repeat or be null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_key(*columns: str) -> Column:
    """128 bits of the columns' values as text: equal for equal rows, nulls included, and for no others by any chance that matters."""
    present = [F.col(c).isNull() for c in columns]
    halves = (F.xxhash64(F.lit(seed), *present, *columns) for seed in (1, 2))
    return F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves])


def absent_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
