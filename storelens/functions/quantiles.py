"""Exact quantiles without holding a column in one task.

``percentile`` keeps every distinct value in one aggregation buffer. Beyond a checked size each wanted position is
enclosed between two values of the column and the enclosure is narrowed: one pass takes approximate percentiles of the
values inside, the next counts the rows around the two that should hold the position. Only comparisons are used, so
infinite values and NaN (the largest, as in the built-in) need no special care, and every pass takes at least its two
bounds out of the enclosure, so it ends. All columns and positions share their passes. Both ways interpolate with
the built-in's formula and give the same doubles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

GRID = 512
ACCURACY = 20_000
# So few values are fetched to read off a position.
FETCH_ROWS = 10_000


@dataclass
class _Target:
    """The value at 0-based ``position`` of a sorted column lies among ``inside`` values strictly between the bounds,
    which ``below`` values precede; a bound of None is open."""
    column: str
    position: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None
    done: bool = False

    def interior(self) -> Column:
        c = F.col(self.column)
        out = c.isNotNull()
        out = out if self.low is None else out & (c > F.lit(self.low))
        return out if self.high is None else out & (c < F.lit(self.high))

    def choose(self, grid: list[float]) -> tuple[float, float]:
        at = (self.position - self.below) / self.inside * GRID
        return grid[max(0, int(at) - 1)], grid[min(GRID, int(at) + 2)]

    def narrow(self, low: float, high: float, counts: tuple[int, int, int, int]) -> None:
        """Counts inside: smaller than ``low``, equal to it, between the two, equal to ``high``."""
        rank = self.position - self.below
        smaller, at_low, between, at_high = counts
        if rank < smaller:
            self.high, self.inside = low, smaller
        elif rank < smaller + at_low:
            self.value, self.done = low, True
        elif rank < smaller + at_low + between:
            self.low, self.high, self.below, self.inside = low, high, self.below + smaller + at_low, between
        elif rank < smaller + at_low + between + at_high:
            self.value, self.done = high, True
        else:
            before = smaller + at_low + between + at_high
            self.low, self.below, self.inside = high, self.below + before, self.inside - before


def _find(df: DataFrame, targets: list[_Target], fetch_rows: int) -> None:
    grid = [i / GRID for i in range(GRID + 1)]
    while active := [t for t in targets if not t.done]:
        few = [t for t in active if t.inside <= fetch_rows]
        many = [t for t in active if t.inside > fetch_rows]
        found = df.agg(*[F.sort_array(F.collect_list(F.when(t.interior(), F.col(t.column)))).alias(f"v{i}") for i, t in enumerate(few)],
                       *[F.percentile_approx(F.when(t.interior(), F.col(t.column)), grid, ACCURACY).alias(f"g{i}") for i, t in enumerate(many)]).first()
        for i, t in enumerate(few):
            t.value, t.done = found[f"v{i}"][t.position - t.below], True
        if not many:
            continue
        chosen, counts = [t.choose(found[f"g{i}"]) for i, t in enumerate(many)], []
        for i, (t, (low, high)) in enumerate(zip(many, chosen)):
            c, inside = F.col(t.column), t.interior()
            counts += [F.count_if(inside & (c < F.lit(low))).alias(f"a{i}"), F.count_if(inside & (c == F.lit(low))).alias(f"b{i}"),
                       F.count_if(inside & (c > F.lit(low)) & (c < F.lit(high))).alias(f"c{i}"),
                       F.count_if(inside & (c == F.lit(high)) & (F.lit(low) != F.lit(high))).alias(f"d{i}")]
        row = df.agg(*counts).first()
        for i, (t, (low, high)) in enumerate(zip(many, chosen)):
            t.narrow(low, high, tuple(row[f"{k}{i}"] for k in "abcd"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], *, max_rows: int = 1_000_000,
    fetch_rows: int = FETCH_ROWS,
) -> dict[str, list[float | None]]:
    """Linear-interpolated exact quantiles per column. Runs jobs; keep ``df`` cheap to re-read."""
    if not columns:
        return {}
    stats = df.agg(*[F.count(c).alias(f"n_{c}") for c in columns]).first()
    sizes = {c: stats[f"n_{c}"] for c in columns}
    small = [c for c in columns if sizes[c] <= max_rows]
    out: dict[str, list[float | None]] = {}
    if small:
        row = df.agg(*[F.percentile(F.col(c).cast("double"), list(probabilities)).alias(c) for c in small]).first()
        out.update({c: row[c] if row[c] is not None else [None] * len(probabilities) for c in small})
    large = [c for c in columns if c not in small]
    if large:
        positions = {c: [(sizes[c] - 1) * p for p in probabilities] for c in large}
        targets = {(c, k): _Target(c, k, sizes[c]) for c in large for at in positions[c]
                   for k in {int(at), min(int(at) + (at > int(at)), sizes[c] - 1)}}
        _find(df.select(*[F.col(c).cast("double").alias(c) for c in large]), list(targets.values()), fetch_rows)
        for c in large:
            out[c] = []
            for at in positions[c]:
                lower, upper = int(at), int(at) + (at > int(at))
                a, b = targets[c, lower].value, targets[c, upper].value
                out[c].append(a if lower == upper or a == b else (upper - at) * a + (at - lower) * b)
    return out
