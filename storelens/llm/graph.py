"""Connected components and block-wise work on groups, for the operators that link rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

EDGES_PER_TASK = 50_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node that links reach.

    Alternating large-star and small-star rounds: each hangs neighbours on the smallest node known, so a logarithmic
    number of rounds ends in stars. A node with very many links is a hot key of a join whose other side has one row per
    node; that side is stored first, so that adaptive execution can split the hot one.
    """
    rounds, tasks = Scratch(edges.sparkSession, "components"), None

    def keep(df: DataFrame) -> DataFrame:
        return rounds.keep(df if tasks is None else df.coalesce(tasks))
    edges = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before, tasks = state, 2 + state[0] // EDGES_PER_TASK
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        edges = keep(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = keep(edges.groupBy("a").agg(F.min("b").alias("m")))
        down = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = keep(down.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        rounds.forget(rounds.count - 1)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal ``keys``, from batches of rows that stand sorted by these keys."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changes = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            changes |= c[1:] != c[:-1]
        starts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts[:-1], starts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


class Sets:
    """Union-find over small integers, the smallest of a set is its root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
