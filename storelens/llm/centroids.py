"""Nearest-centroid clustering of whole-number vectors through scalar lookup tables.

Components are scaled and floored once. In each round, for every dimension, the squared difference between every value
that occurs and every centroid is tabulated; the distance of a vector to a centroid is then a gather from these tables
and a sum, in whole numbers. The tables hold the values that occur in the batch at hand, so their size is bounded by
the batch and not by the data. Sums of a cluster leave a task as one row per cluster and dimension, so a round shuffles
k * dims rows per task whatever the sizes of the clusters; the driver sees k * dims numbers.

Defined results: vectors that are null, of another number of components, or with null or non-finite components are left
out, and so are those with a component whose scaled value is ``LARGEST`` or more in size, whose squared distance might
not fit a long. Equal rows are vectors of their own. Vectors without an id hash as an empty id. With fewer vectors than
centroids every vector is a centroid at the start; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

LARGEST = 1 << 27
BATCH = 8192


def scaled(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, q array<int>) of the vectors (vec_id, embedding) that take part."""
    e = F.col("embedding")
    fits = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < LARGEST))
    return vectors.select("vec_id", "embedding").where(e.isNotNull()).where(F.size(e) == dims).where(fits).select(
        "vec_id", F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("q"))


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of seed and id, as whole numbers."""
    name = F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    drawn = rows.select(F.sha2(name, 256).alias("h"), "q").orderBy("h", "q").limit(k).collect()
    return np.array([r.q for r in drawn], np.int64)


def tabulate(column: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For one dimension: the row of each vector in the table, and the table (occurring value, centroid) of squared differences."""
    low = int(column.min())
    if int(column.max()) - low <= 4 * len(column) + 1024:
        occurs = np.zeros(int(column.max()) - low + 1, bool)
        occurs[column - low] = True
        values = np.flatnonzero(occurs) + low
        row = (np.cumsum(occurs) - 1)[column - low]
    else:
        values, row = np.unique(column, return_inverse=True)
    difference = values[:, None].astype(np.int64) - centres[None, :]
    return row, difference * difference


def distances(q: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(vectors, centroids) squared distances, one table per dimension."""
    out = np.zeros((len(q), len(centroids)), np.int64)
    for d in range(q.shape[1]):
        row, table = tabulate(q[:, d], centroids[:, d])
        out += table[row]
    return out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _slices(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH):
            yield batch.slice(a, BATCH)


def _sums(rows: DataFrame, centroids: np.ndarray, dims: int) -> DataFrame:
    """(cluster, dim, total, n): exact sums of the vectors nearest to each centroid, one row per cluster and dimension."""
    k = len(centroids)

    def work(batches):
        totals, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for part in _slices(batches):
            q = _matrix(part.column("q"), dims)
            nearest = distances(q, centroids).argmin(axis=1)
            order = np.argsort(nearest, kind="stable")
            here, begins, sizes = np.unique(nearest[order], return_index=True, return_counts=True)
            totals[here] += np.add.reduceat(q[order].astype(np.int64), begins, axis=0)
            counts[here] += sizes
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
            np.repeat(some, dims), np.tile(np.arange(dims), len(some)), totals[some].ravel(), np.repeat(counts[some], dims))],
            ["cluster", "dim", "total", "n"])
    parts = rows.select("q").mapInArrow(work, "cluster long, dim long, total long, n long")
    return parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256,
            seed: str = "2:") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of each vector that takes part, the final centroids)."""
    scratch = Scratch(vectors.sparkSession, "centroids")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = scratch.keep(scaled(vectors, dims, scale))
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        moved = centroids.copy()
        for r in _sums(rows, centroids, dims).collect():  # k * dims rows
            moved[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
        centroids = moved
    final = centroids

    def assign(batches):
        for part in _slices(batches):
            far = distances(_matrix(part.column("q"), dims), final)
            nearest = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(nearest.astype(np.int32)), pa.array(far[np.arange(len(far)), nearest])],
                ["vec_id", "cluster", "distance"])
    assigned = scratch.keep(rows.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"))
    scratch.forget(scratch.count - 1)
    return assigned, final


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    sums = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}  # a row per centroid
    facts = spark.createDataFrame(
        [(c, int(sums.get(c, 0)), int(sum(sums.values())), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
         for c, v in enumerate(centroids.tolist())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
