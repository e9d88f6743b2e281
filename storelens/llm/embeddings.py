"""Near-duplicate embeddings through a pivot-permutation index.

Reference vectors (pivots) come from a bounded sample; each vector is described by its nearest pivots in order of
distance. The index has an inverted list per pair of pivots, so that vectors in one list share two pivots at least;
a pair is verified by its cosine in double precision in the list of the two smallest pivots it shares, and nowhere else.
Long lists are cut into blocks and pairs of blocks, which spread over tasks; inside a block pairs are counted and
joined to sets, never written out as rows. Equal vectors are one entry of the index with a number of copies.

Vectors are compared with those of their own length, so every length has pivots and lists of its own. The pivots are
the documented bound: a sample of about ``SAMPLE`` vectors, shared out among the ``MOST_LENGTHS`` most frequent lengths,
of which at most ``MOST_PIVOTS`` per length stay. Rarer lengths have one list each, compared whole in blocks. Every
vector is indexed. Recall against brute force is measured in the tests (at least 0.9 is asked; about 1 is reached).

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing;
components are doubles of any size, as a vector is scaled by its largest before its norm is taken; repeated rows are
vectors of their own, also under one id; rows without an id take part in the links of others and have no component
where no row has an id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import Sets, components, runs
from .scratch import kept

SAMPLE = 8192
MOST_PIVOTS = 2048
MOST_LENGTHS = 32
LEAST_SAMPLE = 256
NEAREST = 7
BLOCK = 256


def choose_pivots(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` unit vectors of ``sample``, none close to another: copies in the sample make one pivot."""
    taken: list[np.ndarray] = []
    for v in sample:
        if len(taken) == wanted:
            break
        if not taken or float(np.max(np.asarray(taken) @ v)) < 0.8:
            taken.append(v)
    return np.asarray(taken)


def describe(unit: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of the ``nearest`` pivots of each row, nearest first."""
    sims = unit @ pivots.T
    k = min(nearest, pivots.shape[0])
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < pivots.shape[0] else np.tile(np.arange(k), (len(unit), 1))
    order = np.argsort(-np.take_along_axis(sims, top, axis=1), axis=1, kind="stable")
    return np.take_along_axis(top, order, axis=1).astype(np.int64)


def pair_keys(top: np.ndarray, n_pivots: int) -> np.ndarray:
    """Per row the inverted lists it stands in: one per pair of its pivots."""
    ordered = np.sort(top, axis=1)
    i, j = np.triu_indices(top.shape[1], 1)
    return ordered[:, i] * n_pivots + ordered[:, j]


def first_shared_key(a: np.ndarray, b: np.ndarray, n_pivots: int) -> np.ndarray:
    """For rows of pivots ``a`` and ``b``, the list of the two smallest pivots they share."""
    shared = (a[:, :, None] == b[:, None, :]).any(axis=2)
    ordered = np.sort(np.where(shared, a, n_pivots), axis=1)
    return ordered[:, 0] * n_pivots + ordered[:, 1]


def _unit(vectors: pa.Array, dim: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _pivots_by_length(classes: DataFrame, sample: int, most_pivots: int) -> dict[int, np.ndarray]:
    """Pivots of the most frequent lengths, from samples whose sizes add up to about ``sample``."""
    lengths = classes.groupBy("dim").agg(F.sum("copies").alias("n"), F.count("*").alias("k")).orderBy(F.desc("n"), "dim").limit(MOST_LENGTHS).collect()
    total = sum(r["n"] for r in lengths)
    wanted = {r["dim"]: max(LEAST_SAMPLE, sample * r["n"] // total) for r in lengths}
    if not lengths:
        return {}
    share = F.create_map(*[F.lit(x) for r in lengths for x in (r["dim"], min(1 << 20, (wanted[r["dim"]] << 20) // r["k"] + 1))])
    drawn = classes.where(F.pmod("k2", F.lit(1 << 20)) < F.coalesce(F.try_element_at(share, "dim"), F.lit(0))).select("dim", "k1", "embedding").toArrow()
    out = {}
    for r in lengths:
        mine = drawn.filter(pc.equal(drawn.column("dim"), r["dim"])).sort_by("k1").slice(0, wanted[r["dim"]])
        if mine.num_rows:
            points = _unit(mine.column("embedding").combine_chunks(), r["dim"])
            out[r["dim"]] = choose_pivots(points, int(min(most_pivots, max(64, np.sqrt(r["n"])))))
    return out


def link(vectors: DataFrame, threshold: float = 0.95, nearest: int = NEAREST, sample: int = SAMPLE,
         most_pivots: int = MOST_PIVOTS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    e = F.col("embedding")
    usable = F.coalesce(e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                        & F.exists(e, lambda x: x != 0), F.lit(False))
    kind = "array<float>" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "array<double>"
    rows = kept(vectors.select("vec_id", e.cast(kind).alias("embedding")).select(
        "vec_id", "embedding", F.when(usable, F.size(e)).alias("dim"),
        F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(7), "embedding").alias("k2")))
    classes = kept(rows.where("dim is not null").groupBy("dim", "k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")))
    by_length = _pivots_by_length(classes, sample, most_pivots)
    pivots = spark.sparkContext.broadcast(by_length)
    sizes = {dim: len(p) for dim, p in by_length.items()}

    def index(batches):
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                for dim in pc.unique(part.column("dim")).to_pylist():
                    mine = part.filter(pc.equal(part.column("dim"), dim))
                    if sizes.get(dim, 1) > 1:
                        top = describe(_unit(mine.column("embedding"), dim), pivots.value[dim], nearest)
                        keys = pair_keys(top, sizes[dim])
                    else:  # one list of all
                        top, keys = np.zeros((mine.num_rows, 2), np.int64), np.zeros((mine.num_rows, 1), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [mine.column(c) for c in ("dim", "k1", "k2", "copies", "embedding")] + [
                            pa.array(list(np.sort(top, axis=1)), pa.list_(pa.int64())), pa.array(list(keys), pa.list_(pa.int64()))],
                        ["dim", "k1", "k2", "copies", "embedding", "top", "keys"])
    described = kept(classes.select("dim", "k1", "k2", "copies", "embedding").mapInArrow(
        index, f"dim int, k1 long, k2 long, copies long, embedding {kind}, top array<long>, keys array<long>"))
    lists = kept(described.select("dim", F.explode("keys").alias("key")).groupBy("dim", "key").agg(F.count("*").alias("n")).where("n > 1"))
    entries = described.select("dim", "k1", "k2", "copies", "embedding", "top", F.explode("keys").alias("key")).join(lists, ["dim", "key"])
    cut = F.ceil(F.col("n") / block).cast("int")
    entries = entries.withColumn("own", F.pmod("k1", cut).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), cut - 1))).select(
        "dim", "key", F.least("own", "other").alias("left_block"), F.greatest("own", "other").alias("right_block"), "own",
        "k1", "k2", "copies", "embedding", "top")
    keys = ["dim", "key", "left_block", "right_block"]

    def verify(batches):
        for table in runs(batches, keys):
            if table.num_rows < 2:
                continue
            t = table.combine_chunks()
            dim, key, left, right = (t.column(c)[0].as_py() for c in keys)
            n_pivots = sizes.get(dim, 1)
            unit = _unit(t.column("embedding").combine_chunks(), dim)
            own = t.column("own").to_numpy()
            if left == right:
                a, b = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
            else:
                li, ri = np.flatnonzero(own == left), np.flatnonzero(own == right)
                a, b = np.nonzero(unit[li] @ unit[ri].T >= threshold)
                a, b = li[a], ri[b]
            if not len(a):
                continue
            top = t.column("top").combine_chunks().flatten().to_numpy().reshape(len(unit), -1)
            here = np.concatenate([first_shared_key(top[a[i:i + 50_000]], top[b[i:i + 50_000]], n_pivots) == key
                                   for i in range(0, len(a), 50_000)]) if n_pivots > 1 else np.ones(len(a), bool)
            a, b = a[here], b[here]
            if not len(a):
                continue
            copies = t.column("copies").to_numpy()
            found = np.bincount(a, copies[b], len(unit)) + np.bincount(b, copies[a], len(unit))
            sets = Sets(len(unit))
            for x, y in zip(a.tolist(), b.tolist()):
                sets.join(x, y)
            who = np.flatnonzero(found)
            roots = np.array([sets.root(x) for x in who.tolist()])
            k1, k2 = t.column("k1").to_numpy(), t.column("k2").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                k1[who], k2[who], found[who].astype(np.int64), k1[roots], k2[roots])], ["k1", "k2", "links", "root1", "root2"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = entries.repartition(parts, *keys).sortWithinPartitions(*keys)
    found = kept(dealt.mapInArrow(verify, "k1 long, k2 long, links long, root1 long, root2 long"))

    named = classes.select("k1", "k2", "rep")
    links = found.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    edges = kept(found.select("k1", "k2", "root1", "root2").distinct()).join(named, ["k1", "k2"]).withColumnRenamed("rep", "a") \
        .join(named.select(F.col("k1").alias("root1"), F.col("k2").alias("root2"), F.col("rep").alias("b")), ["root1", "root2"])
    roots = components(edges.where("a is not null and b is not null").select("a", "b"))
    linked = kept(classes.select("k1", "k2", "rep", "copies").join(links, ["k1", "k2"], "left")
                          .join(roots, F.col("rep") == F.col("node"), "left")
                          .select("k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                  F.coalesce("component", "rep").alias("component_id")))
    return rows.select("vec_id", "k1", "k2", F.col("dim").isNotNull().alias("usable")).join(
        linked.withColumn("usable", F.lit(True)), ["k1", "k2", "usable"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
