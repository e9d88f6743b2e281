"""Near-duplicate documents: MinHash bands propose, sequential Bayesian tests prune, full shingle sets decide.

Documents with equal shingle sets form one class. Classes that share a band of their signatures are candidates.
A candidate pair's signatures are compared batch by batch; after each batch the pair is dropped once the posterior
probability that its similarity reaches the threshold falls below the chosen miss probability. What survives is
compared on the full sets, exactly.

A bucket of many near copies is not expanded into pairs. First each member meets the bucket's smallest one, and
verified links form components. Only buckets that still hold several components go on: their members outside the
largest component meet all others in blocks. In a block, the pairs across components that pass the tests are compared
on their full sets, the most similar first, and a pair whose components have met meanwhile needs no comparison. So
every candidate pair either is decided exactly or lies in one component already; only links that join components
become rows.

Defined results: null text and text without words have an empty set and link with nothing; fewer words than the
shingle width make one shingle of the whole sequence; rows that share an id are one document for the components; rows
without an id have the component of their class, or none; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import Sets, components, runs
from .rows import absent_name, content_key
from .scratch import kept
from .words import chunks, mix, shingle_sets

BANDS, ROWS = 24, 6
STEP = 16
MISS = 1e-4
BLOCK = 256
BLOCK_SHINGLES = 1_000_000


def seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        a = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        return a, mix(a + np.uint64(77))


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """(documents, n) minima under n random orders of the shingles, as their low 16 bits; the sets are not empty."""
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), n), np.uint16)
    if not len(flat):
        return out
    with np.errstate(over="ignore"):
        for k, (a, b) in enumerate(zip(*seeds(n))):
            out[:, k] = np.minimum.reduceat(((flat * a + b) >> np.uint64(32)).astype(np.uint32), starts) & 0xFFFF
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) 64-bit keys of the bands."""
    with np.errstate(over="ignore"):
        out = np.tile(np.arange(bands, dtype=np.uint64), (len(signature), 1))
        for r in range(rows):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::rows][:, :bands].astype(np.uint64) + np.uint64(1))
    return out.view(np.int64)


def least_matches(threshold: float, n: int, step: int, miss: float) -> dict[int, int]:
    """After so many compared hashes, the fewest matches with which P(similarity >= threshold) is at least ``miss``.

    The prior of the similarity is uniform, so the posterior after m matches of k is Beta(m + 1, k - m + 1), whose upper
    tail is the chance of at most m successes in k + 1 trials.
    """
    out = {}
    for k in range(step, n + step, step):
        k = min(k, n)
        tail, m = 0.0, -1
        while tail < miss and m < k:
            m += 1
            tail += math.comb(k + 1, m) * threshold ** m * (1 - threshold) ** (k + 1 - m)
        out[k] = m
    return out


def survivors(left: np.ndarray, right: np.ndarray, bounds: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Which row pairs of two signature tables pass every bound, and their matches."""
    alive, matches, start = np.arange(len(left)), np.zeros(len(left), np.int32), 0
    for stop, least in bounds.items():
        matches[alive] += (left[alive, start:stop] == right[alive, start:stop]).sum(axis=1, dtype=np.int32)
        alive, start = alive[matches[alive] >= least], stop
    return alive, matches[alive]


def _table(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, n)


class Similar:
    """One run over documents (doc_id of any ordered type, text): ``width``-word shingles, links from ``percent`` per hundred on."""

    def __init__(self, docs: DataFrame, width: int, percent: int, bands: int = BANDS, rows: int = ROWS,
                 miss: float = MISS, block: int = BLOCK):
        self.spark, self.width, self.percent, self.block = docs.sparkSession, width, percent, block
        self.n, self.rows = bands * rows, rows
        self.bounds = least_matches(percent / 100, self.n, STEP, miss)
        self.docs = docs.select("doc_id", "text")
        self.kind = docs.schema["doc_id"].dataType.simpleString()
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        n = self.n

        def features(batches):
            for batch in batches:
                for part in chunks(batch, "text"):
                    sets = shingle_sets(part.column("text"), width)
                    some = [i for i, s in enumerate(sets) if len(s)]
                    signed = signatures([sets[i] for i in some], n)
                    keys = band_keys(signed, bands, rows)
                    at = np.full(len(sets), -1)
                    at[some] = np.arange(len(some))
                    import xxhash
                    digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                    yield pa.RecordBatch.from_arrays([
                        part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                        pa.array([int.from_bytes(d[8:], "little", signed=True) for d in digests], pa.int64()),
                        pa.array([signed[i].tobytes() if i >= 0 else None for i in at], pa.binary()),
                        pa.array([keys[i] if i >= 0 else None for i in at], pa.list_(pa.int64()))],
                        ["doc_id", "n_shingles", "k1", "k2", "signature", "bands"])
        self.features = kept(self.docs.mapInArrow(
            features, f"doc_id {self.kind}, n_shingles long, k1 long, k2 long, signature binary, bands array<long>"))

    def run(self) -> DataFrame:
        """(doc_id, n_shingles, component_id, kept) per document."""
        named = self.features.where("doc_id is not null and n_shingles > 0")
        reps = kept(named.groupBy("k1", "k2").agg(F.min("doc_id").alias("cls"), F.count("*").alias("copies")))
        banded = self.features.where("n_shingles > 0").select("doc_id", "k1", "k2", "n_shingles", "bands").join(
            reps, ["k1", "k2"]).where("doc_id = cls")
        entries = banded.select("cls", "n_shingles", F.posexplode("bands").alias("band_no", "band"))
        buckets = kept(entries.groupBy("band").agg(F.min("cls").alias("center"), F.count("*").alias("n")).where("n > 1"))
        self.members = kept(entries.join(buckets, "band"))
        wanted = kept(self.members.select("cls").distinct().join(reps, "cls").select("cls", "k1", "k2"))
        self.signed = kept(self.features.select("doc_id", "k1", "k2", "n_shingles", "signature").join(
            wanted.withColumn("doc_id", F.col("cls")), ["doc_id", "k1", "k2"]).select("cls", "k1", "n_shingles", "signature")
            .dropDuplicates(["cls"]))
        self._keep_sets()
        stars = self.members.where("cls <> center").select(F.col("cls").alias("a"), F.col("center").alias("b")).distinct()
        links = self._verified(self._pruned(stars))
        roots = kept(components(links))
        unsettled = self._unsettled(roots)
        if not unsettled.isEmpty():
            links = kept(links.unionByName(self._crossing(unsettled, roots)))
        roots = components(links)
        labels = reps.select("k1", "k2", F.col("cls")).join(roots, F.col("cls") == F.col("node"), "left") \
            .select("k1", "k2", F.coalesce("component", "cls").alias("label"))
        # ids that stand for several classes tie these together
        shared = named.join(reps, ["k1", "k2"]).where("doc_id <> cls").select("doc_id", "cls").join(
            reps.select(F.col("cls").alias("doc_id")), "doc_id", "left_semi")
        tied = kept(shared.select(F.col("doc_id").alias("a"), F.col("cls").alias("b")))
        if not tied.isEmpty():
            roots = components(kept(links.unionByName(tied)))
            labels = reps.select("k1", "k2", F.col("cls")).join(roots, F.col("cls") == F.col("node"), "left") \
                .select("k1", "k2", F.coalesce("component", "cls").alias("label"))
        labels = kept(labels)
        return self.features.select("doc_id", "n_shingles", "k1", "k2").join(labels, ["k1", "k2"], "left").select(
            "doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id")).withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))

    def _keep_sets(self) -> None:
        """The full sets of the classes that share any band with another, from their texts."""
        width = self.width

        def full(batches):
            for batch in batches:
                for part in chunks(batch, "text"):
                    import xxhash
                    sets = shingle_sets(part.column("text"), width)
                    digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                    yield pa.RecordBatch.from_arrays([
                        part.column("cls"), part.column("k1"), pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "k1", "own", "shingles"])
        wanted = self.signed.select("cls", "k1")
        found = self.docs.join(wanted, F.col("doc_id") == F.col("cls")).select("cls", "k1", "text").mapInArrow(
            full, f"cls {self.kind}, k1 long, own long, shingles binary").where("k1 = own")  # another row's text under the id
        self.sets = kept(found.dropDuplicates(["cls"]).select("cls", "shingles"))

    def _pruned(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that pass the bound on sizes and every posterior bound."""
        n, bounds = self.n, self.bounds

        def test(batches):
            for batch in batches:
                if batch.num_rows:
                    alive, _ = survivors(_table(batch.column("s1"), n), _table(batch.column("s2"), n), bounds)
                    yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in ("a", "b")], ["a", "b"])
        s = self.signed
        left = s.select(F.col("cls").alias("a"), F.col("n_shingles").alias("n1"), F.col("signature").alias("s1"))
        right = s.select(F.col("cls").alias("b"), F.col("n_shingles").alias("n2"), F.col("signature").alias("s2"))
        sized = 100 * F.least("n1", "n2") >= self.percent * F.greatest("n1", "n2")
        both = kept(pairs).join(left, "a").join(right, "b").where(sized)
        return kept(both.select("a", "b", "s1", "s2").mapInArrow(test, f"a {self.kind}, b {self.kind}"))

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets reach the threshold."""
        percent = self.percent

        def compare(batches):
            for batch in batches:
                keep = []
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"])
        x = self.sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
        y = self.sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
        return kept(pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(
            compare, f"a {self.kind}, b {self.kind}"))

    def _labelled(self, roots: DataFrame) -> DataFrame:
        return self.members.select("cls", "band", "band_no", "n_shingles").join(
            roots.select(F.col("node").alias("cls"), "component"), "cls", "left").select(
            "cls", "band", "band_no", "n_shingles", F.coalesce("component", "cls").alias("component"))

    def _unsettled(self, roots: DataFrame) -> DataFrame:
        """(band, big, lefts, rights) of the buckets with several components: the largest one, and into how many
        blocks of bounded size the members outside it and all members go."""
        parts = self._labelled(roots).groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
        sums = parts.groupBy("band").agg(F.max(F.struct("n", "size", F.col("component").alias("big"))).alias("most"),
                                         F.sum("n").alias("n"), F.sum("size").alias("size"), F.count("*").alias("k")).where("k > 1")

        def blocks(n, size):
            return F.greatest(F.ceil(n / self.block), F.ceil(size / BLOCK_SHINGLES)).cast("int")
        return kept(sums.select("band", F.col("most.big").alias("big"), blocks(F.col("n"), F.col("size")).alias("rights"),
                                blocks(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("lefts")))

    def _crossing(self, unsettled: DataFrame, roots: DataFrame) -> DataFrame:
        """Verified links (a, b) that join the components of the unsettled buckets."""
        n, bounds, percent, per_band = self.n, self.bounds, self.percent, self.rows
        rows = kept(self._labelled(roots).drop("n_shingles").join(unsettled, "band").join(self.signed.drop("k1"), "cls")).join(self.sets, "cls")
        common = ("band", "band_no", "cls", "component", "big", "n_shingles", "signature", "shingles")
        outside = rows.where("component <> big").select(
            *common, F.pmod(F.xxhash64("cls"), "lefts").cast("int").alias("lc"), F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("rc"),
            F.lit(True).alias("outside"))
        everyone = rows.select(
            *common, F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("lc"), F.pmod(F.xxhash64("cls"), "rights").cast("int").alias("rc"),
            F.lit(False).alias("outside"))

        def meet(batches):
            for table in runs(batches, ["band", "lc", "rc"]):
                t = table.combine_chunks()
                outside = t.column("outside").to_numpy(zero_copy_only=False)
                li, ri = np.flatnonzero(outside), np.flatnonzero(~outside)
                if not len(li) or not len(ri):
                    continue
                size = t.column("n_shingles").to_numpy()
                # ids of any type as numbers in their order
                cls = np.unique(t.column("cls").to_numpy(zero_copy_only=False), return_inverse=True)[1]
                both_ids = np.concatenate([t.column(c).to_numpy(zero_copy_only=False) for c in ("component", "big")])
                comp, big = np.split(np.unique(both_ids, return_inverse=True)[1], 2)
                allowed = comp[li][:, None] != comp[ri][None, :]
                least = np.minimum(size[li][:, None], size[ri][None, :])
                allowed &= 100 * least >= percent * np.maximum(size[li][:, None], size[ri][None, :])
                # two members outside meet twice, in either order: once is enough
                allowed &= (comp[ri] == big[0])[None, :] | (cls[li][:, None] < cls[ri][None, :])
                i, j = np.nonzero(allowed)
                signed = _table(t.column("signature"), n)
                band_no = int(t.column("band_no")[0].as_py())
                before = band_no * per_band  # a pair that shares an earlier band is decided there
                seen = (signed[li[i], :before] == signed[ri[j], :before]).reshape(len(i), band_no, per_band).all(axis=2).any(axis=1) \
                    if before else np.zeros(len(i), bool)
                i, j = li[i[~seen]], ri[j[~seen]]
                alive, matches = survivors(signed[i], signed[j], bounds)
                order = np.argsort(-matches, kind="stable")
                i, j = i[alive][order].tolist(), j[alive][order].tolist()
                raw = t.column("shingles")
                sets: dict[int, np.ndarray] = {}
                numbers = {c: k for k, c in enumerate(dict.fromkeys(comp.tolist()))}
                met, of = Sets(len(numbers)), [numbers[c] for c in comp.tolist()]
                a, b = [], []
                for x, y in zip(i, j):
                    if met.root(of[x]) == met.root(of[y]):
                        continue
                    for z in (x, y):
                        if z not in sets:
                            sets[z] = np.frombuffer(raw[z].as_py(), np.uint64)
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                        met.join(of[x], of[y])
                        a.append(x)
                        b.append(y)
                ids = t.column("cls").combine_chunks()
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(a, pa.int64())), ids.take(pa.array(b, pa.int64()))], ["a", "b"])
        dealt = outside.unionByName(everyone).repartition(self.parts, "band", "lc", "rc").sortWithinPartitions("band", "lc", "rc")
        return dealt.mapInArrow(meet, f"a {self.kind}, b {self.kind}")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of ``docs`` (doc_id, text)."""
    return Similar(docs, width, percent).run()


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that of the smallest id, one without an id only where
    no other is in it.

    Ids play no further part: rows that share id and text, or have no id and share the text, are one document, other
    texts under an id are documents of their own. Texts without words are in no component; of equal rows among them one
    stays.
    """
    name, key = absent_name(docs, "dedup_key"), content_key("doc_id", "text")
    keyed = docs.select("doc_id", key.alias("own"))
    parts = near_duplicates(docs.select(key.alias("doc_id"), "text"), width, percent) \
        .select(F.col("doc_id").alias("own"), "component_id").distinct()
    firsts = keyed.join(kept(parts), "own").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "own")).alias("first"))
    ids = kept(firsts.select(F.col("first.own").alias(name)))
    return docs.withColumn(name, key).join(ids, name, "left_semi").dropDuplicates([name]).select(docs.columns)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3, percent=85)
