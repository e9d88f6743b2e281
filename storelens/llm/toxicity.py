"""Toxicity by class-conditional Kneser-Ney models of words.

Two models give each word a likelihood, letter by letter with up to ``ORDER - 1`` letters of the word before: one learnt
from toxic, one from ordinary texts. Counts of the longest contexts belong to a class; all shorter contexts share one
backoff model of continuation counts (in how many different contexts a letter follows), so a rare expression is
smoothed alike in both and its class evidence comes from what was seen. Both likelihoods of a text are divided by its
length; the score is a logistic curve over the difference of the two, for the whole text and for its most suspicious
passage of ``PASSAGE`` words, since a long text may be toxic in one place.

Labels may be learnt from a bounded sample: about ``SAMPLE`` labelled ids, drawn by a hash of the id, whatever the
number of labels of one id. The model's size is bounded by it. Three quarters of the sample give the counts and the last quarter the curve. Every text is
scored whole; a word's evidence is computed once per slice of texts.

Defined results: null and empty texts have no evidence and get the score of a difference of zero; rows labelled null
or not 0 or 1 are not learnt from, several labels of one id count each; with labels of one class or none the score is
that class's or 0; rows without an id are not held out; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.materialize import checkpointed
from .words import Words, chunks, mix

ORDER = 5
SAMPLE = 40_000
PASSAGE = 64
DISCOUNT = 0.75
FLOOR = 1 / 0x110000  # below all contexts: every code point alike
APART = r"[^\p{L}\p{N}]+"
START, END = 2, 3


def letters(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``order`` letters, one per letter of each word and one for its end, and the number of each word's."""
    pad = chr(START) * (order - 1)
    flat = np.frombuffer("".join(pad + w + chr(END) for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    starts = np.cumsum(np.concatenate(([0], sizes + order - 1)))[:-1]
    at = np.repeat(starts + order - 1 - np.concatenate(([0], np.cumsum(sizes)))[:-1], sizes) + np.arange(sizes.sum())
    return (np.stack([flat[at - order + 1 + k] for k in range(order)], axis=1) if len(at) else np.zeros((0, order), np.uint32)), sizes


def code(windows: np.ndarray) -> np.ndarray:
    """A 64-bit hash per row; rows of different widths get different hashes."""
    out = np.full(len(windows), windows.shape[1] + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(windows.shape[1]):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + windows[:, k].astype(np.uint64))
    return out


class Lookup:
    """Sorted hashes with values; absent ones have zero."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], [v[order] for v in values]

    def __call__(self, keys: np.ndarray) -> list[np.ndarray]:
        if not len(self.keys):
            return [np.zeros(len(keys)) for _ in self.values]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return [np.where(hit, v[at], 0) for v in self.values]


class KneserNey:
    """Letter models of two classes over shared backoff counts."""

    def __init__(self, windows: np.ndarray, counts: np.ndarray):
        """``windows``: distinct rows of ``order`` letters; ``counts``: how often in class 0 and in class 1."""
        self.order = windows.shape[1]
        self.classes = []
        for y in range(2):
            seen = counts[:, y] > 0
            w, c = windows[seen], counts[seen, y].astype(float)
            histories, inverse = np.unique(code(w[:, :-1]), return_inverse=True)
            self.classes.append((Lookup(code(w), c), Lookup(
                histories, np.bincount(inverse, c, len(histories)), np.bincount(inverse, None, len(histories)).astype(float))))
        self.shared = []
        wider = windows
        while wider.shape[1] > 1:  # continuation counts: each distinct wider window counts once for its suffix
            suffixes, first, kinds = np.unique(code(wider[:, 1:]), return_index=True, return_counts=True)
            rows = wider[first, 1:]
            histories, inverse = np.unique(code(rows[:, :-1]), return_inverse=True)
            self.shared.append((Lookup(suffixes, kinds.astype(float)), Lookup(
                histories, np.bincount(inverse, kinds, len(histories)), np.bincount(inverse, None, len(histories)).astype(float))))
            wider = rows

    def evidence(self, windows: np.ndarray) -> np.ndarray:
        """Per window: log likelihood in class 1 less that in class 0."""
        backoff = np.full(len(windows), FLOOR)
        for depth in range(len(self.shared) - 1, -1, -1):
            part = windows[:, depth + 1:]
            backoff = self._interpolate(self.shared[depth], part, backoff)
        ordinary, toxic = (self._interpolate(c, windows, backoff) for c in self.classes)
        return np.log(toxic) - np.log(ordinary)

    @staticmethod
    def _interpolate(tables, windows: np.ndarray, backoff: np.ndarray) -> np.ndarray:
        (count,), (total, kinds) = tables[0](code(windows)), tables[1](code(windows[:, :-1]))
        safe = np.maximum(total, 1)
        return np.where(total > 0, np.maximum(count - DISCOUNT, 0) / safe + DISCOUNT * kinds / safe * backoff, backoff)


def text_evidence(model: KneserNey, texts: pa.Array) -> np.ndarray:
    """(texts, 2): evidence per word over the whole text, and that of its most suspicious passage."""
    words = Words(texts, "unicode", APART)
    windows, sizes = letters(words.vocabulary, model.order)
    of_word = np.zeros(len(words.vocabulary))
    for start in range(0, len(sizes), 20_000):  # slices of words, so tables of windows stay small
        a, b = int(sizes[:start].sum()), int(sizes[:start + 20_000].sum())
        owner = np.repeat(np.arange(len(sizes[start:start + 20_000])), sizes[start:start + 20_000])
        of_word[start:start + 20_000] = np.bincount(owner, model.evidence(windows[a:b]), len(sizes[start:start + 20_000]))
    sums = np.concatenate(([0.0], np.cumsum(of_word[words.codes]))) if len(words.codes) else np.zeros(1)
    out = np.zeros((len(words.starts) - 1, 2))
    for i, (a, b) in enumerate(zip(words.starts[:-1], words.starts[1:])):
        if b > a:
            whole = sums[b] - sums[a]
            ends = np.append(np.arange(a + PASSAGE, b, PASSAGE // 2), b) if b - a > PASSAGE else np.array([b])
            begins = np.maximum(a, ends - PASSAGE)
            out[i] = whole / (b - a), np.max((sums[ends] - sums[begins]) / PASSAGE)
    return out


class Curve:
    """A logistic curve over the evidence, fitted by Newton steps with a small ridge."""

    def __init__(self, evidence: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray):
        """``toxic`` and ``ordinary``: how many labels of either class a row has."""
        self.weights = np.zeros(evidence.shape[1] + 1)
        times = toxic + ordinary
        some = bool(times.sum())
        self.center = np.average(evidence, axis=0, weights=times) if some else np.zeros(evidence.shape[1])
        spread = np.sqrt(np.average((evidence - self.center) ** 2, axis=0, weights=times)) if some else np.ones(evidence.shape[1])
        self.scale = np.maximum(spread, 1e-9)
        x = self._features(evidence)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            slope = x.T @ (toxic - p * times) - 1e-3 * self.weights
            bend = (x * (times * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
            self.weights = self.weights + np.clip(np.linalg.solve(bend, slope), -5, 5)

    def _features(self, evidence: np.ndarray) -> np.ndarray:
        return np.concatenate((np.ones((len(evidence), 1)), (evidence - self.center) / self.scale), axis=1)

    def __call__(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._features(evidence) @ self.weights, -30, 30)))


def remainder(doc_id: Column, by: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def sampled(labels: DataFrame, bound: int) -> DataFrame:
    """(doc_id, n0, n1): the labels of about ``bound`` ids, drawn by a hash of the id; all where there are fewer."""
    usable = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", "toxic")
    ids = usable.select("doc_id").distinct().count()
    below = min(2 ** 63 - 1, (bound << 64) // max(1, ids) - 2 ** 63)  # of all 64-bit hashes, the share of the bound
    return usable.where(F.xxhash64(F.lit(11), "doc_id") <= F.lit(below)).groupBy("doc_id").agg(
        F.count_if(F.col("toxic") == 0).alias("n0"), F.count_if(F.col("toxic") == 1).alias("n1"))


def fit(docs: DataFrame, labels: DataFrame, order: int = ORDER, bound: int = SAMPLE) -> tuple[KneserNey | None, Curve | float]:
    """Models from ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text); of one class alone, its constant score."""
    spark = docs.sparkSession
    chosen = checkpointed(sampled(labels, bound))
    ids, n0, n1 = chosen.agg(F.count("*"), F.coalesce(F.sum("n0"), F.lit(0)), F.coalesce(F.sum("n1"), F.lit(0))).first()
    if not n0 or not n1:
        return None, 1.0 if n1 else 0.0
    if ids > 2 * bound:  # the draw's bound is what makes it fit to be sent to every task
        raise RuntimeError(f"{ids} sampled ids, more than twice the bound of {bound}")
    texts = checkpointed(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "text", "n0", "n1", (F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(4)) == 0).alias("for_curve")))

    def count(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(part.column("text"), "unicode", APART)
                labels_of = [np.repeat(part.column(c).to_numpy(), words.lengths()) for c in ("n0", "n1")]
                times = np.stack([np.bincount(words.codes, n, len(words.vocabulary)) for n in labels_of], axis=1)
                windows, sizes = letters(words.vocabulary, order)
                per = times[np.repeat(np.arange(len(sizes)), sizes)]
                keys, first, inverse = np.unique(code(windows), return_index=True, return_inverse=True)
                sums = [np.bincount(inverse, per[:, y], len(keys)).astype(np.int64) for y in range(2)]
                yield pa.RecordBatch.from_arrays([pa.array(list(windows[first].astype(np.int32)), pa.list_(pa.int32())),
                                                  pa.array(sums[0]), pa.array(sums[1])], ["letters", "n0", "n1"])
    counted = texts.where("not for_curve").select("text", "n0", "n1").mapInArrow(count, "letters array<int>, n0 long, n1 long")
    table = counted.groupBy("letters").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n0 + n1 > 0").orderBy("letters").toArrow()
    windows = table.column("letters").combine_chunks().flatten().to_numpy().astype(np.uint32).reshape(-1, order)
    model = KneserNey(windows, np.stack([table.column(c).to_numpy() for c in ("n0", "n1")], axis=1))
    shared = spark.sparkContext.broadcast(model)

    def measure(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                found = text_evidence(shared.value, part.column("text"))
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), part.column("n0"), part.column("n1")], ["e0", "e1", "n0", "n1"])
    seen = texts.where("for_curve").select("text", "n0", "n1").mapInArrow(
        measure, "e0 double, e1 double, n0 long, n1 long").orderBy("e0", "e1", "n0", "n1").toArrow()
    evidence = np.stack([seen.column(c).to_numpy() for c in ("e0", "e1")], axis=1)
    return model, Curve(evidence, *[seen.column(c).to_numpy().astype(float) for c in ("n1", "n0")])


def scored(docs: DataFrame, model: KneserNey | None, curve: Curve | float) -> DataFrame:
    """(doc_id, score) of ``docs`` (doc_id, text)."""
    if model is None:
        return docs.select("doc_id", F.lit(float(curve)).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((model, curve))

    def score(batches):
        model, curve = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(curve(text_evidence(model, part.column("text"))))], ["doc_id", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")


def kept_below(docs: DataFrame, model: KneserNey | None, curve: Curve | float, at: float) -> DataFrame:
    """The rows of ``docs``, all columns, with a score below ``at``."""
    if model is None:
        return docs if curve < at else docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast((model, curve))

    def keep(batches):
        model, curve = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                yield part.filter(pa.array(curve(text_evidence(model, part.column("text"))) < at))
    return docs.mapInArrow(keep, docs.schema)


def learnable(labels: DataFrame) -> DataFrame:
    """The labels that may be learnt from: those of the fixed test fold are left out."""
    return labels.where(remainder(F.col("doc_id"), 4) != 2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model, curve = fit(docs, learnable(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored(docs, model, curve).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
