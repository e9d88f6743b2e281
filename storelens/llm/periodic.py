"""Periodic runs of words: recursive splitting by frequency, then a scan over lags.

A run is a stretch of words with smallest period q and at least ``max(6, 4 * q)`` words that neither neighbour extends.
Each of its words stands in it four times or more, so a word with fewer places inside a segment cannot belong to a run
there and splits the segment. The pieces are segments of their own, in which counts are smaller, so this is repeated
until nothing splits any more; all documents of a batch are split at once. What survives is scanned lag by lag. For lag
q only every q-th word is looked at: three equal steps in a row have to stand in a run's way, so a segment of m words
costs about m * log(m) comparisons instead of m * m. A hit is extended word by word, and a lag that is a multiple of
the period of a known run gives nothing new there.

Everything happens inside a document, so nothing is shuffled; a document's words are in one task, as its text is.

Defined results: null and empty texts have no words, no runs and an empty collapsed text; repeated rows are documents
of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import Words, chunks

LEAST_WORDS, LEAST_PERIODS = 6, 4
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def surviving(codes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
    """Segments (start, end) of ``codes`` that hold no word too rare in them; text i is ``codes[starts[i]:starts[i + 1]]``.

    In each pass every segment is split at the words with fewer than ``LEAST_PERIODS`` places in it; segments that lost
    no word are done, others are looked at again.
    """
    done: list[tuple[int, int]] = []
    begin, end = starts[:-1].astype(np.int64), starts[1:].astype(np.int64)
    while True:
        long = end - begin >= LEAST_WORDS
        begin, end = begin[long], end[long]
        if not len(begin):
            return sorted(done)
        sizes = end - begin
        owner = np.repeat(np.arange(len(begin)), sizes)
        first = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) - np.repeat(first - begin, sizes)
        _, which, counts = np.unique(owner * (int(codes.max()) + 1) + codes[at], return_inverse=True, return_counts=True)
        stays = counts[which] >= LEAST_PERIODS
        whole = np.logical_and.reduceat(stays, first)
        done += list(zip(begin[whole].tolist(), end[whole].tolist()))
        open_ = stays & ~whole[owner]
        # maximal stretches of places that stay, inside one segment
        before = np.concatenate(([False], open_[:-1] & (owner[1:] == owner[:-1])))
        after = np.concatenate((open_[1:] & (owner[1:] == owner[:-1]), [False]))
        begin, end = at[open_ & ~before], at[open_ & ~after] + 1


def _streak(w: np.ndarray, q: int, i: int) -> tuple[int, int]:
    """The stretch of places j around ``i`` with ``w[j] == w[j + q]``, its end exclusive."""
    m, end, step = len(w) - q, i + 1, 64
    while end < m:
        odd = np.flatnonzero(w[end:min(m, end + step)] != w[end + q:min(m, end + step) + q])
        if len(odd):
            end += int(odd[0])
            break
        end, step = min(m, end + step), step * 4
    start, step = i, 64
    while start > 0:
        low = max(0, start - step)
        odd = np.flatnonzero(w[low:start] != w[low + q:start + q])
        if len(odd):
            start = low + int(odd[-1]) + 1
            break
        start, step = low, step * 4
    return start, end


def lag_scan(w: np.ndarray) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of the words ``w``, by lag."""
    m, found = len(w), []
    # of the known runs over a place, the one that ends last: two of them overlap too little to hide each other
    covered_to, covered_by = np.zeros(m, np.int64), np.ones(m, np.int64)
    for q in range(1, m // LEAST_PERIODS + 1):
        every = w[::q]
        same = every[1:] == every[:-1]
        hits = np.flatnonzero(same[2:] & same[1:-1] & same[:-2]) * q
        if not len(hits):
            continue
        known = (covered_to[hits] >= hits + 2 * q) & (q % covered_by[hits] == 0)
        past = 0
        for i in hits[~known].tolist():
            if i < past:
                continue
            start, past = _streak(w, q, i)
            length = past - start + q
            if length < max(LEAST_WORDS, LEAST_PERIODS * q):
                continue
            if covered_to[start] >= start + length and q % covered_by[start] == 0:
                continue
            found.append((start, length, q))
            later = np.flatnonzero(covered_to[start:start + length] < start + length) + start
            covered_to[later], covered_by[later] = start + length, q
    return found


def periodic_runs(docs: DataFrame, altered: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of ``docs`` (doc_id, text).

    ``runs`` stand by start, then period; ``collapsed`` joins by one space the words that no run holds after its first
    period. ``altered(doc_id, n)`` may name, for each of a document's n words, the word to read in its place.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(part.column("text"), lower="")
                codes, starts = words.codes.astype(np.int64), words.starts
                ids = part.column("doc_id").to_pylist()
                if altered is not None:
                    for k, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                        order = altered(ids[k], b - a)
                        if order is not None:
                            codes[a:b] = codes[a:b][order]
                runs: list[list[tuple[int, int, int]]] = [[] for _ in ids]
                drops = np.zeros(len(codes) + 1, np.int64)
                segments = surviving(codes, starts)
                of = np.searchsorted(starts, [s for s, _ in segments], side="right") - 1
                for (s, e), k in zip(segments, of.tolist()):
                    for start, length, q in lag_scan(codes[s:e]):
                        runs[k].append((s - int(starts[k]) + start, length, q))
                        drops[s + start + q] += 1
                        drops[s + start + length] -= 1
                keeps = np.cumsum(drops[:-1]) == 0
                name = words.vocabulary.__getitem__
                texts = [" ".join(map(name, codes[a:b][keeps[a:b]].tolist())) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                each = [sorted(r, key=lambda x: (x[0], x[2])) for r in runs]
                flat = [x for r in each for x in r]
                structs = pa.StructArray.from_arrays(
                    [pa.array([x[c] for x in flat], pa.int64()) for c in range(3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.lengths(), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, each)]), pa.int32()), structs),
                     pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def planted(doc_id, n: int) -> np.ndarray | None:
    """The query's alteration: about a tenth of the documents become periodic from some word on; none without an id."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), planted)
    # by exact ratio; runs stand by start and period, so the first of equal ones stays
    best = F.reduce("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda most, r: F.when(
        most.isNull() | (r["length"] * most["period"] > most["length"] * r["period"]), r).otherwise(most))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
