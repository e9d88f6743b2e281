"""Exact removal of repeated byte strings, decided by a multi-document Burrows-Wheeler transform.

A byte goes if a string of ``width`` bytes that covers it also starts in a document with a smaller id. Which strings are
equal is read from the transforms and common prefixes of :mod:`columnwise`; the steps around it bring together what has
to be in one collection and keep collections small.

* Every window of ``width`` bytes has an anchor, the gram inside it with the smallest hash. Equal windows have equal
  anchors wherever they stand, so windows are dealt by anchor. Neighbouring windows mostly share theirs: a document falls
  into pieces of at most ``2 * width - GRAM`` bytes, one per anchor.
* An anchor that stands in one document only cannot be part of a match. Anchors are counted as 32-bit hashes inside
  buckets, once per chunk of documents; what comes back to a chunk is two bits per anchor. An accidental collision
  only lets a piece go on that matches nothing.
* A chunk sends each of its remaining pieces once, with the smallest id that holds it, to the slot of the anchor; pieces
  of one chunk and slot travel as one compressed row. An anchor that stands in more than ``hot`` chunks is dealt as
  single windows, by their own hashes. Where the pieces stand stays with the chunk.
* In each slot equal pieces become one string. A string that has an anchor alone shares windows with no other string,
  so its own smallest id is their origin. The columns of all others are inserted round by round, and windows next to
  each other in suffix order with common prefixes of ``width`` or more are equal: the smallest id among them is the
  origin of them all. The origins go back to the chunks in the order in which the pieces came.

Chunks are stored as a table bucketed by chunk, so the texts are not shuffled when bits and origins come back to them.

Ids are whole numbers. Defined results: null texts are empty; rows without an id are neither origins nor shortened;
rows that share an id do not shorten each other; windows never cross documents; other columns are ignored; an empty
table gives no rows. A very long text is one chunk, looked at in blocks.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .columnwise import smallest_owner
from .graph import runs
from .scratch import Scratch
from .words import chunks, mix

GRAM = 24
BLOCK = 1 << 17
BUCKET_BYTES = 256_000_000
SLOT_BYTES = 20_000_000
HOT = 2_000
SHORT = np.uint64(0xFFFFFFFF)


def pieces(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of windows, document, anchor) of the pieces of the documents that end at ``ends``."""
    parts = []
    for base in range(0, max(1, len(data) - width + 1), BLOCK):
        block = data[base:base + BLOCK + width - 1]
        inside = ends[np.searchsorted(ends, base, side="right"):np.searchsorted(ends, base + len(block))]
        start, count, anchor = _pieces(block, np.append(inside - base, len(block)), width)
        parts.append((start + base, count, np.searchsorted(ends, start + base, side="right"), anchor))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _pieces(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    padded = np.concatenate((data, np.zeros(GRAM, np.uint8)))
    eight = np.ndarray((len(data) + GRAM - 7,), "<u8", padded, 0, (1,))
    with np.errstate(over="ignore"):
        h, upper = np.zeros(len(data), np.uint64), np.empty(len(data), np.uint64)
        for k in range(0, GRAM, 8):
            h ^= eight[k:k + len(data)]
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= np.right_shift(h, np.uint64(32), out=upper)
    span, wanted = 1, width - GRAM + 1  # grams inside a window
    while span * 2 <= wanted:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < wanted:
        h = np.minimum(h[:-(wanted - span)], h[wanted - span:])
    h = h[:n]
    begins = np.concatenate(([0], ends[:-1]))
    crossing = np.zeros(len(data) + 1, np.int32)
    np.add.at(crossing, np.maximum(begins, ends - width + 1), 1)
    np.add.at(crossing, ends, -1)
    inside = np.cumsum(crossing[:n], dtype=np.int32) == 0
    changes = inside.copy()
    changes[1:] &= (h[1:] != h[:-1]) | ~inside[:-1]
    start = np.flatnonzero(changes)
    stop = np.append(np.flatnonzero(inside[:-1] & (changes[1:] | ~inside[1:])) + 1, n if inside[-1] else []).astype(np.int64)
    count = stop - start
    # text that repeats itself has long stretches under one anchor: cut them
    parts = -(-count // wanted)
    first = np.repeat(start, parts) + wanted * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    count = np.minimum(np.repeat(stop, parts), first + wanted) - first
    with np.errstate(over="ignore"):
        return first, count, mix(h[first])


def _chunk_rows(part: pa.RecordBatch):
    import zstandard
    texts = [t.encode() if t else b"" for t in part.column("text").to_pylist()]
    data = b"".join(texts)
    return zstandard.ZstdCompressor(3).compress(data), np.cumsum([len(t) for t in texts]).astype("<i8"), len(data)


class _Chunk:
    """A stored chunk: the bytes of its documents, where they end, their ids, and the pieces of those with an id."""

    def __init__(self, payload: bytes, ends: bytes, ids: list):
        import zstandard
        self.ends = np.frombuffer(ends, "<i8").astype(np.int64)
        size = int(self.ends[-1]) if len(self.ends) else 0
        self.data = zstandard.ZstdDecompressor().decompress(payload, max_output_size=max(1, size))
        self.named = np.array([i is not None for i in ids], bool)
        self.ids = np.array([i or 0 for i in ids], np.int64)

    def cut(self, width: int, buckets: int) -> None:
        start, count, doc, anchor = pieces(np.frombuffer(self.data, np.uint8), self.ends, width)
        on = self.named[doc]
        self.start, self.count, self.doc, self.anchor = start[on], count[on], doc[on], anchor[on]
        short = ((self.anchor >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (self.anchor & SHORT)
        self.entries, self.which = np.unique(short, return_inverse=True)
        low, high = np.full(len(self.entries), len(self.ends)), np.full(len(self.entries), -1)
        np.minimum.at(low, self.which, self.doc)
        np.maximum.at(high, self.which, self.doc)
        self.several = low < high

    def gather(self, found: list, width: int, slots: int) -> None:
        """The distinct pieces that other documents may share, by slot, and where they stand."""
        import xxhash
        bits = {f["bucket"]: (f["bits"], f["hot"]) for f in found}
        here, sizes = np.unique((self.entries >> np.uint64(32)).astype(np.int64), return_counts=True)

        def flags(k: int) -> np.ndarray:
            rows = [np.unpackbits(np.frombuffer(bits[b][k], np.uint8))[:n] for b, n in zip(here.tolist(), sizes.tolist())]
            return np.concatenate(rows) > 0 if rows else np.zeros(0, bool)
        on = np.flatnonzero((self.several | flags(0))[self.which])
        start, count, doc, key = self.start[on], self.count[on], self.doc[on], self.anchor[on]
        hot = flags(1)[self.which][on]
        if hot.any():
            each, times = np.flatnonzero(hot), count[hot]
            single = np.repeat(start[each], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            names = np.fromiter((xxhash.xxh3_64_intdigest(self.data[a:a + width], 1) for a in single.tolist()), np.uint64, len(single))
            start, count = np.concatenate((start[~hot], single)), np.concatenate((count[~hot], np.ones(len(single), np.int64)))
            doc, key = np.concatenate((doc[~hot], np.repeat(doc[each], times))), np.concatenate((key[~hot], names))
        numbers: dict[bytes, int] = {}
        texts = (self.data[a:b] for a, b in zip(start.tolist(), (start + count + width - 1).tolist()))
        group = np.fromiter((numbers.setdefault(t, len(numbers)) for t in texts), np.int64, len(start))
        strings, sample = list(numbers), np.zeros(len(numbers), np.int64)
        sample[group] = np.arange(len(group))
        slot = (key[sample] % np.uint64(slots)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.place, self.piece, self.owner = start, rank[group], self.ids[doc]
        self.slot, self.strings = slot[order], [strings[k] for k in order.tolist()]
        self.anchors = (key[sample] >> np.uint64(32)).astype(np.uint32)[order]
        none = np.iinfo(np.int64)
        self.least, self.most = np.full(len(order), none.max), np.full(len(order), none.min)
        np.minimum.at(self.least, self.piece, self.owner)
        np.maximum.at(self.most, self.piece, self.owner)


def _store_chunks(docs: DataFrame, scratch: Scratch) -> DataFrame:
    from pyspark import TaskContext
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        base, n = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in chunks(batch, "text"):
                payload, ends, size = _chunk_rows(part)
                yield pa.RecordBatch.from_arrays([
                    pa.array([base + n], pa.int64()), pa.array([part.column("doc_id").to_pylist()], pa.list_(part.schema.field("doc_id").type)),
                    pa.array([ends.tobytes()], pa.binary()), pa.array([payload], pa.binary()), pa.array([size], pa.int64())],
                    ["chunk", "ids", "ends", "payload", "size"])
                n += 1
    made = docs.select("doc_id", "text").mapInArrow(work, f"chunk long, ids array<{kind}>, ends binary, payload binary, size long")
    return scratch.keep_bucketed(made, "chunk")


def _shared_anchors(stored: DataFrame, width: int, buckets: int, hot: int, parts: int) -> DataFrame:
    """(chunk, found: array of (bucket, bits, hot), n): for each anchor of the chunk, whether another chunk has it too and
    whether more than ``hot`` have it."""
    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = _Chunk(row["payload"], row["ends"], row["ids"])
                c.cut(width, buckets)
                bucket = (c.entries >> np.uint64(32)).astype(np.int64)
                here, begins = np.unique(bucket, return_index=True)
                hashes = pa.ListArray.from_arrays(pa.array(np.append(begins, len(bucket)), pa.int32()),
                                                  pa.array((c.entries & SHORT).astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(np.full(len(here), row["chunk"])), hashes],
                                                 ["bucket", "chunk", "hashes"])

    def decide(batches):
        for table in runs(batches, ["bucket"]):
            t = table.combine_chunks()
            lists = t.column("hashes").combine_chunks()
            _, which, counts = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
            times = counts[which]
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))).tolist()
            several, very = ([np.packbits(times[a:b] > most).tobytes() for a, b in zip(at[:-1], at[1:])] for most in (1, hot))
            n = np.concatenate(([0], np.cumsum(times > 1)))
            yield pa.RecordBatch.from_arrays([
                t.column("chunk").combine_chunks(), t.column("bucket").combine_chunks(), pa.array(several, pa.binary()),
                pa.array(very, pa.binary()), pa.array(np.diff(n[at]))], ["chunk", "bucket", "bits", "hot", "n"])
    listed = stored.select("chunk", "ids", "ends", "payload").mapInArrow(count, "bucket long, chunk long, hashes array<int>")
    told = listed.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(
        decide, "chunk long, bucket long, bits binary, hot binary, n long")
    return told.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits", "hot")).alias("found"), F.sum("n").alias("n"))


def _packed(*arrays: np.ndarray | bytes) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(3).compress(b"".join(x if isinstance(x, bytes) else x.tobytes() for x in arrays))


def _unpacked(packed: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(packed)


def _send_pieces(stored: DataFrame, shared: DataFrame, width: int, buckets: int, slots: int) -> DataFrame:
    """(slot, chunk, n, packed): the pieces of a chunk for a slot, their lengths, hashes of their anchors, and the smallest
    and largest ids."""
    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = _Chunk(row["payload"], row["ends"], row["ids"])
                c.cut(width, buckets)
                c.gather(row["found"], width, slots)
                here, begins = np.unique(c.slot, return_index=True)
                bounds = [*begins.tolist(), len(c.slot)]
                sizes = np.fromiter(map(len, c.strings), np.uint8, len(c.strings))
                rows = [_packed(sizes[a:b], c.least[a:b], c.most[a:b], c.anchors[a:b], b"".join(c.strings[a:b])) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(here), pa.array(np.full(len(here), row["chunk"])), pa.array(np.diff(bounds).astype(np.int64)),
                     pa.array(rows, pa.binary())], ["slot", "chunk", "n", "packed"])
    return stored.select("chunk", "ids", "ends", "payload").join(shared.select("chunk", "found"), "chunk").mapInArrow(
        work, "slot long, chunk long, n long, packed binary")


def _not_alone(names: np.ndarray) -> np.ndarray:
    """The places of the names that occur more than once."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    return np.sort(order[np.append(same, False) | np.concatenate(([False], same))[:len(names)]])


def _origins(sent: DataFrame, width: int, parts: int, folder: str) -> DataFrame:
    """(chunk, origins: array of (slot, n, packed)): for each piece sent the smallest id holding its windows, run-length
    coded; pieces none of whose windows another document has earlier have no run."""
    def work(batches):
        for table in runs(batches, ["slot"]):
            rows = table.to_pylist()
            numbers: dict[bytes, int] = {}
            groups, highs, lows, anchors = [], [], [], []
            for row in rows:
                raw, n = _unpacked(row["packed"]), row["n"]
                sizes = np.frombuffer(raw, np.uint8, n).astype(np.int64)
                lows.append(np.frombuffer(raw, np.int64, n, n))
                highs.append(np.frombuffer(raw, np.int64, n, 9 * n))
                anchors.append(np.frombuffer(raw, np.uint32, n, 17 * n))
                at = np.concatenate(([21 * n], 21 * n + np.cumsum(sizes))).tolist()
                groups.append(np.fromiter((numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(at, at[1:])), np.int64, n))
            lengths = np.fromiter(map(len, numbers), np.int64, len(numbers))
            least, name = np.full(len(lengths), np.iinfo(np.int64).max), np.zeros(len(lengths), np.uint32)
            for group, low, anchor in zip(groups, lows, anchors):
                np.minimum.at(least, group, low)
                name[group] = anchor
            found = np.repeat(least[:, None], int(lengths.max()) - width + 1, axis=1)
            several = _not_alone(name)
            if len(several):
                texts, sizes = list(numbers), lengths[several]
                strings = np.zeros((len(several), int(sizes.max())), np.uint8)
                strings[np.arange(strings.shape[1])[None, :] >= strings.shape[1] - sizes[:, None]] = np.frombuffer(
                    b"".join([texts[k] for k in several.tolist()]), np.uint8)
                del texts
                numbers.clear()
                found[several, :strings.shape[1] - width + 1] = smallest_owner(strings, sizes, least[several], width, folder)
            numbers.clear()
            here = np.arange(found.shape[1])[None, :] <= (lengths - width)[:, None]
            packed = []
            for group, high in zip(groups, highs):
                mine, valid = found[group], here[group]
                useful = ((mine < high[:, None]) & valid).any(axis=1)
                changes = valid & useful[:, None]
                changes[:, 1:] &= mine[:, 1:] != mine[:, :-1]
                per_piece = changes.sum(axis=1)
                row, col = np.nonzero(changes)
                stop = np.append(col[1:], 0)
                stop[np.cumsum(per_piece)[useful] - 1] = (lengths - width + 1)[group][useful]
                packed.append(_packed(per_piece.astype(np.uint8), (stop - col).astype(np.uint8), mine[row, col]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], pa.int64()) for c in ("chunk", "slot", "n")] + [pa.array(packed, pa.binary())],
                ["chunk", "slot", "n", "packed"])
    dealt = sent.repartition(parts, "slot").sortWithinPartitions("slot")
    return dealt.mapInArrow(work, "chunk long, slot long, n long, packed binary").groupBy("chunk").agg(
        F.collect_list(F.struct("slot", "n", "packed")).alias("origins"))


def _removed(c: _Chunk, origins: list, width: int) -> np.ndarray:
    """Which bytes of a chunk go; its pieces are gathered."""
    per_piece, counts, least = [np.zeros(0, np.uint8)], [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for row in sorted(origins, key=lambda o: o["slot"]):
        raw, n = _unpacked(row["packed"]), row["n"]
        per_piece.append(np.frombuffer(raw, np.uint8, n))
        total = int(per_piece[-1].sum())
        counts.append(np.frombuffer(raw, np.uint8, total, n))
        least.append(np.frombuffer(raw, np.int64, total, n + total))
    stretches, counts, least = np.concatenate(per_piece).astype(np.int64), np.concatenate(counts).astype(np.int64), np.concatenate(least)
    begin = np.cumsum(stretches) - stretches
    offset = np.cumsum(counts) - counts
    offset = offset - np.repeat(offset[np.minimum(begin, max(0, len(offset) - 1))] if len(offset) else begin, stretches)
    # every place of a piece with every stretch of it: at most ``width`` of these
    times = stretches[c.piece]
    place = np.repeat(np.arange(len(times)), times)
    stretch = begin[c.piece][place] + np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
    gone = least[stretch] < c.owner[place]
    low = c.place[place[gone]] + offset[stretch[gone]]
    covered = np.zeros(len(c.data) + 1, np.int32)
    np.add.at(covered, low, 1)
    np.add.at(covered, low + counts[stretch[gone]] + width - 1, -1)
    return np.cumsum(covered[:-1]) > 0


def without_repeats(docs: DataFrame, width: int = 50, hot: int = HOT, slot_bytes: int = SLOT_BYTES) -> tuple[DataFrame, Scratch]:
    """((doc_id, n_bytes, removed, kept) per row of ``docs`` (doc_id, text), the tables behind it).

    ``removed`` are the maximal stretches of removed bytes (start, end exclusive), ``kept`` the remaining bytes. The frame
    reads the stored tables; call ``drop()`` on them when it is no longer needed. ``width`` is even.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"ids are whole numbers, not {kind}")
    if not GRAM < width < 128 or width % 2:
        raise ValueError(f"the width is even and lies between {GRAM} and 128")
    scratch = Scratch(spark, "repeats")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = _store_chunks(docs, scratch)
    total = stored.agg(F.sum("size")).first()[0] or 0
    buckets = max(parts, -(-total // BUCKET_BYTES))
    shared = scratch.keep(_shared_anchors(stored, width, buckets, hot, parts))
    slots = max(1, (shared.agg(F.sum("n")).first()[0] or 0) * (2 * width - GRAM) // slot_bytes)
    sent = _send_pieces(stored, shared, width, buckets, slots)
    origins = scratch.keep(_origins(sent, width, max(parts, min(slots, 100_000)), f"{scratch.folder}/rounds"))

    def finish(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = _Chunk(row["payload"], row["ends"], row["ids"])
                c.cut(width, buckets)
                c.gather(row["found"] or [], width, slots)
                gone = _removed(c, row["origins"] or [], width)
                size = len(c.data)
                first = np.zeros(size, bool)
                lengths = np.diff(c.ends, prepend=0)
                first[(c.ends - lengths)[lengths > 0]] = True  # removed stretches end with their document
                begins = np.flatnonzero(gone & (first | ~np.concatenate(([False], gone[:-1]))[:size]))
                stops = np.flatnonzero(gone & (np.append(first[1:], True)[:size] | ~np.append(gone[1:], False)[:size])) + 1
                owner = np.searchsorted(c.ends, begins, side="right")
                base = (c.ends - lengths)[owner]
                offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(c.ends)))))
                kept = np.frombuffer(c.data, np.uint8)[~gone].tobytes()
                left = np.concatenate(([0], np.cumsum(~gone)))[np.concatenate(([0], c.ends))].tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["ids"], batch.schema.field("ids").type.value_type), pa.array(lengths),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(begins - base), pa.array(stops - base)], names=["start", "end"])),
                    pa.array([kept[a:b] for a, b in zip(left[:-1], left[1:])], pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])
    told = shared.select("chunk", "found").join(origins, "chunk", "left")
    return stored.select("chunk", "ids", "ends", "payload").join(told, "chunk", "left").mapInArrow(
        finish, f"doc_id {kind}, n_bytes long, removed array<struct<start:bigint,end:bigint>>, kept binary"), scratch


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, tables = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    digest = Scratch(spark, "repeats-digest").keep(found.select(
        "doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256")))
    tables.drop()
    return digest
