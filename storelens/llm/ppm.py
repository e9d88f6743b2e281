"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` long with the symbols seen after each. A symbol's code length is
taken in the longest context seen in training; a symbol new there costs an escape (as many escapes are counted as
symbols seen) and goes to the next shorter context, where the symbols already refused are excluded; in the end all
symbols left are equally likely. Texts are A-Z lower-cased, preceded by ``ORDER`` start bytes and ended by an end symbol;
both are bytes that UTF-8 never holds.

The trie is a set of Spark tables, one per context length, with as many rows as the corpus has different contexts, and
is never gathered in one place. Documents are dealt into blocks of about ``BLOCK_BYTES``. Each block names the
different byte windows and words it holds; code lengths are worked out once per different window by joins with the
trie; each block gets back only the windows and words it named, and adds them up per document. A block's need is bounded
by its own text, so no model has to fit in memory.

Defined results: null text is empty text and consists of the end alone; repeated rows are scored each (and learnt from
each); rows without an id are not held out, as their id's remainder is not 1; without training rows all symbols are
equally likely; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import drop_unused_shuffles, kept
from .words import Words, chunks, plain

ORDER = 4
BLOCK_BYTES = 8_000_000
SEGMENT = 4_000_000
START, END = 0xFE, 0xFF
WORD_BIT = np.uint64(1 << 63)


def symbols(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as bytes with start bytes and ends; the text of each byte; whether a byte is coded (no start byte)."""
    lowered = pc.ascii_lower(plain(texts))
    sizes = pc.binary_length(lowered).to_numpy(zero_copy_only=False).astype(np.int64)
    data = lowered.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[:sizes.sum()] if data is not None else np.zeros(0, np.uint8)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + order + 1)
    out = np.full(len(owner), START, np.uint8)
    coded = np.ones(len(owner), bool)
    starts = np.cumsum(np.concatenate(([0], sizes + order + 1)))[:-1]
    for k in range(order):
        coded[starts + k] = False
    out[starts + order + sizes] = END
    inner = coded.copy()
    inner[starts + order + sizes] = False
    out[inner] = raw
    return out, owner, coded


def windows(texts: pa.Array, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of the ``order + 1`` bytes that end at each coded byte, and the text of each, in bounded segments."""
    data, owner, coded = symbols(texts, order)
    for start in range(0, len(data), SEGMENT):
        first = max(0, start - order)
        part = data[first:start + SEGMENT]
        codes = np.zeros(len(part), np.uint64)
        for k in range(order, -1, -1):  # the oldest byte is the highest
            codes[order:] = (codes[order:] << np.uint64(8)) | part[order - k:len(part) - k]
        here = coded[first:start + SEGMENT].copy()
        here[:start - first] = False
        yield codes[here], owner[first:start + SEGMENT][here]


class BlockCounts:
    """Different windows and words of a block with their numbers in its training texts."""

    def __init__(self, order: int):
        self.order, self.held, self.size = order, [], 0

    def add(self, texts: pa.Array, trains: np.ndarray) -> None:
        words = Words(texts)
        hashed = words.hashes() | WORD_BIT
        of_word = trains[words.owners()]
        self._put(hashed, np.bincount(words.codes[of_word], minlength=len(hashed)))
        for codes, owner in windows(texts, self.order):
            learnt = trains[owner]
            self._put(*np.unique(codes[learnt], return_counts=True))
            rest = np.unique(codes[~learnt])
            self._put(rest, np.zeros(len(rest), np.int64))
        if len(self.held) > 64:
            self.held = [self.merged()]

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.held.append((keys, counts.astype(np.int64)))

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in self.held]) if self.held else np.zeros(0, np.uint64)
        counts = np.concatenate([c for _, c in self.held]) if self.held else np.zeros(0, np.int64)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
        return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _blocks(docs: DataFrame, block_bytes: int, parts: int) -> DataFrame:
    """``docs`` (doc_id, text) with ``trains`` and a block; blocks hold about ``block_bytes``, at least one per partition."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(parts, int(total // block_bytes) + 1)
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("text"), F.substring("text", 1, 64)), F.lit(n)).cast("int")) \
        .repartition(n, "block")


class Trie:
    """Tables of contexts of each length, from the training counts of full windows (code, n)."""

    def __init__(self, full: DataFrame, order: int):
        self.order = order
        counts = {order: kept(full)}
        for j in range(order - 1, -1, -1):  # a shorter context's counts are sums over the bytes before
            counts[j] = kept(counts[j + 1].groupBy(F.col("code").bitwiseAND((1 << 8 * (j + 1)) - 1).alias("code"))
                                     .agg(F.sum("n").alias("n")))
        self.counts, self.nodes = counts, {}
        for j in range(order, -1, -1):
            found = counts[j]
            if j:  # what the next shorter context counts for the symbols seen here: they are excluded after an escape
                shorter = counts[j - 1].select(F.col("code").alias("short"), F.col("n").alias("n_short"))
                found = found.join(shorter, F.col("code").bitwiseAND((1 << 8 * j) - 1) == F.col("short"))
            else:
                found = found.withColumn("n_short", F.lit(0).cast("long"))
            self.nodes[j] = kept(found.groupBy(F.shiftright("code", 8).alias("context")).agg(
                F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("n_short").alias("excluded")))

    def log_probabilities(self, codes: DataFrame) -> DataFrame:
        """(code, value): log10 of the probability of a window's last byte after the others."""
        found = codes.select("code")
        for j in range(self.order, -1, -1):
            part = F.col("code").bitwiseAND((1 << 8 * (j + 1)) - 1)
            found = found.withColumn("part", part).withColumn("context", F.shiftright("part", 8)) \
                .join(self.counts[j].select(F.col("code").alias("part"), F.col("n").alias(f"n{j}")), "part", "left") \
                .join(self.nodes[j].select("context", F.col("total").alias(f"t{j}"), F.col("kinds").alias(f"k{j}"),
                                           F.col("excluded").alias(f"x{j}")), "context", "left").drop("part", "context")
        value = -F.log10(F.lit(256) - F.coalesce("k0", F.lit(0)))
        for j in range(self.order + 1):  # from the shortest context to the longest
            longer = j < self.order
            gone_kinds = F.coalesce(f"k{j + 1}", F.lit(0)) if longer else F.lit(0)
            gone_total = F.coalesce(f"x{j + 1}", F.lit(0)) if longer else F.lit(0)
            kinds, total = F.col(f"k{j}") - gone_kinds, F.col(f"t{j}") - gone_total
            whole = F.log10((kinds + total).cast("double"))
            value = F.when(F.col(f"k{j}").isNull() | (kinds == 0), value) \
                .when(F.col(f"n{j}").isNotNull(), F.log10(F.col(f"n{j}").cast("double")) - whole) \
                .otherwise(value + F.log10(kinds.cast("double")) - whole)
        return found.select("code", value.alias("value"))


def score(docs: DataFrame, held_out, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of ``docs`` (doc_id, text); the rows where ``held_out`` does not hold are learnt from."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select("doc_id", "text", F.coalesce(~held_out, F.lit(True)).alias("trains"))
    blocks = _blocks(plain, block_bytes, parts)

    def count(table: pa.Table) -> pa.Table:
        counts = BlockCounts(order)
        for batch in table.to_batches():
            for part in chunks(batch, "text"):
                counts.add(part.column("text"), part.column("trains").to_numpy(zero_copy_only=False))
        keys, n = counts.merged()
        block = pa.array(np.full(len(keys), table.column("block")[0].as_py(), np.int32))
        return pa.Table.from_arrays([block, pa.array(keys.view(np.int64)), pa.array(n)], ["block", "key", "n"])
    named = kept(blocks.groupBy("block").applyInArrow(count, "block int, key long, n long"))
    drop_unused_shuffles(spark)
    totals = kept(named.groupBy("key").agg(F.sum("n").alias("n")))
    is_word = F.col("key") < 0
    facts = totals.agg(F.sum(F.when(is_word, F.col("n"))), F.count_if(is_word & (F.col("n") > 0))).first()
    ends = plain.where("trains").count()
    n_tokens, n_kinds = (facts[0] or 0) + ends, facts[1] + (ends > 0)

    codes = totals.where(~is_word).select(F.col("key").alias("code"), "n")
    trie = Trie(codes.where("n > 0"), order)
    values = kept(trie.log_probabilities(codes).select(F.col("code").alias("key"), "value").unionByName(
        totals.where(is_word).select("key", F.col("n").cast("double").alias("value"))))
    drop_unused_shuffles(spark)
    wanted = named.select("block", "key").join(values, "key").select("block", "key", "value")

    def add_up(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        keys, values = right.column("key").to_numpy().view(np.uint64), right.column("value").to_numpy()
        by_key = np.argsort(keys)
        keys, values = keys[by_key], values[by_key]
        per_end = np.log10((ends + 0.5) / (n_tokens + 0.5 * (n_kinds + 1)))
        out = []
        for batch in left.to_batches():
            for part in chunks(batch, "text"):
                texts, size = part.column("text"), part.num_rows
                words = Words(texts)
                hashed = words.hashes() | WORD_BIT
                counts = values[np.searchsorted(keys, hashed)] if len(hashed) else np.zeros(0)
                each = np.log10((counts + 0.5) / (n_tokens + 0.5 * (n_kinds + 1)))
                owner = words.owners()
                base = np.bincount(owner, each[words.codes], size) + per_end
                known = np.bincount(owner, counts[words.codes] > 0, size).astype(np.int64) + (ends > 0)
                scores = np.zeros(size)
                for codes, whose in windows(texts, order):
                    packed = np.sort((codes << np.uint64(24)) | whose.astype(np.uint64))
                    window = packed >> np.uint64(24)
                    first = np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1]))) if len(packed) else np.zeros(0, int)
                    value = values[np.searchsorted(keys, window[first])]
                    scores += np.bincount((packed & np.uint64(0xFFFFFF)).astype(np.int64),
                                          np.repeat(value, np.diff(np.append(first, len(packed)))), size)
                out.append(pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(words.lengths() + 1), pa.array(known), pa.array(base), pa.array(scores)],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"]))
        kind = left.schema.field("doc_id").type
        schema = pa.schema([("doc_id", kind), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
                            ("score", pa.float64())])
        return pa.Table.from_batches(out, schema)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(
        add_up, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double") \
        .withColumn("train_tokens", F.lit(n_tokens).cast("long"))


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import remainder
    found = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), remainder(F.col("doc_id"), 5) == 1)
    return found.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 1, F.lit(False)).alias("held_out"), "n_tokens",
                        "n_known", "train_tokens", "base_score", "score")
