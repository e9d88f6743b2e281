"""Byte-level BPE by corpus-level merge replay.

Each task works on its share of the corpus as one word list: the distinct words it meets become symbol chains, an
inverted index leads from a pair of neighbouring tokens to the places where it stands, and the merges are replayed
over the whole list in rank order, so that each merge touches only the places the index names and their
neighbours. A word's tokens depend on the word alone, so word lists of tasks need no shuffle and equal one list for
the whole corpus. Words already replayed are remembered up to a bounded number.

Defined results: a null text counts as empty, empty text has no ids; repeated rows are encoded alike; other columns
are not read. Texts are read in bounded slices, a longer text alone.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .words import chunks

REMEMBERED_WORDS = 600_000


class Replay:
    """Ranks of a vocabulary; ``encode_words`` replays their merges over a list of distinct words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.texts = {rank: text for text, rank in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.merged: dict[tuple[int, int], int] = {}

    @classmethod
    def load(cls, path: str) -> Replay:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(text): int(rank) for text, rank in map(bytes.split, lines)})

    def rank_of(self, left: int, right: int) -> int:
        """The token that the pair makes, or -1."""
        found = self.merged.get((left, right))
        if found is None:
            if len(self.merged) > 2_000_000:
                self.merged.clear()
            found = self.merged[left, right] = self.ranks.get(self.texts[left] + self.texts[right], -1)
        return found

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word; a word that is a token as a whole is that token, whatever its merges make."""
        out = [[self.ranks[word]] if word in self.ranks else None for word in words]
        made = iter(self._replayed([word for word, ids in zip(words, out) if ids is None]))
        return [next(made) if ids is None else ids for ids in out]

    def _replayed(self, words: list[bytes]) -> list[list[int]]:
        symbols: list[int] = []
        bounds: list[int] = []
        single = self.single
        for word in words:  # a fence of -1 stands before each word and after the last
            symbols.append(-1)
            bounds.append(len(symbols))
            symbols.extend([single[b] for b in word])
        symbols.append(-1)
        follows = list(range(1, len(symbols) + 1))
        precedes = list(range(-1, len(symbols) - 1))
        index: dict[int, list[int]] = defaultdict(list)  # what a pair makes -> where its left token stands
        rank_of = self.rank_of
        left = -1
        for at, right in enumerate(symbols):
            if left >= 0 and right >= 0:
                made = rank_of(left, right)
                if made >= 0:
                    index[made].append(at - 1)
            left = right
        ranks = list(index)
        heapq.heapify(ranks)
        while ranks:
            rank = heapq.heappop(ranks)
            places = index.pop(rank, None)
            if not places:
                continue
            places.sort()
            waits = -1  # the first place of a word that has to see a lower rank first
            for at in places:
                if symbols[at] < 0:
                    continue
                if waits >= 0:
                    if self._same_word(symbols, follows, waits, at):
                        self._note(index, ranks, rank, at)
                        continue
                    waits = -1
                after = follows[at]
                a, b = symbols[at], symbols[after]
                if b < 0 or rank_of(a, b) != rank:
                    continue
                behind, before = follows[after], precedes[at]
                symbols[at], symbols[after] = rank, -2
                follows[at], precedes[behind] = behind, at
                if symbols[before] >= 0:
                    made = rank_of(symbols[before], rank)
                    if made >= 0:
                        self._note(index, ranks, made, before)
                        if made < rank:
                            waits = at
                if symbols[behind] >= 0:
                    made = rank_of(rank, symbols[behind])
                    if made >= 0:
                        self._note(index, ranks, made, at)
                        if made < rank:
                            waits = at
        out = []
        ends = [*(b - 1 for b in bounds[1:]), len(symbols) - 1]
        for start, end in zip(bounds, ends):
            out.append([s for s in symbols[start:end] if s >= 0])
        return out

    @staticmethod
    def _note(index: dict[int, list[int]], ranks: list[int], rank: int, at: int) -> None:
        if rank not in index:
            heapq.heappush(ranks, rank)
        index[rank].append(at)

    @staticmethod
    def _same_word(symbols: list[int], follows: list[int], first: int, at: int) -> bool:
        while first < at and symbols[first] != -1:
            first = follows[first]
        return first == at

    def decode(self, ids) -> bytes:
        return b"".join(map(self.texts.__getitem__, ids))


class Encoder:
    """Texts to ids: the pattern cuts words, the replay encodes the new ones of a slice together."""

    def __init__(self, replay: Replay, pattern: str, remembered: int = REMEMBERED_WORDS):
        import regex
        # the white space of Unicode, not that of the regular-expression module, which counts four control characters
        self.cut = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                                 .replace(r"\S", r"\P{White_Space}"))
        self.replay, self.remembered = replay, remembered
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.cut.findall(text) for text in texts]
        if len(self.known) > self.remembered:
            self.known.clear()
        known = self.known
        new = sorted(set(chain.from_iterable(cut)).difference(known))
        known.update(zip(new, self.replay.encode_words([word.encode() for word in new])))
        return [list(chain.from_iterable(map(known.__getitem__, words))) for words in cut]


_LOADED: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this worker process; the vocabulary file is read where the task runs."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Encoder(Replay.load(path), pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids array<int>) of each text; decoding them gives the text back."""
    def run(batches):
        coder = encoder(path, pattern)
        for batch in batches:
            for part in chunks(batch, "text"):
                ids = coder.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])
    plain = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def decode(ids: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, bytes binary) of each id list; a null list counts as empty."""
    def run(batches):
        replay = encoder(path, "").replay
        for batch in batches:
            back = [replay.decode(x or ()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(back, pa.binary())], ["id", "bytes"])
    plain = ids.select(ids[id_column].alias("id"), ids[ids_column].alias("ids"))
    kind = ids.schema[id_column].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, bytes binary").withColumnRenamed("id", id_column)


def digests(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode and decode each text in one pass: number of ids and SHA-256 of the ids and of the decoded bytes."""
    def run(batches):
        coder = encoder(path, pattern)
        names = {rank: str(rank) for rank in coder.replay.texts}
        for batch in batches:
            for part in chunks(batch, "text"):
                rows = coder.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(map(len, rows), pa.int64()),
                    pa.array([hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest() for ids in rows]),
                    pa.array([hashlib.sha256(coder.replay.decode(ids)).hexdigest() for ids in rows])],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    plain = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string") \
        .withColumnRenamed("id", id_column)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                   public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
