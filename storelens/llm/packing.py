"""Vector bin packing of examples into training sequences.

Every example is a vector of demands: tokens, segments (one) and loss-bearing tokens. A sequence opens with its full
limits; the waiting example with the largest dot product of its demands and the room left, both as shares of the
limits, goes in next, as long as one fits in all dimensions. Tasks pack their own rows as they stream by, with a
waiting room of bounded size, so nothing is shuffled and no group is gathered.

``pack`` keeps examples whole. ``pack_documents`` tokenises documents and may cut them: where no waiting piece fits
whole, the best one is cut to the room left, and a task's last tokens go into sequences of the largest powers of
two, which need no padding. Sequences are then full unless the limit on segments closes one.

Defined results: null or empty text has one piece with the end id alone; a null vector component counts as zero; an
example larger than a limit gets a sequence of its own; repeated rows are packed each; an empty table gives no rows.
Sequence ids are the task's number and a counter, the same whenever the same input splits are computed again.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .words import chunks

WAITING = 256
TASK_BITS = 40


class WaitingRoom:
    """Demand vectors of the examples that wait, with the choice by dot product."""

    def __init__(self, limits: tuple[float, ...], size: int = WAITING):
        self.limits = np.asarray(limits, float)
        self.demands = np.zeros((2 * size + 2, len(limits)))
        self.things: list = []

    def __len__(self) -> int:
        return len(self.things)

    def add(self, thing, demand) -> None:
        if len(self.things) == len(self.demands):
            self.demands = np.concatenate((self.demands, np.zeros_like(self.demands)))
        self.demands[len(self.things)] = demand
        self.things.append(thing)

    def best(self, room: np.ndarray, cut: int | None = None) -> int | None:
        """The place of the best example that fits; with ``cut``, that dimension may be exceeded."""
        if not self.things:
            return None
        demands = self.demands[:len(self.things)]
        fits = demands <= room
        if cut is not None:
            fits[:, cut] = True
        fits = fits.all(axis=1)
        if not fits.any():
            return None
        shares = np.divide(room, self.limits, out=np.zeros_like(room), where=self.limits > 0)
        scaled = np.divide(demands, self.limits, out=np.zeros_like(demands), where=self.limits > 0)
        return int(np.argmax(np.where(fits, scaled @ shares, -1.0)))

    def take(self, at: int):
        """Remove the example at a place; the last one moves there."""
        thing, last = self.things[at], len(self.things) - 1
        self.things[at], self.demands[at] = self.things[last], self.demands[last]
        self.things.pop()
        return thing


def sequences(items: Iterator[tuple[object, tuple[float, ...]]], limits: tuple[float, ...],
              waiting: int = WAITING) -> Iterator[list[tuple[object, float]]]:
    """Lists of (example, offset in tokens): one list per sequence; examples stay whole."""
    room_for = WaitingRoom(limits, waiting)

    def one() -> list[tuple[object, float]]:
        room, out, used = room_for.limits.copy(), [], 0.0
        at = room_for.best(room)
        if at is None:  # larger than a limit: alone
            return [(room_for.take(0)[0], 0.0)]
        while at is not None:
            demand = room_for.demands[at].copy()
            thing, _ = room_for.take(at)
            out.append((thing, used))
            room, used = room - demand, used + demand[0]
            at = room_for.best(room)
        return out

    for thing, demand in items:
        room_for.add((thing, demand), demand)
        while len(room_for) > waiting:
            yield one()
    while len(room_for):
        yield one()


def pack(examples: DataFrame, limits: tuple[int, int, int], id_column: str, tokens_column: str, loss_column: str,
         waiting: int = WAITING) -> DataFrame:
    """(id, sequence_id, offset): whole examples under limits on (tokens, segments, loss-bearing tokens)."""
    def run(batches):
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << TASK_BITS

        def items():
            for batch in batches:
                for key, tokens, loss in zip(*(batch.column(c).to_pylist() for c in ("id", "tokens", "loss"))):
                    yield key, (tokens or 0, 1, loss or 0)
        for n, placed in enumerate(sequences(items(), limits, waiting)):
            yield pa.RecordBatch.from_pydict(
                {"id": [k for k, _ in placed], "sequence_id": [first + n] * len(placed), "offset": [int(o) for _, o in placed]},
                schema=pa.schema([("id", kind_arrow), ("sequence_id", pa.int64()), ("offset", pa.int64())]))
    from pyspark.sql.pandas.types import to_arrow_type
    kind = examples.schema[id_column].dataType
    kind_arrow = to_arrow_type(kind)
    plain = examples.select(examples[id_column].alias("id"), examples[tokens_column].cast("double").alias("tokens"),
                            examples[loss_column].cast("double").alias("loss"))
    return plain.mapInArrow(run, f"id {kind.simpleString()}, sequence_id long, offset long") \
        .withColumnRenamed("id", id_column)


@dataclass
class Piece:
    """Ids of one document from ``start`` on that wait for a place."""
    doc: int
    start: int
    ids: np.ndarray
    total: int


class DocumentPacker:
    """Fills sequences from pieces of documents; ``add`` and ``finish`` give placed rows.

    All ids of a document bear loss, so the third demand equals the first.
    """

    def __init__(self, tokens: int, segments: int, loss: int, waiting: int, first: int):
        self.tokens, self.segments, self.loss, self.waiting = tokens, segments, loss, waiting
        self.room_for = WaitingRoom((tokens, segments, loss), waiting)
        self.sequence, self.held = first, 0

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        size = min(self.tokens, self.loss)
        whole = len(ids) - len(ids) % size if size == self.tokens else 0
        for start in range(0, whole, size):  # full sequences of one piece
            yield self._row(Piece(doc, start, ids[start:start + size], len(ids)), size, 0)
            self.sequence += 1
        for start in range(whole, len(ids), size):
            self._wait(Piece(doc, start, ids[start:start + size], len(ids)))
        while len(self.room_for) > self.waiting and self.held >= self.tokens:
            yield from self._fill(self.tokens)

    def finish(self) -> Iterator[tuple]:
        while self.held:
            yield from self._fill(min(self.tokens, 1 << (self.held.bit_length() - 1)))

    def _wait(self, piece: Piece) -> None:
        self.room_for.add(piece, (len(piece.ids), 1, len(piece.ids)))
        self.held += len(piece.ids)

    def _fill(self, tokens: int) -> Iterator[tuple]:
        """One sequence of at most ``tokens``."""
        room = np.array([tokens, self.segments, min(self.loss, tokens)], float)
        offset = 0
        while room[0] > 0 and room[2] > 0:
            at = self.room_for.best(room)
            if at is None and room[1] >= 1 and len(self.room_for):
                at = int(np.argmax(self.room_for.demands[:len(self.room_for), 0]))
            if at is None:
                break
            piece = self.room_for.take(at)
            self.held -= len(piece.ids)
            n = int(min(room[0], room[2], len(piece.ids)))
            if n < len(piece.ids):
                self._wait(Piece(piece.doc, piece.start + n, piece.ids[n:], piece.total))
            yield self._row(piece, n, offset)
            offset += n
            room -= (n, 1, n)
        self.sequence += 1

    def _row(self, piece: Piece, n: int, offset: int) -> tuple:
        return (piece.doc, piece.start, n, zlib.crc32(piece.ids[:n].astype("<u4").tobytes()), piece.total,
                self.sequence, offset)


class Tokens:
    """Ids as the ``tokenizers`` library gives them; the faster ``tiktoken`` has the same vocabulary and rule,
    so it encodes the texts that hold none of the special strings (the tests compare the two)."""

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str | None):
        self.json_path, self.slow, self.fast = json_path, None, None
        if ranks_path:
            import base64

            import tiktoken
            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        with open(json_path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", [])]

    def encode(self, text: str) -> np.ndarray:
        if self.fast and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_file(self.json_path)
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


_TOKENS: dict[tuple, Tokens] = {}

PIECES = ("doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str | None = None, pattern: str | None = None,
                   tokens: int = 1024, segments: int = 64, loss: int | None = None, end_id: int = 0,
                   waiting: int = WAITING) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) in sequences of at most ``tokens`` ids, ``segments`` pieces and ``loss`` ids."""
    loss = loss or tokens
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

    def run(batches):
        from pyspark import TaskContext
        key = (json_path, ranks_path, pattern)
        if key not in _TOKENS:
            _TOKENS[key] = Tokens(*key)
        coder = _TOKENS[key]
        packer = DocumentPacker(tokens, segments, loss, waiting, TaskContext.get().partitionId() << TASK_BITS)
        kind = pa.int64()

        def out(rows):
            columns = list(zip(*rows)) or [()] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])], list(names))
        for batch in batches:
            kind = batch.column("doc_id").type
            for part in chunks(batch, "text"):
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.append(coder.encode(text or ""), np.uint32(end_id))
                    rows.extend(packer.add(doc, ids))
                yield out(rows)
        yield out(list(packer.finish()))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, PIECES.format(kind=kind))


def pack_with_public_vocabulary(docs: DataFrame) -> DataFrame:
    import public_tokenizers as files
    return pack_documents(docs, files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_with_public_vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet"))
