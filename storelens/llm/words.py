"""Words of text columns inside Arrow tasks, and the helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = "[ \t\n\x0b\x0c\r]+"
CHUNK_BYTES = 4_000_000


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``most`` bytes of text each, a longer text alone; none if it has no rows."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def plain(texts: pa.Array) -> pa.Array:
    """``texts`` as large strings without nulls whose bytes begin at their buffer's start.

    Case functions of the Arrow library keep the offsets of a slice but write only its bytes, so slices are rebased.
    """
    filled = pc.cast(pc.fill_null(texts, ""), pa.large_string())
    if not len(filled):
        return filled
    ends = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset:filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    data = data.slice(int(ends[0]), int(ends[-1] - ends[0])) if data is not None else pa.py_buffer(b"")
    return pa.LargeStringArray.from_buffers(len(filled), pa.py_buffer(np.ascontiguousarray(ends - ends[0])), data)


class Words:
    """The words of each text of an array: ``codes`` point into ``vocabulary``, text i has ``codes[starts[i]:starts[i + 1]]``."""

    def __init__(self, texts: pa.Array, lower: str = "ascii", pattern: str = SPACE):
        lowered = {"ascii": pc.ascii_lower, "unicode": pc.utf8_lower, "": lambda x: x}[lower](plain(texts))
        lists = pc.split_pattern_regex(lowered, pattern)
        coded = lists.values.dictionary_encode() if len(lists) else pa.array([], pa.large_string()).dictionary_encode()
        offsets = lists.offsets.to_numpy().astype(np.int64) if len(lists) else np.zeros(1, np.int64)
        codes = coded.indices.to_numpy()
        self.vocabulary: list[str] = coded.dictionary.to_pylist()
        real = np.fromiter((w != "" for w in self.vocabulary), bool, len(self.vocabulary))
        keep = real[codes] if len(codes) else np.zeros(0, bool)
        before = np.concatenate(([0], np.cumsum(keep)))
        self.codes = codes[keep]
        self.starts = before[offsets]

    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), self.lengths())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each vocabulary entry, the same on every machine."""
        import xxhash
        return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.vocabulary), np.uint64, len(self.vocabulary))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's ``width``-word shingles; fewer words make one shingle, none an empty set."""
    words = Words(texts)
    of_word = words.hashes()
    out = []
    with np.errstate(over="ignore"):
        seq = of_word[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
        n = max(0, len(seq) - width + 1)
        windows = np.zeros(n, np.uint64)
        for k in range(width):
            windows = mix(windows * np.uint64(0x9E3779B97F4A7C15) + seq[k:k + n])
        for a, b in zip(words.starts[:-1], words.starts[1:]):
            if b - a >= width:
                out.append(np.unique(windows[a:b - width + 1]))
            elif b > a:
                short = np.zeros(1, np.uint64)
                for k in range(a, b):
                    short = mix(short * np.uint64(0x9E3779B97F4A7C15) + seq[k:k + 1])
                out.append(mix(short + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
