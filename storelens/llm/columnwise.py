"""Column-wise Burrows-Wheeler transform and common prefixes of a collection of short strings.

Round j inserts one symbol of every string, the j-th from its end: it stands before the suffix inserted one round
earlier. Symbols have 16 or 32 bits; of bytes four make one (see :func:`quads`), which quarters the rounds. Suffixes are
held in segments, each of the suffixes that begin with a range of symbols, in order: the symbols before the suffixes
(the transform) and the lengths of the common prefix of each suffix with the one before it, side by side in one number.
The segments follow one another in one file. A round reads the file of the last round from its start to its end, segment
by segment, merges the new suffixes of the segment, learns from the merged segment where the next suffixes go, and
writes the segment to a new file. In memory are one segment and some numbers for each string.

Where a suffix goes: the suffix c + S stands among those that begin with c behind as many others as the transform has
symbols c before the place of S. Its common prefix with its neighbours is one longer than the smallest common prefix
between the place of S and the next c on that side: 1 where that lies in another segment, 0 where there is none.
"""

from __future__ import annotations

import uuid

import numpy as np

#: Stands behind the last symbol of a string of 16-bit symbols; no pair of bytes of UTF-8 text has this value. Strings of
#: 32-bit symbols end with the largest of these.
END = 0xFFFF
#: Suffixes of a segment in the last round, unless more begin with one symbol.
SEGMENT = 1 << 16
#: Pairs of halves of 32-bit symbols up to which symbols are numbered by a table.
TABLE = 1 << 24
#: Symbols up to which a symbol and a common prefix are held in 32 bits.
NARROW = 1 << 24


def quads(strings: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings (a right-aligned matrix of m rows) as strings of four bytes a symbol: row r * m + i is string i without
    its last r bytes, without what is left over at its start."""
    m, width = strings.shape
    room = 4 * (width // 4 + 1)
    out = np.zeros((4, m, room), np.uint8)
    for r in range(4):
        out[r, :, room - max(0, width - r):] = strings[:, :max(0, width - r)]
    return (out.reshape(4 * m, room).view(">u4").astype(np.uint32),
            np.concatenate([np.maximum(lengths - r, 0) // 4 for r in range(4)]))


def _numbered(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(alphabet, ``columns`` as places in it)."""
    if columns.dtype == np.uint16:
        seen = np.zeros(1 << 16, bool)
        seen[columns] = True
        return np.flatnonzero(seen).astype(np.uint16), (np.cumsum(seen, dtype=np.int32) - np.int32(1))[columns]
    highs, high = _numbered((columns >> np.uint32(16)).astype(np.uint16))
    lows, low = _numbered(columns.astype(np.uint16))
    if len(highs) * len(lows) > TABLE:
        alphabet, codes = np.unique(columns, return_inverse=True)
        return alphabet, codes.reshape(columns.shape).astype(np.int32)
    both = high * np.int32(len(lows)) + low
    seen = np.zeros(len(highs) * len(lows), bool)
    seen[both] = True
    found = np.flatnonzero(seen)
    alphabet = highs[found // len(lows)].astype(np.uint32) << np.uint32(16) | lows[found % len(lows)]
    return alphabet, (np.cumsum(seen, dtype=np.int32) - np.int32(1))[both]


class _Least:
    """Minima of stretches of a segment's common prefixes."""

    def __init__(self, values: np.ndarray, longest: int):
        self.n, levels = len(values), max(1, int(longest).bit_length())
        table = np.empty((levels, self.n), np.uint8)  # level k: of 2^k places from each one on
        table[0] = values
        for k in range(1, levels):
            half = 1 << (k - 1)
            np.minimum(table[k - 1, :-half], table[k - 1, half:], out=table[k, :-half])
        self.table = table.ravel()

    def between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = end - begin
        level = (np.frexp(length.astype(np.float64))[1] - 1).astype(np.int64)
        at = level * self.n
        return np.minimum(self.table[at + begin], self.table[at + end - (1 << level)])


def _next_suffixes(rows: np.ndarray, place: np.ndarray, who: np.ndarray, passed: np.ndarray, last: int) -> tuple[np.ndarray, ...]:
    """For the suffixes at ``place`` of a segment: (symbol before it, which of these symbols it is, string, common prefixes
    with both neighbours or -1 where these lie in another segment). ``passed``, the symbols of the segments before, is
    brought up to this one."""
    n = len(rows)
    bits = np.uint64(n.bit_length() + 1)
    key = (rows >> rows.dtype.type(8)).astype(np.uint64)  # symbol, place, whether the suffix there is new
    key <<= bits
    key += np.arange(0, 2 * n, 2, dtype=np.uint64)
    key[place] += np.uint64(1)
    key.sort()
    c = key >> bits
    begin = np.concatenate(([0], np.flatnonzero(c[1:] != c[:-1]) + 1))
    symbol, count = c[begin].astype(np.int64), np.diff(begin, append=n)
    index = np.flatnonzero((key & np.uint64(1)) != 0)
    if symbol[-1] == last:  # strings that have ended stand last
        index = index[:np.searchsorted(index, begin[-1])]
    run = np.searchsorted(begin, index, side="right") - 1
    nth, earlier = index - begin[run], passed[symbol]
    passed[symbol] = earlier + count

    def where(i: np.ndarray) -> np.ndarray:
        return ((key[i] & ((np.uint64(1) << bits) - np.uint64(1))) >> np.uint64(1)).astype(np.int64)
    at = where(index)
    before, after = np.full(len(at), -1), np.full(len(at), -1)
    behind, ahead = np.flatnonzero(nth > 0), np.flatnonzero(nth + 1 < count[run])
    left, right = where(index[behind] - 1), where(index[ahead] + 1)
    longest = max((at[behind] - left).max(initial=0), (right - at[ahead]).max(initial=0))
    if longest:
        least = _Least(rows.astype(np.uint8), longest)
        before[behind] = least.between(left + 1, at[behind] + 1) + np.int64(1)
        after[ahead] = least.between(at[ahead] + 1, right + 1) + np.int64(1)
    of = np.empty(n, np.int32)
    of[place] = np.arange(len(place))
    return symbol[run], earlier[run] + nth, who[of[at]], before, after


class _Inserted:
    """The suffixes to insert next: segment, place in it, string, common prefixes with both neighbours (-1: none behind)."""

    def __init__(self, parts: list[tuple[np.ndarray, ...]], total: np.ndarray, segment: np.ndarray):
        c, nth, who, before, after = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 5
        smaller = np.cumsum(total) - total
        place = smaller[c] + nth
        before = np.where(before >= 0, before, np.where(nth > 0, 1, 0))
        after = np.where(after >= 0, after, np.where(nth + 1 < total[c], 1, -1))
        order = _order(place)
        first = smaller[np.searchsorted(segment, segment)]  # what lies before the first symbol of the segment
        c = c[order]
        self.segment, self.place = segment[c], place[order] - first[c]
        self.who, self.before, self.after = who[order], before[order], after[order]


def _order(values: np.ndarray) -> np.ndarray:
    """The stable order of whole numbers below 2^32."""
    key = values.astype(np.uint64) << np.uint64(32)
    key += np.arange(len(values), dtype=np.uint64)
    key.sort()
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def transform(strings: np.ndarray, lengths: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """(transform, common prefixes) over all suffixes of ``strings``, the empty ones first.

    ``strings`` is a matrix of 16-bit or 32-bit symbols, every string right-aligned in its row; strings hold at most 254
    symbols, none of them the largest of its type, which stands for the end. The file of the current round lies in
    ``folder`` (any file system that Arrow can write).
    """
    from pyarrow import fs
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    m, width = strings.shape
    if int(lengths.max(initial=0)) > 254:
        raise ValueError("strings of at most 254 symbols, please")
    if strings.size + m >= 1 << 31:
        raise ValueError("fewer than 2^31 suffixes, please")
    columns = np.full((width + 1, m), np.iinfo(strings.dtype).max, strings.dtype)  # by round
    np.copyto(columns[:width], strings[:, ::-1].T, where=np.arange(width)[:, None] < lengths[None, :])
    alphabet, columns = _numbered(columns)
    last = len(alphabet) - 1  # the end, as every string has one
    times = sum((np.bincount(c, minlength=last + 1) for c in columns), np.zeros(last + 1, np.int64))
    segment = (np.cumsum(times) - times) // SEGMENT
    kind = np.uint32 if last < NARROW else np.uint64
    own = f"{root}/{uuid.uuid4().hex}"
    empty, none = columns[0].astype(kind) << kind(8), np.zeros(m, np.uint8)
    first = np.zeros(last + 1, np.int64)
    everyone = np.arange(m)
    new = _Inserted([_next_suffixes(empty, everyone, everyone, first, last)] if m else [], first, segment)
    sizes: dict[int, int] = {}  # of the segments, without the first one of the empty suffixes
    j = 0
    try:
        while len(new.who):
            j += 1
            passed = first.copy()
            found, grown = [], {}
            added = columns[j][new.who].astype(kind) << kind(8) | new.before.astype(kind)
            reader = files.open_input_stream(f"{own}-{j - 1}") if sizes else None
            with files.open_output_stream(f"{own}-{j}") as out:
                for s in sorted({*sizes, *np.unique(new.segment).tolist()}):
                    n = sizes.get(s, 0)
                    rows = np.frombuffer(reader.read(kind().nbytes * n), kind) if n else np.zeros(0, kind)
                    low, high = np.searchsorted(new.segment, (s, s + 1))
                    if high > low:
                        place, who, after = new.place[low:high], new.who[low:high], new.after[low:high]
                        old = np.ones(n + len(place), bool)
                        old[place] = False
                        held, rows = rows, np.empty(len(old), kind)
                        rows[old] = held
                        rows[place] = added[low:high]
                        follows = np.flatnonzero(after >= 0)
                        behind = place[follows] + 1
                        rows[behind] = rows[behind] & ~kind(0xFF) | after[follows].astype(kind)
                        found.append(_next_suffixes(rows, place, who, passed, last))
                    else:
                        passed += np.bincount((rows >> kind(8)).astype(np.int64), minlength=last + 1)
                    out.write(rows)
                    grown[s] = len(rows)
            if reader is not None:
                reader.close()
                files.delete_file(f"{own}-{j - 1}")
            sizes, new = grown, _Inserted(found, passed, segment)
        made = [empty]
        if sizes:
            with files.open_input_stream(f"{own}-{j}") as reader:
                made += [np.frombuffer(reader.read(kind().nbytes * sizes[s]), kind) for s in sorted(sizes)]
        made = np.concatenate(made)
        return alphabet[made >> kind(8)], made.astype(np.uint8)
    finally:
        for k in (j - 1, j):
            if files.get_file_info(f"{own}-{k}").type != fs.FileType.NotFound:
                files.delete_file(f"{own}-{k}")


def places(symbols: np.ndarray, lengths: np.ndarray):
    """Walks the transform from the empty suffixes: yields (j, strings, places) of the suffixes of j symbols."""
    m = len(lengths)
    order = _order(symbols)
    to = np.empty(len(symbols), np.int32 if len(symbols) < 1 << 30 else np.int64)
    to[order] = m + np.arange(len(symbols))
    at = np.arange(m)
    who = np.arange(m)
    for j in range(1, int(lengths.max(initial=0)) + 1):
        on = lengths[who] >= j
        who, at = who[on], to[at[on]]
        yield j, who, at


def smallest_owner(strings: np.ndarray, lengths: np.ndarray, owner: np.ndarray, width: int, folder: str) -> np.ndarray:
    """For each byte string and place, the smallest ``owner`` of a string that holds the ``width`` bytes which start there.

    A window is the ``width % 4`` bytes at its start and then whole symbols: it is found by the suffix behind those bytes.
    Row k of the result has ``lengths[k] - width + 1`` meaningful entries at its start.
    """
    rows, fours = quads(strings, lengths)
    m, depth, rest = len(lengths), width // 4, width % 4
    missing, of_string = np.divmod(np.arange(4 * m), m)  # bytes missing at the end
    usable = np.flatnonzero(lengths[of_string] - missing >= width)
    rows, fours, missing, of_string = rows[usable], fours[usable], missing[usable], of_string[usable]
    symbols, common = transform(rows, fours, folder)
    group = np.cumsum(common < depth)  # suffixes of one group share their first ``depth`` symbols
    out = np.full((m, max(1, strings.shape[1] - width + 1)), np.iinfo(np.int64).max, np.int64)
    begins, names, holders = [], [], []
    for j, who, at in _with_empty(symbols, fours):
        if j < depth:
            continue
        string = of_string[who]
        begin = lengths[string] - missing[who] - 4 * j - rest
        inside = begin >= 0
        string, begin, name = string[inside], begin[inside], group[at[inside]]
        for k in range(rest):
            name = name << 8 | strings[string, strings.shape[1] - lengths[string] + begin + k]
        begins.append(begin)
        names.append(name)
        holders.append(string)
    if not begins or not sum(map(len, begins)):
        return out
    begin, name, holder = (np.concatenate(x) for x in (begins, names, holders))
    order = np.argsort(name)
    begin, name, holder = begin[order], name[order], holder[order]
    starts = np.concatenate(([0], np.flatnonzero(name[1:] != name[:-1]) + 1))
    least = np.minimum.reduceat(owner[holder], starts)
    out[holder, begin] = np.repeat(least, np.diff(starts, append=len(name)))
    return out


def _with_empty(symbols: np.ndarray, lengths: np.ndarray):
    yield 0, np.arange(len(lengths)), np.arange(len(lengths))
    yield from places(symbols, lengths)
