"""The column-wise transform against sorted suffixes, removal of repeated bytes against brute force."""

import hashlib
import random

import numpy as np
import pytest

from storelens.llm import columnwise, repeats


def matrix(strings, kind=np.uint8):
    lengths = np.array([len(s) for s in strings], np.int64)
    out = np.zeros((len(strings), int(lengths.max())), kind)
    for i, s in enumerate(strings):
        out[i, out.shape[1] - len(s):] = list(s)
    return out, lengths


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("seed", range(12))
def test_transform_against_sorted_suffixes(tmp_path, seed):
    rnd = random.Random(seed)
    letters = [rnd.randrange(0xFFFF) for _ in range(rnd.choice([1, 2, 3, 12]))] + [0x4142, 0x4143][:seed % 3]
    strings = [tuple(rnd.choice(letters) for _ in range(rnd.randrange(0, 25))) for _ in range(rnd.randrange(1, 70))]
    strings += strings[:5]
    rows, lengths = matrix(strings, np.uint16)
    symbols, prefixes = columnwise.transform(rows, lengths, f"file://{tmp_path}/rounds")
    suffixes = sorted(((s[k:], i) for i, s in enumerate(strings) for k in range(len(s) + 1)), key=lambda x: x[0])
    assert prefixes.tolist() == [0] + [common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
    assert sorted(symbols.tolist()) == sorted([*(x for s in strings for x in s), *[columnwise.END] * len(strings)])
    for j, who, at in columnwise.places(symbols, lengths):
        for k, p in zip(who.tolist(), at.tolist()):
            assert suffixes[p][0] == strings[k][len(strings[k]) - j:]
            assert symbols[p] == (strings[k][len(strings[k]) - j - 1] if j < len(strings[k]) else columnwise.END)
    assert not list((tmp_path / "rounds").iterdir())  # the files of the rounds are gone


@pytest.mark.parametrize("seed", range(12))
def test_smallest_owner_of_byte_windows(tmp_path, seed):
    rnd = random.Random(seed)
    letters, width = rnd.choice([1, 2, 3, 12]), rnd.choice([2, 4, 6])
    strings = [bytes(rnd.randrange(97, 97 + letters) for _ in range(rnd.randrange(width, 25))) for _ in range(rnd.randrange(1, 70))]
    owner = np.array([rnd.randrange(50) for _ in strings], np.int64)
    least = {}
    for s, o in zip(strings, owner):
        for k in range(len(s) - width + 1):
            least[s[k:k + width]] = min(least.get(s[k:k + width], 99), o)
    rows, lengths = matrix(strings)
    found = columnwise.smallest_owner(rows, lengths, owner, width, f"file://{tmp_path}/rounds")
    for i, s in enumerate(strings):
        assert found[i, :len(s) - width + 1].tolist() == [least[s[k:k + width]] for k in range(len(s) - width + 1)]


@pytest.mark.parametrize("seed", range(8))
def test_transform_of_four_byte_symbols(tmp_path, monkeypatch, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(columnwise, "SEGMENT", rnd.choice([1, 5, 1 << 16]))
    monkeypatch.setattr(columnwise, "TABLE", rnd.choice([0, 1 << 24]))
    monkeypatch.setattr(columnwise, "NARROW", (0, 1 << 24)[seed % 2])
    letters = [rnd.randrange(0xFFFFFFFF) for _ in range(rnd.choice([1, 2, 3, 12]))] + [0, 0x41420000, 0x4142FFFF][:seed % 4]
    strings = [tuple(rnd.choice(letters) for _ in range(rnd.randrange(0, 25))) for _ in range(rnd.randrange(1, 70))] + [()]
    rows, lengths = matrix(strings, np.uint32)
    symbols, prefixes = columnwise.transform(rows, lengths, f"file://{tmp_path}/rounds")
    suffixes = sorted(((s[k:], i) for i, s in enumerate(strings) for k in range(len(s) + 1)), key=lambda x: x[0])
    assert prefixes.tolist() == [0] + [common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
    for j, who, at in columnwise.places(symbols, lengths):
        for k, p in zip(who.tolist(), at.tolist()):
            assert suffixes[p][0] == strings[k][len(strings[k]) - j:]
            assert symbols[p] == (strings[k][len(strings[k]) - j - 1] if j < len(strings[k]) else 0xFFFFFFFF)


@pytest.mark.parametrize("width", [1, 3, 5, 8, 11, 50])
def test_windows_of_any_width_with_few_rounds(tmp_path, monkeypatch, width):
    rnd = random.Random(width)
    base = [bytes(rnd.randrange(256) if rnd.random() < 0.2 else 0 for _ in range(90)) for _ in range(5)]
    strings = [b[a:a + n] for b in base for a, n in [(rnd.randrange(14), rnd.randrange(width, 77)) for _ in range(30)]]
    owner = np.array([rnd.randrange(50) for _ in strings], np.int64)
    least, seen, real = {}, [], columnwise.transform
    for s, o in zip(strings, owner):
        for k in range(len(s) - width + 1):
            least[s[k:k + width]] = min(least.get(s[k:k + width], 99), o)
    monkeypatch.setattr(columnwise, "transform", lambda rows, lengths, folder: seen.append(lengths.max()) or real(rows, lengths, folder))
    rows, lengths = matrix(strings)
    found = columnwise.smallest_owner(rows, lengths, owner, width, f"file://{tmp_path}/rounds")
    for i, s in enumerate(strings):
        assert found[i, :len(s) - width + 1].tolist() == [least[s[k:k + width]] for k in range(len(s) - width + 1)]
    assert max(seen) <= 19  # a round takes four bytes


def brute(rows, width):
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - width + 1 if d is not None else 0):
            least[b[k:k + width]] = min(least.get(b[k:k + width], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b) + 1)
        for k in range(len(b) - width + 1 if d is not None else 0):
            if least[b[k:k + width]] < d:
                gone[k:k + width] = b"\1" * width
        spans = [i for i in range(len(b) + 1) if gone[i] != (gone[i - 1] if i else 0)]
        out.append((d, len(b), list(zip(spans[::2], spans[1::2])), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def corpus(seed=3):
    rnd = random.Random(seed)

    def text(n):
        return "".join(rnd.choice("abcdefghij \né漢") for _ in range(n))
    passages = [text(rnd.randrange(50, 160)) for _ in range(6)]
    rows = [(i * 7 % 311, text(rnd.randrange(0, 90)) + rnd.choice(passages)[:rnd.randrange(30, 160)] + text(rnd.randrange(0, 90)))
            for i in range(160)]
    rows += [(1000 + i, rows[i][1]) for i in range(10)] + [(2000 + i, rows[3][1] * 30) for i in range(3)]
    rows += [(3000, "a" * 700), (3001, "b" * 60 + "a" * 300), (3002, "ab" * 200), (3003, "ba" * 100), (2999, "a" * 50)]
    rows += [(1000, rows[0][1]), (1000, rows[0][1]), (None, rows[0][1]), (None, None), (5, None), (6, ""), (7, "short"), (8, "x" * 49), (9, "x" * 49)]
    return rows


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_removal_against_brute_force(spark, hot):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 1, b"") for d, t in rows], "doc_id long, text string, chunk int, kept binary").repartition(5)
    found, tables = repeats.without_repeats(docs, hot=hot, slot_bytes=20_000)
    got = [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in found.collect()]
    tables.drop()

    def order(x):
        return x[0] is None, x[0] or 0, x[1], x[3]
    assert sorted(got, key=order) == sorted(brute(rows, 50), key=order)
    assert sum(len(x[2]) for x in got) > 100


def test_pieces_of_long_texts_are_cut_in_blocks(monkeypatch):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("ab") for _ in range(n)).encode() for n in (5000, 0, 30, 49, 50, 51, 2500, 999, 1000)]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])

    def windows():
        start, count, doc, anchor = repeats.pieces(data, ends, 50)
        return sorted((s + k, d, a) for s, n, d, a in zip(start.tolist(), count.tolist(), doc.tolist(), anchor.tolist()) for k in range(n))
    whole = windows()
    assert [(s, d) for s, d, _ in whole] == [(int(ends[d]) - len(t) + k, d) for d, t in enumerate(texts) for k in range(len(t) - 49)]
    assert len({(bytes(data[s:s + 50]), a) for s, _, a in whole}) == len({bytes(data[s:s + 50]) for s, _, _ in whole})
    monkeypatch.setattr(repeats, "BLOCK", 700)
    assert windows() == whole


def test_only_strings_that_share_an_anchor_are_transformed():
    assert repeats._not_alone(np.array([5, 7, 5, 1, 9, 7, 7], np.uint32)).tolist() == [0, 1, 2, 5, 6]
    assert repeats._not_alone(np.array([5], np.uint32)).tolist() == repeats._not_alone(np.array([], np.uint32)).tolist() == []


@pytest.mark.parametrize("texts", [["x" * 10 + "The quick brown fox jumps over the lazy dog, twice a day." * 2], [], ["short"]])
def test_slots_without_shared_anchors(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts * 3)] + [(9, "y" * 70 + t) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found, tables = repeats.without_repeats(docs)
    got = [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in found.collect()]
    tables.drop()
    assert sorted(got) == sorted(brute(rows, 50))


def test_edge_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.without_repeats(empty)[0].count() == 0
    found, _ = repeats.without_repeats(spark.createDataFrame([(1, None), (None, "x" * 80), (2, "x" * 80)], "doc_id int, text string"))
    assert sorted((r.doc_id or 0, r.n_bytes, len(r.removed)) for r in found.collect()) == [(0, 80, 0), (1, 0, 0), (2, 80, 0)]
    assert dict(found.dtypes)["doc_id"] == "int"
    with pytest.raises(ValueError):
        repeats.without_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_query_derives_its_digest(spark, tmp_path):
    rows = [(d, t) for d, t in corpus(4)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = repeats.op12_suffix_dedup(spark, str(tmp_path))
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect())
    want = sorted((d or -1, n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest()) for d, n, s, k in brute(rows, 50))
    assert got == want
