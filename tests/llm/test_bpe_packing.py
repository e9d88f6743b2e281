"""Byte-level BPE and packing against the public libraries and the rules of packing."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as files
import pytest
import tiktoken
from tokenizers import Tokenizer

from storelens.llm import bpe, packing

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(files.path("byte_bpe_50k.tiktoken"), "rb"))}
EXACT = tiktoken.Encoding("exact", pat_str=files.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PIECES = ["  ", "\n", "\t", "the", "1234", "'s", "'ll", "ing", "er", "th", "é", "!!", "aaaa", "=-=-", "\x1c", "\x85", "漢字", "😀"]


def junk(n, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randrange(40))) for _ in range(n)]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "a", "b", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, ids string, sequence_id string, length int")


TEXTS = [None, "", " ", "a", "same text", "same text", "<|endoftext|> is text", "x" * 5000, "ab " * 20000, *junk(200)]


def test_merge_replay_equals_the_library():
    coder = bpe.Encoder(bpe.Replay(RANKS), files.PATTERN)
    texts = junk(3000, 5) + ["a" * n for n in range(40)]
    assert coder.encode(texts) == [EXACT.encode_ordinary(t) for t in texts]


def test_lower_ranks_made_by_a_merge_come_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"abc": 280, b"cb": 290, b"bb": 310, b"abcb": 270}
    exact = tiktoken.Encoding("odd", pat_str=r"[abc]+", mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 12))) for _ in range(2000)})
    found = bpe.Replay(ranks).encode_words([w.encode() for w in words])
    assert found == [exact.encode_ordinary(w) for w in words]


def test_digests_and_round_trip(spark):
    docs = docs_of(spark, TEXTS)
    path = files.path("byte_bpe_50k.tiktoken")
    rows = {r.doc_id: r for r in bpe.digests(docs, path, files.PATTERN).collect()}
    assert len(rows) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = EXACT.encode_ordinary(t or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode(bpe.encode(docs, path, files.PATTERN), path).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(TEXTS)}
    assert bpe.digests(docs.limit(0), path, files.PATTERN).count() == 0


def check_pieces(rows, texts, limit=1024, segments=64):
    slow = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids = np.array(slow.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limit and len(pieces) <= segments
        padding += 0 if at & (at - 1) == 0 else limit - at
    return padding


def test_documents_fill_sequences(spark):
    docs = docs_of(spark, TEXTS)
    assert check_pieces(packing.pack_with_public_vocabulary(docs.coalesce(1)).collect(), TEXTS) == 0
    check_pieces(packing.pack_with_public_vocabulary(docs.repartition(4)).collect(), TEXTS)
    assert packing.pack_with_public_vocabulary(docs.limit(0)).count() == 0


def test_segment_and_loss_limits_hold(spark):
    texts = ["a"] * 500
    args = (files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN)
    rows = packing.pack_documents(docs_of(spark, texts).coalesce(1), *args, segments=8).collect()
    check_pieces(rows, texts, segments=8)
    rows = packing.pack_documents(docs_of(spark, ["word " * 3000]).coalesce(1), *args, loss=100).collect()
    assert all(r.length <= 100 for r in rows)
    check_pieces(rows, ["word " * 3000])


def test_whole_examples_under_three_limits(spark):
    rnd = random.Random(2)
    examples = [(i, rnd.randrange(1, 700), rnd.randrange(0, 300)) for i in range(1000)]
    examples = [(i, t, min(t, l)) for i, t, l in examples] + [(1000, 5000, 10), (1001, None, None), (1001, None, None)]
    df = spark.createDataFrame([(*e, 0) for e in examples], "example long, tokens long, loss long, offset long").coalesce(1)
    rows = packing.pack(df, (1024, 4, 400), "example", "tokens", "loss").collect()
    assert sorted(r.example for r in rows) == sorted(e[0] for e in examples)
    size = {e[0]: e for e in examples}
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append(r)
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += size[r.example][1] or 0
        if len(rows) > 1:
            assert at <= 1024 and len(rows) <= 4 and sum(size[r.example][2] or 0 for r in rows) <= 400
    used = sum(e[1] for e in examples if e[1] and e[1] <= 1024)
    least = max(used / 1024, sum(e[2] or 0 for e in examples) / 400, len(examples) / 4)
    assert len(bins) <= 1.15 * least + 2
    assert packing.pack(df.limit(0), (1, 1, 1), "example", "tokens", "loss").count() == 0


@pytest.mark.parametrize("limits", [(10, 2, 10), (10, 5, 3)])
def test_the_dot_product_prefers_what_matches_the_room(limits):
    room = packing.WaitingRoom(limits)
    room.add("large", (9, 1, 1))
    room.add("small", (1, 1, 1))
    assert room.take(room.best(room.limits.copy())) == "large"
