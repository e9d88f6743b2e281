"""Near-duplicate vectors and documents against brute force, groups of many copies, edge cases."""

import math
import random
import re

import numpy as np
import pytest

from storelens.llm import embeddings, graph, minhash


def brute_components(ids, pairs):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(200, 400)] + [(rnd.randrange(1000, 1500), rnd.randrange(1000, 1500)) for _ in range(300)]
    found = graph.components(spark.createDataFrame(edges + edges[:5] + [(7, 7)], "a long, b long").repartition(5)).collect()
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    assert {r.node: r.component for r in found} == brute_components(nodes, edges) and len(found) == len(nodes)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(seed=1, n=600, dim=16):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n, dim)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    key = n
    for i in range(0, 60):  # near copies at many distances
        for _ in range(3):
            rows.append((key, (base[i] + rnd.normal(size=dim) * rnd.uniform(0, 0.35)).astype(np.float32).tolist()))
            key += 1
    for _ in range(700):  # one crowd of near copies, more than a block
        rows.append((key, (base[5] + rnd.normal(size=dim) * 0.05).astype(np.float32).tolist()))
        key += 1
    for _ in range(50):
        rows.append((key, base[9].tolist()))
        key += 1
    rows.append((key, (base[9] * 3).tolist()))
    odd = [None, [], [0.0] * dim, [math.nan] * dim, [math.inf] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1)]
    return rows + [(10_000 + i, v) for i, v in enumerate(odd)], len(odd)


def test_vectors_against_brute_force(spark):
    rows, odd = vectors()
    frame = spark.createDataFrame([(i, v, 0, True) for i, v in rows], "vec_id long, embedding array<float>, n_links int, kept boolean").repartition(7)
    found = {r.vec_id: r for r in embeddings.link(frame, block=128).collect()}
    assert len(found) == len(rows)
    good = rows[:-odd]
    m = np.array([v for _, v in good], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    close = m @ m.T >= 0.95
    np.fill_diagonal(close, False)
    want = close.sum(axis=1)
    got = np.array([found[i].n_links for i, _ in good])
    assert (got <= want).all()  # no pair below the threshold, none counted twice
    assert got.sum() >= 0.99 * want.sum()
    pairs = np.argwhere(close)
    roots = brute_components([i for i, _ in good], [(good[a][0], good[b][0]) for a, b in pairs])
    same = np.mean([found[i].component_id == roots[i] for i in roots])
    assert same >= 0.99
    for i, _ in rows[-odd:]:
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_vectors_of_several_lengths_and_sizes(spark):
    rnd = np.random.default_rng(8)
    rows, key = [], 0
    for dim in [2, 3, 7, 16, *range(20, 60)]:  # more lengths than have pivots of their own
        for v in rnd.normal(size=(40 if dim > 16 else 300, dim)):
            rows.append((key, v.tolist()))
            rows.append((key + 1, (v * 1e60 + rnd.normal(size=dim) * 1e58).tolist()))
            key += 2
    rows += [(key, [1e60, 2e60]), (key + 1, [1e60, 2e60]), (key + 2, [1e-60, 2e-60]), (key + 3, [1e-320, 2e-320]), (key + 4, [1.7e308, 0.1e308])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = {r.vec_id: r for r in embeddings.link(frame, block=64).collect()}
    want = {}
    for dim in {len(v) for _, v in rows}:
        ids = [i for i, v in rows if len(v) == dim]
        m = np.array([v for _, v in rows if len(v) == dim])
        m = m / np.abs(m).max(axis=1, keepdims=True)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        close = m @ m.T >= 0.95
        np.fill_diagonal(close, False)
        want |= dict(zip(ids, close.sum(axis=1)))
    assert all(found[i].n_links <= n for i, n in want.items())
    assert sum(r.n_links for r in found.values()) >= 0.99 * sum(want.values())
    assert found[key + 1].component_id == found[key].component_id and found[key].n_links >= 2 and found[key + 3].n_links >= 2


def test_vector_edge_cases(spark):
    schema = "vec_id long, embedding array<float>"
    assert embeddings.link(spark.createDataFrame([], schema)).count() == 0
    assert embeddings.link(spark.createDataFrame([(1, None)], schema)).collect()[0].kept
    rows = embeddings.link(spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (4, [0.0, 1.0])], schema)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in rows) == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (4, 0, 4)]


def plain_set(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def corpus(seed=2):
    rnd = random.Random(seed)

    def text(n):
        return [f"w{rnd.randrange(3000)}" for _ in range(n)]

    def edited(words, share):
        return [f"e{rnd.randrange(9999)}" if rnd.random() < share else w for w in words]
    out = [" ".join(text(rnd.randrange(20, 120))) for _ in range(300)]
    for i in range(40):
        for _ in range(4):
            out.append(" ".join(edited(out[i].split(), rnd.uniform(0, 0.12))))
    crowd = text(150)
    out += [" ".join(edited(crowd, rnd.uniform(0, 0.14))) for _ in range(350)]  # near copies that link only in part
    out += [" ".join(crowd)] * 60 + [" ".join(crowd).upper() + " \n"] * 5
    out += [None, "", " \t", "one", "One", "one two", "one  two", "a b c", "same words " * 300, "same words " * 300]
    return out


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_documents_against_brute_force(spark, width, percent):
    texts = corpus()
    docs = spark.createDataFrame([(i * 3, t, "x", 1, False) for i, t in enumerate(texts)],
                                 "doc_id long, text string, component_id string, n_shingles int, kept boolean").repartition(6)
    found = {r.doc_id: r for r in minhash.Similar(docs, width, percent, block=64).run().collect()}
    sets = {i * 3: plain_set(t, width) for i, t in enumerate(texts)}
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    ids = [i for i, s in sets.items() if s]
    where = {}
    pairs = []
    for i in ids:
        near = {j for g in sets[i] for j in where.get(g, ())}
        for j in near:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                pairs.append((i, j))
        for g in sets[i]:
            where.setdefault(g, []).append(i)
    roots = brute_components(ids, pairs)
    assert {i: found[i].component_id for i in ids} == roots
    assert all(found[i].component_id == i for i in sets if not sets[i])
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


def test_document_edge_cases(spark):
    schema = "doc_id long, text string, lang string"
    empty = spark.createDataFrame([], schema)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.deduplicated(empty).count() == 0
    long_text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, long_text, "a"), (1, long_text, "a"), (2, long_text.upper(), "b"), (None, long_text, "c"),
                                  (5, None, "d"), (6, "", "e"), (None, None, "f"), (7, "other words here", "g")], schema)
    rows = minhash.deduplicated(docs)
    assert rows.columns == docs.columns
    assert sorted(r.lang for r in rows.collect()) == ["a", "d", "e", "f", "g"]


def test_rows_without_ids_and_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text, i, "x") for i in range(5)] + [(1, text, 9, "x"), (None, text + " more", 7, "y"), (None, "other words stand here now", 8, "z"),
                                                      (None, "other words stand here now", 8, "z"), (2, "", 1, "e"), (2, "", 1, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, dedup_key int, DEDUP_KEY_ string")
    for order in (docs, docs.repartition(4)):
        kept = minhash.deduplicated(order)
        assert kept.columns == docs.columns and sorted((r.doc_id or 0, r.dedup_key) for r in kept.collect()) == [(0, 8), (1, 9), (2, 1)]


def test_text_ids(spark):
    rnd = random.Random(6)
    base = [[f"w{rnd.randrange(900)}" for _ in range(60)] for _ in range(30)]
    texts = [" ".join(b[:k] + [f"e{k}"] + b[k + 1:]) for b in base for k in range(0, 60, 3)]
    ids = [f"{'ab'[i % 2]}{i:04d}" for i in range(len(texts))]
    rnd.shuffle(ids)
    named = minhash.Similar(spark.createDataFrame(list(zip(ids, texts)), "doc_id string, text string").repartition(3), 3, 85, block=8).run()
    order = {x: n for n, x in enumerate(sorted(ids))}
    numbered = minhash.Similar(spark.createDataFrame([(order[i], t) for i, t in zip(ids, texts)], "doc_id long, text string"), 3, 85, block=8).run()
    assert {order[r.doc_id]: order[r.component_id] for r in named.collect()} == {r.doc_id: r.component_id for r in numbered.collect()}


def test_bounds_keep_true_pairs():
    bounds = minhash.least_matches(0.85, 144, 16, 1e-4)
    assert list(bounds)[-1] == 144 and list(bounds.values()) == sorted(bounds.values())
    rnd = np.random.default_rng(5)
    left = rnd.integers(0, 2 ** 32, (4000, 144), dtype=np.uint32).astype(np.uint16)
    right = np.where(rnd.random((4000, 144)) < 0.85, left, left ^ 1)
    alive, _ = minhash.survivors(left, right, bounds)
    assert len(alive) >= 3990
    alive, _ = minhash.survivors(left, np.where(rnd.random((4000, 144)) < 0.6, left, left ^ 1), bounds)
    assert len(alive) < 100


def test_other_texts_under_a_repeated_id_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "a"), (1, b, "b"), (1, b, "b"), (2, a + " end", "a"), (3, c, "c"), (3, c.upper(), "c"), (0, b + " end", "b"), (1, None, "n"), (1, "", "e")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(3)
        got = sorted((r.doc_id, r.lang) for r in minhash.deduplicated(docs).collect())
        assert got == [(0, "b"), (1, "a"), (1, "e"), (1, "n"), (3, "c")]
