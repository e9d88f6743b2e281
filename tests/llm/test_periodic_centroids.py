"""Periodic runs and nearest-centroid clustering against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from storelens.llm import centroids, periodic


def plain_runs(w):
    """Every maximal stretch by definition: for each period the stretches of equal steps, the smallest period of each."""
    found = {}
    n = len(w)
    for q in range(1, n):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # ascending periods: the first is the smallest
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


@pytest.mark.parametrize("seed", range(30))
def test_runs_against_definition(seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(12):
        letters = rnd.choice([1, 2, 3, 6, 40])
        w = [rnd.randrange(letters) for _ in range(rnd.randrange(0, 120))]
        for _ in range(rnd.randrange(0, 4)):
            unit = [rnd.randrange(letters) for _ in range(rnd.randrange(1, 9))]
            if rnd.random() < 0.4:
                unit = unit * rnd.randrange(4, 7) + [rnd.randrange(letters)]  # a run inside the unit of another
            at = rnd.randrange(len(w) + 1)
            w[at:at] = (unit * 7)[:int(len(unit) * rnd.uniform(3.5, 6.9))]
        texts.append(w)
    codes = np.array([x for w in texts for x in w], np.int64)
    starts = np.cumsum([0, *map(len, texts)])
    segments = periodic.surviving(codes, starts)
    assert all(any(a <= s and e <= b for a, b in zip(starts, starts[1:])) for s, e in segments)
    for k, w in enumerate(texts):
        got = sorted((s - starts[k] + a, length, q) for s, e in segments if starts[k] <= s < starts[k + 1]
                     for a, length, q in periodic.lag_scan(codes[s:e]))
        assert got == plain_runs(w)


def plain_query(doc_id, text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2]))).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_run_query_against_plain_version(spark, tmp_path):
    rnd = random.Random(5)

    def text():
        out = [rnd.choice(["a", "b", "ça", "A", "漢字", "x" * 30]) if rnd.random() < 0.5 else f"w{rnd.randrange(50)}" for _ in range(rnd.randrange(0, 150))]
        if rnd.random() < 0.5:
            out[3:3] = ["no", "way"] * rnd.randrange(2, 9)
        return rnd.choice([" ", "\n", " \t\x0b"]).join(out)
    rows = [(i, text()) for i in range(300)]
    rows += [(7, rows[7][1]), (None, "z " * 9), (None, None), (900, None), (901, ""), (902, " \n"), (903, "q " * 5), (904, "q " * 6), (905, "e " * 4000)]
    spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, runs int, collapsed string") \
        .repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    found = periodic.op11_periodic_runs(spark, str(tmp_path)).drop("n_words")
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == sorted((plain_query(d, t) for d, t in rows), key=str)
    assert sum(r[1] for r in got) > 50
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert periodic.periodic_runs(empty).count() == 0 and dict(periodic.periodic_runs(empty).dtypes)["doc_id"] == "string"


def test_a_long_text_is_scanned_in_time():
    rnd = random.Random(2)
    w = np.array([rnd.randrange(3) for _ in range(60_000)] + [7, 8] * 30_000, np.int64)
    got = periodic.lag_scan(w)
    assert max(got, key=lambda r: r[1]) == (60_000, 60_000, 2)


def plain_clusters(rows, k, rounds, dims):
    good = [(i, np.floor(np.array(v, float) * 256).astype(object)) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    good = [(i, [int(x) for x in v]) for i, v in good]
    name = sorted(good, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centre = [v for _, v in name[:k]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centre]
        return d.index(min(d)), min(d)
    for _ in range(rounds):
        mine = {}
        for _, v in good:
            mine.setdefault(nearest(v)[0], []).append(v)
        centre = [[sum(x) // len(mine[c]) for x in zip(*mine[c])] if c in mine else v for c, v in enumerate(centre)]
    return [(i, *nearest(v)) for i, v in good], centre


def test_clusters_against_plain_version(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, (rnd.normal(size=8) * rnd.choice([0.1, 1, 300])).tolist()) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(60)] + [(3, rows[3][1]), (None, rows[4][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 7), (903, [None] + [1.0] * 7), (904, [float("nan")] + [1.0] * 7), (905, [float("-inf")] + [1.0] * 7)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cluster int, q int").repartition(6)
    found, centre = centroids.cluster(frame, k=12, rounds=4, dims=8)
    want, plain_centre = plain_clusters(rows, 12, 4, 8)
    assert centre.tolist() == plain_centre
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_cluster_edge_cases(spark):
    schema = "vec_id string, embedding array<float>"
    found, centre = centroids.cluster(spark.createDataFrame([], schema), dims=2)
    assert found.count() == 0 and not len(centre) and dict(found.dtypes)["vec_id"] == "string"
    few = spark.createDataFrame([("a", [0.5, 0.0]), ("b", [0.5, 0.0]), ("c", [-3.1, 9.0]), ("d", [1e30, 0.0])], schema)
    found, centre = centroids.cluster(few, k=40, dims=2)
    assert len(centre) == 3 and sorted((r.vec_id, r.distance) for r in found.collect()) == [("a", 0), ("b", 0), ("c", 0)]
    assert len({r.cluster for r in found.collect() if r.vec_id in "ab"}) == 1


def test_tables_of_far_values():
    q = np.array([[0], [1 << 26], [-(1 << 26)], [5]])
    assert centroids.distances(q, np.array([[0], [5]])).tolist() == [[(x - c) ** 2 for c in (0, 5)] for x in q[:, 0].tolist()]
