import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from storelens.functions import casts, money, periods
from storelens.functions.distance import _vincenty_km, geodesic_km, haversine_km
from storelens.functions.joins import join_dimension
from storelens.functions.quantiles import exact_quantiles
from storelens.functions.ranks import top_rows, with_rank


def one(df):
    (row,) = df.collect()
    return row[0]


def test_exact_sum_is_exact_and_order_free(spark):
    rows = [(0.1,)] * 1000 + [(-0.1,)] * 999 + [(None,), (1e5 + 0.0001,), (-7.25,)]
    df = spark.createDataFrame(rows, "v double")
    assert str(one(df.agg(money.exact_sum("v")))) == "99992.8501000000"
    assert one(df.repartition(7).agg(money.money_sum("v"))) == 99992.8501
    assert one(df.where("v is null").agg(money.money_sum("v"))) is None


def test_ratio_of_zero_is_null(spark):
    df = spark.range(1).select(money.ratio(F.lit(1.0), F.lit(0.0)), money.growth(F.lit(3.0), F.lit(2.0)))
    assert tuple(df.first()) == (None, 0.5)


def test_distances(spark):
    df = spark.createDataFrame([(35.6762, 139.6503, 34.6937, 135.5023), (10.0, 20.0, 10.0, 20.0),
                                (None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    far, same, unknown = [r[0] for r in df.select(haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    assert abs(far - 392.4) < 1 and same == 0.0 and unknown is None
    geodesic = [r[0] for r in df.limit(2).select(geodesic_km("a", "b", "c", "d")).collect()]
    assert abs(geodesic[0] - far) / far < 0.006 and geodesic[1] == 0.0
    # one degree of latitude at the equator and at the pole, on the ellipsoid
    lat1, lat2 = np.array([0.0, 89.0]), np.array([1.0, 90.0])
    zero = np.zeros(2)
    assert np.allclose(_vincenty_km(lat1, zero, lat2, zero), [110.574, 111.694], atol=0.01)


def test_haversine_across_the_date_line(spark):
    km = one(spark.range(1).select(haversine_km(F.lit(0.0), F.lit(179.9), F.lit(0.0), F.lit(-179.9))))
    assert abs(km - 22.239) < 0.01


def test_period_ends(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 15),), (dt.date(2024, 3, 31),)], "d date")
    got = df.select(*[periods.period_end(F.col("d"), p) for p in "MWQ"]).collect()
    assert tuple(got[0]) == (dt.date(2024, 2, 29), dt.date(2024, 2, 18), dt.date(2024, 3, 31))
    assert tuple(got[1]) == (dt.date(2024, 3, 31), dt.date(2024, 3, 31), dt.date(2024, 3, 31))


def test_casts(spark):
    df = spark.createDataFrame(
        [("s", "1,234"), ("s", "twenty"), ("s", "-5"), ("s", "12.7"), ("n", "12.7"), ("n", "-5"), ("s", None)],
        "kind string, text string")
    k, t = F.col("kind"), F.col("text")
    assert [r[0] for r in df.select(casts.to_integer(k, t)).collect()] == [1234, None, 5, 12, None, -5, None]
    assert [r[0] for r in df.select(casts.to_integer(k, t, signed=True)).collect()][2] == -5
    assert [r[0] for r in df.select(casts.to_float(k, t)).collect()] == [1234.0, None, -5.0, 12.7, 12.7, -5.0, None]
    assert one(spark.range(1).select(casts.to_text(F.lit("s"), F.lit("nan")))) is None


def test_mixed_dates_all_parse(spark):
    texts = ["2024-01-15", "15/01/2024", "Jan 15, 2024", "2024-01-15 10:30:00", "2024-01-15T10:30:00", "01/15/2024",
             "2024/01/15", "15.01.2024", "", "invalid_date", "2024-13-45"]
    df = spark.createDataFrame([("s", x) for x in texts], "kind string, text string")
    got = [r[0] for r in df.select(
        casts.to_timestamp(F.col("kind"), F.col("text"), casts.DATE_PATTERNS).cast("date")).collect()]
    assert got == [dt.date(2024, 1, 15)] * 8 + [None] * 3
    assert casts.datetime_pattern("%d/%m/%Y") == "dd/MM/yyyy"


def _ranks(values, ascending):
    s = pd.Series(values)
    return (s.rank(method="min", ascending=ascending), s.rank(method="dense", ascending=ascending),
            s.rank(pct=True, ascending=ascending))


def test_ranks_by_window_and_by_slices_agree_with_pandas(spark):
    rng = np.random.default_rng(3)
    # one group holds most rows, with many ties
    values = [("hot", float(v)) for v in rng.integers(0, 40, 400)] + [("cold", float(v)) for v in rng.integers(0, 5, 20)]
    pdf = pd.DataFrame(values, columns=["g", "v"]).assign(i=range(420))
    df = spark.createDataFrame(pdf)
    for limit in (1_000_000, 5):
        for ascending in (True, False):
            got = with_rank(df, ["g"], "v", ascending=ascending, rank="r", dense_rank="d", percentile="p",
                            window_rows=limit).toPandas().sort_values("i").reset_index(drop=True)
            for g in ("hot", "cold"):
                at = pdf.g == g
                r, d, p = _ranks(pdf.v[at], ascending)
                assert (got.r[at] == r).all() and (got.d[at] == d).all()
                assert np.allclose(got.p[at], p)
        whole = with_rank(df, [], "v", ascending=True, percentile="p", window_rows=limit).toPandas().sort_values("i")
        assert np.allclose(whole.p.to_numpy(), pdf.v.rank(pct=True).to_numpy())


def test_top_rows_with_and_without_shares(spark):
    pdf = pd.DataFrame({"g": [0] * 200 + [1] * 5, "v": np.random.default_rng(1).permutation(205)})
    df = spark.createDataFrame(pdf).repartition(6)
    want = {(r.g, r.v) for g in (0, 1) for r in pdf[pdf.g == g].nlargest(7, "v").itertuples()}
    for salts in (1, 4):
        got = top_rows(df, ["g"], [F.col("v").desc()], 7, salts=salts).collect()
        assert {(r.g, r.v) for r in got} == want
        assert sorted(r.row_number for r in got if r.g == 0) == list(range(1, 8))


def test_quantiles_by_narrowing_are_exact(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.lognormal(3, 2, 3000), "b": np.r_[np.zeros(1500), rng.integers(0, 9, 1500)].astype(float)})
    pdf.loc[::50, "a"] = np.nan
    df = spark.createDataFrame(pdf).select(F.nanvl("a", F.lit(None)).alias("a"), "b")
    for limit in (1_000_000, 10):
        got = exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.75, 1.0], max_rows=limit)
        for c in ("a", "b"):
            assert np.allclose(got[c], pdf[c].quantile([0, 0.25, 0.5, 0.75, 1]).to_numpy(), rtol=1e-12)


def test_join_dimension_both_ways(spark):
    facts = spark.createDataFrame([("a", i) for i in range(50)] + [(None, 1), ("x", 2)], "k string, v int").repartition(4)
    dim = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, w int")
    for limit in (10, 1):
        got = join_dimension(facts, dim, ["k"], broadcast_rows=limit)
        assert got.columns == ["k", "v", "w"] and got.count() == 52
        assert got.where("k is null").first().w == 2 and got.where("k = 'x'").first().w is None
        assert join_dimension(facts, dim, ["k"], "inner", broadcast_rows=limit).count() == 51


def test_large_dimension_is_never_broadcast(spark):
    # small in its files, but repeated per share: Spark's own choice would be to send it to every task
    facts, dim = spark.range(1000).selectExpr("id AS k"), spark.range(0, 1000, 2).selectExpr("id AS k", "id AS w")
    got = join_dimension(facts, dim, ["k"], broadcast_rows=100)
    assert got.count() == 1000 and got.where("w is not null").count() == 500
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_nearest_float_is_unchanged(spark):
    # sums survive a value whose tenth digit rounds
    v = math.pi * 1000
    got = one(spark.createDataFrame([(v,)], "v double").agg(money.exact_sum("v").cast("double")))
    assert abs(got - v) < 1e-10


def test_both_ways_of_quantiles_give_the_same_doubles(spark):
    import random
    import struct
    rnd = random.Random(4)
    inf, nan = float("inf"), float("nan")
    rows = [(rnd.gauss(0, 1) * 10 ** rnd.randrange(-12, 12), rnd.choice([1.0, 2.0, 2.5]), rnd.choice([inf, -inf, nan, 1.5, rnd.random()]),
             None if rnd.random() < 0.3 else rnd.randrange(50) / 7, 7.0, rnd.choice([1e308, -1e308, 5e-324, 0.0]), None, 24037.85384 + rnd.random() * 1e-9)
            for _ in range(1500)]
    names = list("abcdefgh")
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).cache()
    wanted = [0.0, 0.25, 1 / 3, 0.999]
    small = exact_quantiles(df, names, wanted)
    assert small["g"] == [None] * len(wanted)

    def bits(found):
        return {c: [v if v is None or v != v else struct.pack("d", v + 0.0) for v in vs] for c, vs in found.items() if c != "g"}

    def plain(found):
        return {c: ["nan" if v is not None and v != v and v else v for v in vs] for c, vs in bits(found).items()}
    for fetch in (5,):
        large = exact_quantiles(df, names[:6] + names[7:], wanted, max_rows=10, fetch_rows=fetch)
        got, want = plain(large), plain({c: small[c] for c in large})
        for c in got:
            assert [x == y or (x != x and y != y) for x, y in zip(got[c], want[c])] == [True] * len(wanted), (c, large[c], small[c])


def test_geodesics_between_nearly_opposite_points():
    # published values (km): points half a degree from the antipode, the antipode on the equator and of a pole
    known = [((0, 0, 0.5, 179.5), 19936.288579), ((0, 0, 0.5, 179.7), 19944.127421), ((0, 0, 0, 180), 20003.931459), ((90, 0, -90, 77), 20003.931459)]
    for swap in (False, True):
        points = np.array([(c, d, a, b) if swap else (a, b, c, d) for (a, b, c, d), _ in known], float)
        assert np.abs(_vincenty_km(*points.T) - [km for _, km in known]).max() < 1e-3
    rnd = np.random.default_rng(3)
    lat, lon = rnd.uniform(-89, 89, 500), rnd.uniform(-180, 180, 500)
    step = rnd.uniform(-0.6, 0.6, (2, 500))
    far = _vincenty_km(lat, lon, -lat + step[0], lon + 180 + step[1])
    assert ((far > 19880) & (far <= 20003.9315)).all()
    # a detour over any third point is no shorter
    mid_lat, mid_lon = rnd.uniform(-80, 80, 500), rnd.uniform(-180, 180, 500)
    detour = _vincenty_km(lat, lon, mid_lat, mid_lon) + _vincenty_km(mid_lat, mid_lon, -lat + step[0], lon + 180 + step[1])
    assert (detour >= far - 1e-3).all()
