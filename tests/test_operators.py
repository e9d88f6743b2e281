"""Semantics of cleaning, currency, aggregates, KPIs and reports on small frames."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from storelens.operators import aggregate as agg
from storelens.operators import clean, dashboard, fx, geo, kpi, lookup

D = dt.date


def sales(spark, rows, schema="store_id string, date date, product_id string, qty int, revenue double, ingest_ord int"):
    return spark.createDataFrame(rows, schema)


# cleaning

def test_dedupe_keeps_the_first_and_is_idempotent(spark):
    df = sales(spark, [("a", D(2024, 1, 1), "p", 1, 5.0, 3), ("a", D(2024, 1, 1), "p", 1, 5.0, 1),
                       ("a", D(2024, 1, 1), "p", 2, 9.0, 2), ("a", None, None, 1, 1.0, 4), ("a", None, None, 1, 1.0, 5)])
    once = clean.remove_duplicates(df)
    assert sorted(r.ingest_ord for r in once.collect()) == [1, 4]
    assert clean.remove_duplicates(once).count() == 2
    assert sorted(r.ingest_ord for r in clean.drop_exact_copies(df).collect()) == [1, 2, 4]
    assert tuple(clean.duplicate_counts(df).first()) == (5, 2, 1, 3)


def test_many_repeated_keys_are_not_broadcast(spark, monkeypatch):
    rows = [(k, i) for i in range(3) for k in ("a", "b", None, *(str(n) for n in range(40)))] + [("once", 7), ("a", 0)]
    df = spark.createDataFrame([(k, i, f"{k}{i}") for k, i in rows], "k string, ingest_ord int, text string").repartition(4)
    few = clean.first_per_key(df, ["k"])
    monkeypatch.setattr("storelens.operators.clean.BROADCAST_ROWS", 10, raising=False)
    monkeypatch.setattr("storelens.functions.joins.join_dimension.__kwdefaults__", {"broadcast_rows": 10, "salts": 16})
    many = clean.first_per_key(df, ["k"])
    assert sorted(many.collect(), key=repr) == sorted(few.collect(), key=repr) and many.count() == 44
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "_share" not in plan


def test_fill_missing_by_type(spark):
    df = sales(spark, [("a", None, None, None, None, 1)])
    assert tuple(clean.fill_missing(df).first()) == ("a", None, "UNKNOWN", 0, 0.0, 1)


@pytest.mark.parametrize("slices", [1, 3, 8])
def test_interpolation_matches_pandas(spark, slices):
    rng = np.random.default_rng(0)
    v = rng.normal(size=60)
    v[[0, 1, 5, 6, 7, 20, 58, 59]] = np.nan
    v[30:50] = np.nan
    pdf = pd.DataFrame({"ingest_ord": range(60), "v": v})
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    got = clean.interpolate(df.repartition(5), ["v"], slices=slices).toPandas().sort_values("ingest_ord").v
    assert np.allclose(got.to_numpy(dtype=float), pdf.v.interpolate("linear").to_numpy(), equal_nan=True)


def test_negative_modes(spark):
    df = sales(spark, [("a", None, "p", 1, -2.0, 1), ("a", None, "p", 1, None, 2)])
    value = {m: [r.revenue for r in clean.handle_negatives(df, m).orderBy("ingest_ord").collect()]
             for m in ("absolute", "zero", "keep")}
    assert value == {"absolute": [2.0, None], "zero": [0.0, None], "keep": [-2.0, None]}
    with pytest.raises(Exception, match="negative revenue"):
        clean.handle_negatives(df, "raise").collect()
    with pytest.raises(ValueError):
        clean.handle_negatives(df, "drop")


def test_gap_fill_limits(spark):
    rows = [("a", D(2024, 1, d), "p", 1, float(d), d) for d in (1, 2, 5)]           # two gaps: filled
    rows += [("b", D(2024, 1, d), "p", 1, 1.0, d) for d in (1, 5)]                   # two rows: not filled
    rows += [("c", D(2024, m, 1), "p", 1, 1.0, m) for m in (1, 2, 3)]                # long gaps: not filled
    rows += [("d", D(2024, 1, d), "p", 1, 1.0, d) for d in (1, 2, 3)]                # no gap
    out = clean.fill_missing_dates(sales(spark, rows))
    added = out.where("is_interpolated").orderBy("date").collect()
    assert [(r.store_id, r.date, r.revenue) for r in added] == [("a", D(2024, 1, 3), 5.0), ("a", D(2024, 1, 4), 5.0)]
    assert out.where("is_interpolated is null").count() == 0
    days = [r.date for r in out.where("store_id = 'a'").select("date").distinct().orderBy("date").collect()]
    assert days == [D(2024, 1, d) for d in range(1, 6)]


def test_outliers_skip_binary_columns_and_remove_nothing(spark):
    pdf = pd.DataFrame({"v": [1.0, 2, 3, 4, 100], "flag": [0, 1, 0, 1, 1], "same": [7] * 5})
    df = spark.createDataFrame(pdf)
    assert {tuple(r) for r in clean.outlier_counts(df, ["v", "flag", "same"]).collect()} == {("v", 1)}
    assert clean.flag_outliers(df, ["v"]).where("v_outlier").count() == 1
    assert clean.outlier_counts(df, ["same"]).count() == 0


def test_standard_text_leaves_ids_and_paths(spark):
    df = spark.createDataFrame([(" ab\t", "x y", " k", "/a/B.xlsx")], "city string, store_id string, sku string, source_file string")
    assert tuple(clean.standardize_text(df).first()) == ("AB", "x y", " k", "/a/B.xlsx")


def test_clean_report_accounts_for_every_row(spark):
    rows = [("a", D(2024, 1, d), "p", q, r, d) for d, q, r in ((1, 1, 5.0), (2, 0, -7.0), (5, 20000, None))]
    out, report = clean.clean(sales(spark, rows + rows[:1]), clean.CleanConfig(max_date=D(2024, 1, 4)))
    values = {(r["check"], r["column"], r.metric): r.value for r in report.collect()}
    assert values[("duplicates", None, "total_removed")] == 1
    assert values[("missing_values", "revenue", "missing")] == 1
    assert values[("range_validation", "revenue", "negative")] == 1
    assert values[("range_validation", "qty", "below_min")] == 1
    assert values[("range_validation", "qty", "above_max")] == 1
    assert values[("date_validation", "date", "future_dates")] == 1
    assert values[("missing_dates_filled", None, "filled_count")] == 2
    assert values[("summary", None, "final_rows")] == out.count() == 5
    assert values[("summary", None, "retention_rate")] == 1.25


def test_the_quality_report_is_made_when_it_is_asked_for(spark, monkeypatch):
    from storelens.plans import transform as tf
    asked, counts = [], clean.duplicate_counts
    monkeypatch.setattr(clean, "duplicate_counts", lambda *a: asked.append(1) or counts(*a))
    for step, names in ((geo, ["enrich"]), (fx, ["normalize"]), (agg, ["aggregate_by_region", "same_store_sales"])):
        for name in names:
            monkeypatch.setattr(step, name, lambda df, **_: df)
    rows = [("a", D(2024, 1, d), "p", 1, 5.0, d) for d in (1, 2, 4)]
    out = tf.transform(sales(spark, rows + rows[:1]))
    assert out.cleaned.count() == 4 and out.same_store_sales.count() == 4 and not asked
    values = {(r["check"], r.metric): r.value for r in out.quality_report.collect() if r.column is None}
    assert values[("duplicates", "total_removed")] == 1 and values[("summary", "final_rows")] == 4
    assert out.quality_report.count() and len(asked) == 1


def test_interpolation_places_rows_with_one_shuffle(spark, monkeypatch):
    plans, keep = [], clean.stored
    monkeypatch.setattr(clean, "stored", lambda df, name: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or keep(df, name))
    df = spark.range(100).selectExpr("id AS ingest_ord", "IF(id % 3 = 0, double(id), NULL) AS v")
    assert clean.interpolate(df, ["v"], slices=4).where("abs(v - least(ingest_ord, 99)) > 1e-9").isEmpty()
    assert plans[0].count("Exchange ") == 1 and "Window" not in plans[0]


def test_clean_can_interpolate(spark):
    rows = [("a", D(2024, 1, i), "p", 1, v, i) for i, v in ((1, 10.0), (2, None), (3, 30.0))]
    out, _ = clean.clean(sales(spark, rows), clean.CleanConfig(interpolate_missing=True))
    assert [r.revenue for r in out.orderBy("date").collect()] == [10.0, 20.0, 30.0]


# currency

def test_chain_of_rate_sources(spark):
    day = "date '2024-01-{:02}'".format
    rows = [(1, "JP", 10), (2, "JP", 13), (3, "JP", 15), (4, "JP", 20), (5, "JP", 26), (6, "US", 10), (7, "KR", 10), (8, "JP", None), (9, "SG", 13)]
    df = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"({i}, '{c}', 100D, {day(d) if d else 'null'})" for i, c, d in rows) + " AS t(i, country, revenue, date)")
    first = spark.sql(f"SELECT * FROM VALUES ('JPY', {day(10)}, 0.01D), ('JPY', {day(10)}, 0.009D), ('JPY', {day(16)}, 0.02D), ('JPY', {day(14)}, 0.03D), "
                      f"('JPY', {day(20)}, null), (null, {day(20)}, 7D), ('JPY', null, 7D) AS t(currency, rate_date, usd_rate)")
    second = spark.sql(f"SELECT * FROM VALUES ('JPY', {day(10)}, 0.5D), ('JPY', {day(21)}, 0.05D), ('SGD', {day(13)}, 0.8D), ('USD', {day(10)}, 9D) "
                       "AS t(currency, rate_date, usd_rate)")
    chain = [("first", first), ("second", second)]
    got = {r.i: (r.exchange_rate_usd, r.rate_source) for r in fx.normalize(df, sources=chain, tolerance_days=2).collect()}
    assert got == {1: (0.01, "first"), 2: (0.03, "first"), 3: (0.03, "first"), 4: (0.05, "second"), 5: (0.0067, "fallback"),
                   6: (1.0, "fallback"), 7: (0.00075, "fallback"), 8: (0.0067, "fallback"), 9: (0.8, "second")}
    exact = {r.i: r.rate_source for r in fx.normalize(df, sources=chain, tolerance_days=0).collect()}
    assert [i for i, s in exact.items() if s != "fallback"] == [1, 9]
    cross = {r.i: r for r in fx.normalize(df, sources=chain, tolerance_days=2, reporting="SGD").collect()}
    assert abs(cross[2].revenue_sgd - 100 * 0.03 / 0.8) < 1e-12 and cross[2].target_rate_source == "second"
    assert abs(cross[1].revenue_sgd - 100 * 0.01 / 0.74) < 1e-12 and cross[1].target_rate_source == "fallback"
    assert cross[9].revenue_sgd == 100
    empty = {r.rate_source for r in fx.normalize(df, sources=[("none", first.limit(0))]).collect()}
    assert empty == {"fallback"}
    plan = fx.normalize(df, sources=chain)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    for bad in ({"sources": []}, {"sources": chain, "rates": first}, {"sources": chain, "tolerance_days": -1}):
        with pytest.raises(ValueError):
            fx.normalize(df, **bad)


def test_as_of_rates_and_fallbacks(spark):
    rates = spark.createDataFrame([("JPY", D(2024, 1, 10), 0.5), ("JPY", D(2024, 1, 20), 0.25)],
                                  "currency string, rate_date date, usd_rate double")
    df = spark.createDataFrame(
        [(i, c, d, 100.0) for i, (c, d) in enumerate([
            ("JP", D(2024, 1, 1)), ("JP", D(2024, 1, 10)), ("JP", D(2024, 1, 19)), ("JP", D(2024, 3, 1)),
            ("KR", D(2024, 1, 10)), ("US", D(2024, 1, 10)), ("JP", None)])],
        "i int, country string, date date, revenue double")
    got = {r.i: (r.revenue_usd, r.rate_source) for r in fx.normalize(df, rates=rates).collect()}
    assert [got[i] for i in range(4)] == [(50.0, "dated"), (50.0, "dated"), (50.0, "dated"), (25.0, "dated")]
    assert got[4] == (100 * 0.00075, "fallback") and got[5][0] == 100.0 and got[6] == (100 * 0.0067, "fallback")
    yen = fx.normalize(df, rates=rates, reporting="JPY").where("i in (1, 5)").orderBy("i").collect()
    assert yen[0].revenue_jpy == 100.0 and yen[1].revenue_jpy == 200.0
    with pytest.raises(ValueError):
        fx.normalize(df, reporting="GBP")


def test_null_amount_and_unknown_currency(spark):
    df = spark.createDataFrame([("EUR", 5.0), ("JPY", None)], "ccy string, revenue double").withColumn("country", F.lit("JP"))
    got = {r.ccy: (r.revenue_usd, r.exchange_rate_usd, r.rate_source)
           for r in fx.normalize(df, currency_column="ccy").collect()}
    assert got == {"EUR": (5.0, 1.0, "unknown"), "JPY": (None, 0.0067, "fallback")}


# aggregates

def test_region_series_fills_gaps_and_zero_growth(spark):
    rows = [("R", "a", D(2024, 1, 5), 100.0), ("R", "b", D(2024, 1, 6), 50.0), ("R", "a", D(2024, 4, 1), 30.0),
            (None, "a", D(2024, 1, 1), 9.0)]
    df = spark.createDataFrame(rows, "economic_region string, store_id string, date date, revenue_usd double")
    got = agg.aggregate_by_region(df).orderBy("period").collect()
    assert [r.period for r in got] == [D(2024, 1, 31), D(2024, 2, 29), D(2024, 3, 31), D(2024, 4, 30)]
    assert [r.revenue_sum for r in got] == [150.0, 0.0, 0.0, 30.0]
    assert [r.revenue_growth_mom for r in got] == [None, -1.0, None, None]
    assert [r.store_count for r in got] == [2, 0, 0, 1]


def test_same_store_windows_are_rows(spark):
    start = D(2024, 1, 1)
    rows = [("a", start + dt.timedelta(days=i), 2.0 if i >= 5 else 1.0, i) for i in range(35)]
    rows += [("short", start, 1.0, i) for i in range(30)]
    df = spark.createDataFrame(rows, "store_id string, date date, revenue_usd double, ingest_ord int")
    (r,) = agg.same_store_sales(df, "MoM").collect()
    assert (r.store_id, r.current_revenue, r.prior_revenue, r.same_store_sales_growth) == ("a", 60.0, 5.0, 11.0)
    with pytest.raises(ValueError):
        agg.same_store_sales(df, "MoM", by="weeks")


def test_herfindahl_bounds(spark):
    df = spark.createDataFrame([("x", "a", 10.0), ("x", "b", 10.0), ("y", "c", 3.0)], "g string, s string, v double")
    got = {r.g: (r.hhi, r.members) for r in agg.herfindahl_index(df, "s", "v", within=["g"]).collect()}
    assert got == {"x": (5000.0, 2), "y": (10000.0, 1)}


# KPIs

KPI_ROWS = [
    (f"store_{i}", 35.0 + 0.1 * i, 139.0 + 0.1 * i, "JP" if i < 3 else "CN",
     "East Asia Developed" if i < 3 else "Greater China", "Tokyo" if i < 3 else "Shanghai", 100000.0 * (i + 1),
     0.05 * (i - 2), "outperforming" if i == 0 else "market_perform", ["SSS_DECLINE"] if i == 4 else [], f"tip {i}")
    for i in range(5)]
KPI_SCHEMA = ("store_id string, latitude double, longitude double, country string, economic_region string, "
              "nearest_city string, revenue_mtd_usd double, same_store_sales_growth double, performance_tier string, "
              "alert_flags array<string>, tooltip_summary string")


@pytest.fixture(scope="module")
def kpis(spark):
    return spark.createDataFrame(KPI_ROWS, KPI_SCHEMA)


def test_marker_filters_and_limit(kpis):
    assert lookup.markers(kpis, region="East Asia Developed").count() == 3
    assert lookup.markers(kpis, tier="outperforming").count() == 1
    assert lookup.markers(kpis, min_sss_growth=0.0).count() == 3
    limited = lookup.markers(kpis, limit=2).collect()
    assert [r.id for r in limited] == ["store_0", "store_1"] and {r.total_count for r in limited} == {5}
    with pytest.raises(ValueError):
        lookup.markers(kpis, limit=5001)


def test_search_and_alerts(kpis):
    found = lookup.search_stores(kpis, "toKYo", "city").collect()
    assert len(found) == 3 and found[0].total_found == 3
    assert lookup.search_stores(kpis, "greater").count() == 2
    assert lookup.search_stores(kpis, "x", "nowhere").count() == 0
    assert lookup.alerts(kpis).count() == 0
    assert lookup.alerts(kpis, "no-such-severity").count() == 1
    assert lookup.store_detail(kpis.withColumns({c: F.lit(None).cast("double") for c in (
        "store_name", "urban_rural", "revenue_ytd_usd", "avg_basket_size_usd", "market_share_region", "rank_in_region",
        "total_stores_in_region", "competition_density", "calculated_at")}), "nobody").count() == 0


def test_marker_text(kpis):
    m = {r.id: r for r in kpi.marker_rows(kpis).collect()}
    assert m["store_0"].revenue_mtd_formatted == "$100,000" and m["store_0"].sss_growth_formatted == "-10.0%"
    assert m["store_4"].sss_growth_formatted == "+10.0%" and m["store_0"].color == "#22c55e"
    assert abs(m["store_0"].size - 10 * (1 + np.log(100000) / 10)) < 1e-9


def test_kpi_dates_and_missing_base(spark):
    rows = [("a", D(2024, 2, 10), 40.0), ("a", D(2023, 2, 10), 20.0), ("a", D(2023, 3, 2), 99.0), ("a", D(2024, 1, 3), 5.0)]
    s = spark.createDataFrame(rows, "store_id string, date date, revenue_usd double")
    stores = spark.createDataFrame([("a", "R"), ("b", "R")], "store_id string, economic_region string")
    got = {r.store_id: r for r in kpi.store_kpi_table(stores, s, D(2024, 2, 29)).collect()}
    assert (got["a"].revenue_mtd, got["a"].revenue_ytd, got["a"].same_store_sales_growth) == (40.0, 45.0, 1.0)
    assert (got["b"].revenue_mtd, got["b"].same_store_sales_growth, got["b"].rank_in_region) == (0.0, None, 2)
    # the record form keeps a 31-day month and 0 where there is no base
    rec = kpi.calculate_store_kpis(s, D(2024, 2, 29), stores=stores, order_by="date").collect()
    assert [(r.store_id, round(r.same_store_sales_growth, 6)) for r in rec] == [("a", round(40 / 119 - 1, 6))]


# reports

def test_filters_all_means_off(spark):
    df = spark.createDataFrame([("R", "JP"), ("S", "CN")], "economic_region string, country string")
    assert dashboard.apply_filters(df, {"region": "All", "country": None, "tier": "critical"}).count() == 2
    assert dashboard.apply_filters(df, {"region": "R"}).count() == 1


def test_moving_means_over_present_days(spark):
    rows = [(D(2024, 1, 1), 1.0), (D(2024, 1, 9), 3.0), (D(2024, 1, 9), 2.0), (D(2024, 3, 1), 6.0)]
    got = dashboard.daily_revenue_with_means(spark.createDataFrame(rows, "date date, revenue_usd double")).collect()
    assert [(r.revenue, r.ma_7, r.ma_30) for r in got] == [(1.0, 1.0, 1.0), (5.0, 3.0, 3.0), (6.0, 4.0, 4.0)]


def test_colors(spark):
    df = spark.createDataFrame([(None, 0.2), ("critical", 0.2), (None, None), (None, -0.2), (None, 0.0)],
                               "performance_tier string, same_store_sales_growth double")
    got = [r[0] for r in df.select(dashboard.marker_color(df)).collect()]
    assert got == ["#22c55e", "#ef4444", "#969696", "#ef4444", "#f59e0b"]


def test_ranking_bottom_is_descending(spark):
    df = spark.createDataFrame([(f"s{i}", float(i)) for i in range(6)], "store_id string, revenue_usd double")
    growth = spark.createDataFrame([("s5", 0.1), ("s5", 0.3)], "store_id string, same_store_sales_growth double")
    top, bottom = dashboard.store_ranking(df, 2, growth=growth)
    assert [r.store_id for r in top.collect()] == ["s5", "s4"] and top.first().same_store_sales_growth == 0.2
    assert [r.store_id for r in bottom.collect()] == ["s1", "s0"]


def test_stores_per_region_by_first_appearance(spark):
    df = spark.createDataFrame([("Z", "a", 1), ("A", "b", 2), ("Z", "c", 3)], "economic_region string, store_id string, i int")
    assert [tuple(r) for r in dashboard.stores_per_region(df, order_by="i").collect()] == [("Z", 2), ("A", 1)]


def test_feature_collection(spark):
    import json
    rows = [(f"s{i}", "JP", "R", "urban", "Tokyo", 1.5, None, None if i else 3, 35.0 + i, 139.0) for i in range(3)]
    stores = spark.createDataFrame(rows[::-1], "store_id string, country string, economic_region string, urban_rural string, nearest_city string, "
                                   "distance_to_city_km double, cluster_id int, stores_within_10km long, latitude double, longitude double")
    whole = json.loads(geo.geojson_collection(stores).first()["collection"])
    lines = {json.loads(r["feature"])["properties"]["store_id"]: json.loads(r["feature"]) for r in geo.geojson_features(stores).collect()}
    assert whole == {"type": "FeatureCollection", "features": [lines[f"s{i}"] for i in range(3)]}
    assert json.loads(geo.geojson_collection(stores.limit(0)).first()["collection"]) == {"type": "FeatureCollection", "features": []}
    with pytest.raises(ValueError):
        geo.geojson_collection(stores, most=2)
