import numpy as np
import pandas as pd
import pytest

from storelens.functions.distance import EARTH_RADIUS_KM, _vincenty_km
from storelens.operators import geo, spatial


def haversine(a, b):
    la, lo = np.radians(a), np.radians(b)
    h = np.sin((la[:, None] - la) / 2) ** 2 + np.cos(la)[:, None] * np.cos(la) * np.sin((lo[:, None] - lo) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * np.arcsin(np.minimum(1, np.sqrt(h)))


def sites(seed=0):
    """Scattered stores, a crowded town (a third of all), same positions, date line and pole."""
    rng = np.random.default_rng(seed)
    town = np.c_[rng.normal(35.0, 0.03, 60), rng.normal(139.0, 0.03, 60)]
    wide = np.c_[rng.uniform(-60, 60, 60), rng.uniform(-180, 180, 60)]
    line = np.c_[rng.normal(0, 0.02, 20), (180 + rng.normal(0, 0.03, 20) + 180) % 360 - 180]
    pole = np.c_[90 - np.abs(rng.normal(0, 0.05, 20)), rng.uniform(-180, 180, 20)]
    same = np.repeat([[10.0, 10.0]], 5, axis=0)
    xy = np.concatenate([town, wide, line, pole, same])
    return pd.DataFrame({"store_id": [f"s{i:04d}" for i in range(len(xy))], "latitude": xy[:, 0], "longitude": xy[:, 1]})


def labels(near):
    """Components of the neighbour graph, numbered by first member, -1 when alone."""
    n, out, next_label = len(near), np.full(len(near), -1), 0
    for i in range(n):
        if out[i] >= 0 or near[i].sum() < 2:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if out[j] < 0:
                out[j] = next_label
                todo += list(np.flatnonzero(near[j] & (out < 0)))
        next_label += 1
    return out


@pytest.mark.parametrize("leaf_pairs", [4096, 1, 16])
def test_density_and_clusters_match_brute_force(spark, leaf_pairs):
    pdf = sites()
    km = haversine(pdf.latitude.to_numpy(), pdf.longitude.to_numpy())
    df = spark.createDataFrame(pdf).repartition(5)
    got = spatial.with_density(df, 10.0, leaf_pairs=leaf_pairs).toPandas().sort_values("store_id")
    assert (got.stores_within_10km.to_numpy() == (km <= 10).sum(axis=1) - 1).all()
    got = spatial.with_clusters(df, 5.0, leaf_pairs=leaf_pairs).toPandas().sort_values("store_id")
    assert (got.cluster_id.to_numpy() == labels(km <= 5)).all()


def test_geodesic_density(spark):
    pdf = sites(2)
    n = len(pdf)
    a, b = np.repeat(np.arange(n), n), np.tile(np.arange(n), n)
    lat, lon = pdf.latitude.to_numpy(), pdf.longitude.to_numpy()
    km = _vincenty_km(lat[a], lon[a], lat[b], lon[b]).reshape(n, n)
    got = spatial.with_density(spark.createDataFrame(pdf), 10.0, distance="geodesic", leaf_pairs=64)
    assert (got.toPandas().sort_values("store_id").stores_within_10km.to_numpy() == (km <= 10).sum(axis=1) - 1).all()


def test_weighted_density_counts_rows(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0, 3), ("b", 0.0, 0.01, 5), ("c", 50.0, 0.0, 2)],
                               "store_id string, latitude double, longitude double, n int")
    got = {r.store_id: r.near for r in spatial.with_density(df, 10.0, weight="n", name="near").collect()}
    assert got == {"a": 7, "b": 7, "c": 1}


def test_unknown_positions_are_alone(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("b", 1.0, 1.0), ("c", 1.0, 1.0)],
                               "store_id string, latitude double, longitude double")
    got = {r.store_id: (r.cluster_id, r.stores_within_10km)
           for r in spatial.with_density(spatial.with_clusters(df)).collect()}
    assert got == {"a": (-1, 0), "b": (0, 1), "c": (0, 1)}


def test_single_store_is_cluster_zero(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0)], "store_id string, latitude double, longitude double")
    assert spatial.with_clusters(df).first().cluster_id == 0


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(60) if i != 30] + [(100, 90), (90, 100), (7, 7)]
    got = spatial.connected_components(spark.createDataFrame(chain, "u long, v long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.component, set()).add(r.node)
    assert groups == {0: set(range(31)), 31: set(range(31, 61)), 90: {90, 100}}


def test_enrich_rows_and_required_columns(spark):
    rows = [("a", 35.68, 139.65, "JP", 1), ("a", 35.68, 139.65, "JP", 2), ("b", 35.69, 139.66, "JP", 3),
            ("c", 60.0, 10.0, "NO", 4)]
    df = spark.createDataFrame(rows, "store_id string, latitude double, longitude double, country string, n int")
    got = {r.n: r for r in geo.enrich(df).collect()}
    assert len(got) == 4 and got[1].stores_within_10km == 1 and got[1].nearest_city == "Tokyo"
    assert got[4].economic_region == "Other" and got[4].urban_rural == "Remote" and got[4].gdp_per_capita_usd is None
    by_row = {r.n: r.stores_within_10km for r in geo.enrich(df, grain="row").collect()}
    assert by_row == {1: 2, 2: 2, 3: 2, 4: 0}
    with pytest.raises(ValueError, match="latitude"):
        geo.enrich(df.drop("latitude"))


def test_geodesic_class_can_differ_from_haversine(spark):
    df = spark.createDataFrame([("a", 35.6762, 139.6503, "JP")], "store_id string, latitude double, longitude double, country string")
    got = geo.with_location_class(df, "geodesic").first()
    assert got.nearest_city == "Tokyo" and got.distance_to_city_km < 1e-6


def test_write_geojson(spark, tmp_path):
    import json
    df = spark.createDataFrame([("a", 1.5, 2.5, "JP")], "store_id string, latitude double, longitude double, country string")
    enriched = geo.enrich(df)
    geo.write_geojson(enriched, str(tmp_path / "g"))
    (line,) = [r.value for r in spark.read.text(str(tmp_path / "g")).collect()]
    feature = json.loads(line)
    assert feature["type"] == "Feature" and feature["geometry"]["coordinates"] == [2.5, 1.5]
    assert feature["properties"]["cluster_id"] == 0
