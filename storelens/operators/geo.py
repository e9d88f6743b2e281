"""Geographic context of stores: region, nearest city, urban class, clusters, density, GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import dimensions as dim
from ..functions.distance import EARTH_RADIUS_KM, distance_km, geodesic_km, haversine_km
from ..functions.joins import join_dimension
from ..functions.materialize import checkpointed
from . import spatial

REQUIRED = ("store_id", "latitude", "longitude", "country")


def economic_region(country: Column) -> Column:
    return F.coalesce(dim.lookup(dim.COUNTRIES, country, 1), F.lit(dim.DEFAULT_REGION))


def gdp_per_capita(country: Column) -> Column:
    return dim.lookup(dim.COUNTRIES, country, 2)


def urbanization_rate(country: Column) -> Column:
    return dim.lookup(dim.COUNTRIES, country, 3)


def urban_class(km: Column) -> Column:
    return (F.when(km <= 30, "Urban").when(km <= 100, "Suburban")
            .when(km <= 300, "Rural").otherwise("Remote"))


def with_country_context(df: DataFrame) -> DataFrame:
    """Region, GDP per capita and urban share of the country: a projection, no join."""
    return df.withColumns({
        "economic_region": economic_region(F.col("country")),
        "gdp_per_capita_usd": gdp_per_capita(F.col("country")),
        "urbanization_rate": urbanization_rate(F.col("country")),
    })


def with_nearest_city(df: DataFrame, distance: str = "haversine") -> DataFrame:
    """Nearest reference city and the distance to it; the first city in list order wins a tie."""
    lat, lon = F.col("latitude"), F.col("longitude")
    if distance == "haversine":
        # a loop over one literal array keeps the plan small
        candidates = F.transform(dim.city_array(), lambda c: F.struct(
            haversine_km(lat, lon, c.lat, c.lon).alias("km"), c.ord.alias("ord"), c.city.alias("city")))
    else:
        measure = distance_km(distance)
        candidates = F.array(*[
            F.struct(measure(lat, lon, F.lit(c_lat), F.lit(c_lon)).alias("km"),
                     F.lit(i).alias("ord"), F.lit(city).alias("city"))
            for i, (city, _, c_lat, c_lon) in enumerate(dim.CITIES)])
    known = lat.isNotNull() & lon.isNotNull()
    best = F.when(known, F.array_min(candidates))
    return (df.withColumn("_near", best)
            .withColumn("nearest_city", F.coalesce(F.col("_near.city"), F.lit("Unknown")))
            .withColumn("distance_to_city_km", F.coalesce(F.col("_near.km"), F.lit(float("inf"))))
            .drop("_near"))


def distance_to_city(lat: Column, lon: Column, city: Column) -> Column:
    """Distance to a named reference city; infinite when the city is unknown."""
    km = haversine_km(lat, lon, dim.lookup(dim.CITIES, city, 2), dim.lookup(dim.CITIES, city, 3))
    return F.coalesce(km, F.lit(float("inf")))


def with_location_class(df: DataFrame, distance: str = "haversine") -> DataFrame:
    """Everything that depends on one store alone (no neighbours)."""
    return (df.transform(with_country_context)
            .transform(with_nearest_city, distance)
            .withColumn("urban_rural", urban_class(F.col("distance_to_city_km"))))


def enrich(
    df: DataFrame, *, distance: str = "haversine", grain: str = "store",
    cluster_km: float = 5.0, density_km: float = 10.0, order_by: str = "store_id",
) -> DataFrame:
    """All geographic columns. ``df`` may be stores or their transactions.

    The work is done once per site (store and position). ``grain="row"`` counts every input row as
    a neighbour of its own, as the row-wise reading of the definition does.
    """
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if grain not in ("store", "row"):
        raise ValueError("grain must be store or row")
    if order_by in REQUIRED:
        sites = df.groupBy(*REQUIRED).agg(F.count(F.lit(1)).alias("_rows"))
    else:
        sites = df.groupBy(*REQUIRED).agg(
            F.count(F.lit(1)).alias("_rows"), F.min(order_by).alias(order_by))
    weight = "_rows" if grain == "row" else None
    # from here on nothing reads the transactions again
    sites = checkpointed(with_location_class(sites, distance))
    points = spatial.site_points(sites, weight)
    sites = spatial.with_clusters(sites, cluster_km, weight=weight, order_by=order_by, points=points)
    sites = spatial.with_density(sites, density_km, weight=weight, distance=distance, points=points)
    added = ["economic_region", "nearest_city", "distance_to_city_km", "urban_rural",
             "gdp_per_capita_usd", "urbanization_rate", "cluster_id", "stores_within_10km"]
    return join_dimension(df, checkpointed(sites.select(*REQUIRED, *added)), REQUIRED, "left")


def _feature() -> Column:
    return F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"),
                 F.array("longitude", "latitude").alias("coordinates")).alias("geometry"),
        F.struct(
            "store_id", "country", "economic_region", "urban_rural", "nearest_city",
            "distance_to_city_km", F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"),
            F.coalesce("stores_within_10km", F.lit(0)).alias("competition_density"),
        ).alias("properties"),
    )


def geojson_feature() -> Column:
    """One GeoJSON Feature per row as text; absent properties are left out."""
    return F.to_json(_feature())


def geojson_collection(stores: DataFrame, most: int = 10_000) -> DataFrame:
    """(collection): all features in one GeoJSON FeatureCollection, by store. For small outputs: more than ``most``
    stores are refused, and :func:`write_geojson` takes them."""
    if stores.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} features: write one per line instead")
    features = F.array_sort(F.collect_list(F.struct("store_id", _feature().alias("f"))))
    return stores.agg(features.alias("all")).select(F.to_json(F.struct(
        F.lit("FeatureCollection").alias("type"), F.col("all.f").alias("features"))).alias("collection"))


def geojson_features(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", geojson_feature().alias("feature"))


def write_geojson(stores: DataFrame, path: str) -> None:
    """Newline-delimited GeoJSON, one feature per line, written in parallel."""
    stores.select(geojson_feature().alias("value")).write.mode("overwrite").text(path)


def stores_near(
    stores: DataFrame, lat: float, lon: float, radius_km: float, kpis: DataFrame | None = None, *,
    distance: str = "haversine",
) -> DataFrame:
    """Stores within ``radius_km`` of a point, nearest first, with their newest KPIs.

    The latitude band is a plain range predicate and reaches the parquet scan.
    """
    band = radius_km / (EARTH_RADIUS_KM * 3.141592653589793 / 180) * 1.01
    here = (F.lit(float(lat)), F.lit(float(lon)))
    measure = haversine_km if distance == "haversine" else geodesic_km
    near = (stores.where(F.col("latitude").between(lat - band, lat + band))
            .withColumn("distance_km", measure(F.col("latitude"), F.col("longitude"), *here))
            .where(F.col("distance_km") <= radius_km)
            .select("store_id", "country", "economic_region", "distance_km"))
    if kpis is not None:
        newest = kpis.groupBy("store_id").agg(
            F.max_by(F.struct("revenue_mtd", "same_store_sales_growth"), "calculation_date").alias("k"))
        near = near.join(newest, "store_id", "left").select(
            *near.columns, "k.revenue_mtd", "k.same_store_sales_growth")
    return near.orderBy("distance_km", "store_id")
