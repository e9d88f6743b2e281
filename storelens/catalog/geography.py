"""Checks of the geographic operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geo, kpi, spatial
from ..sources import retail_tables as rt
from . import frames as fr
from .sql import km, money_sum


def country_context(spark, d):
    return geo.with_country_context(rt.stores(spark, d)).select(
        "store_id", "country", "economic_region", "gdp_per_capita_usd", "urbanization_rate")


def nearest_city(spark, d):
    return fr.rounded(fr.located_stores(spark, d).select(
        "store_id", "nearest_city", "distance_to_city_km", "urban_rural"), "distance_to_city_km")


def city_distance(spark, d):
    """Distance of each store to the city of its own list entry and to an unknown one."""
    s = rt.stores(spark, d)
    lat, lon = F.col("latitude"), F.col("longitude")
    return s.select(
        "store_id", F.round(geo.distance_to_city(lat, lon, F.lit("Tokyo")), 6).alias("to_tokyo"),
        (geo.distance_to_city(lat, lon, F.lit("Atlantis")) > 1e300).alias("unknown_is_far"))


def clusters(spark, d):
    return spatial.with_clusters(rt.stores(spark, d)).select("store_id", "cluster_id")


def density(spark, d):
    return spatial.with_density(rt.stores(spark, d)).select("store_id", "stores_within_10km")


def density_of_rows(spark, d):
    """The row-grain reading: every sale is a neighbour."""
    sales = rt.sales(spark, d).groupBy("store_id").agg(F.count(F.lit(1)).alias("rows"))
    sites = rt.stores(spark, d).join(sales, "store_id")
    return spatial.with_density(sites, weight="rows", name="rows_within_10km").select("store_id", "rows_within_10km")


def enriched(spark, d):
    out = geo.enrich(rt.stores(spark, d)).select(
        "store_id", "economic_region", "nearest_city", "distance_to_city_km", "urban_rural",
        "gdp_per_capita_usd", "urbanization_rate", "stores_within_10km", "cluster_id")
    return fr.rounded(out, "distance_to_city_km")


def geojson(spark, d):
    """Features, read back from their JSON text."""
    features = geo.geojson_features(spatial.with_density(fr.located_stores(spark, d)).withColumn(
        "cluster_id", F.lit(None).cast("int")))
    p = F.from_json("feature", "type string, geometry struct<type:string,coordinates:array<double>>, properties "
                    "struct<store_id:string,economic_region:string,cluster_id:int,competition_density:bigint>")
    return features.withColumn("f", p).select(
        "store_id", F.col("f.type").alias("type"), F.col("f.geometry.type").alias("geometry_type"),
        F.round(F.col("f.geometry.coordinates")[0], 6).alias("longitude"),
        F.round(F.col("f.geometry.coordinates")[1], 6).alias("latitude"),
        F.col("f.properties.economic_region").alias("economic_region"),
        F.col("f.properties.cluster_id").cast("bigint").alias("cluster_id"),
        F.col("f.properties.competition_density").alias("competition_density"))


def near_point(spark, d):
    stores = geo.with_country_context(rt.stores(spark, d))
    kpis = kpi.store_kpi_table(stores, fr.usd_sales(spark, d, "country"), fr.REFERENCE_DATE, upper_bound=True)
    return fr.rounded(geo.stores_near(stores, 35.0, 139.0, 700.0, kpis), "distance_km")


QUERIES = {
    "geo_country_context": country_context,
    "geo_nearest_city": nearest_city,
    "geo_city_distance": city_distance,
    "geo_clusters": clusters,
    "geo_competition_density": density,
    "geo_competition_density_rows": density_of_rows,
    "geo_enriched_stores": enriched,
    "geo_geojson_features": geojson,
    "geo_stores_near_point": near_point,
}

_CLUSTERS = f"""
    links AS (SELECT a.store_id AS u, b.store_id AS v FROM stores a JOIN stores b ON a.store_id <> b.store_id
              AND abs(a.latitude - b.latitude) < 0.05
              AND {km('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} <= 5),
    reach(s, t) AS (SELECT store_id, store_id FROM stores
                    UNION SELECT reach.s, links.v FROM reach JOIN links ON reach.t = links.u),
    roots AS (SELECT s AS store_id, min(t) AS root, count(*) AS members FROM reach GROUP BY s),
    numbered AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS no
                 FROM (SELECT DISTINCT root FROM roots WHERE members > 1)),
    labels AS (SELECT r.store_id, CAST(coalesce(n.no, -1) AS INTEGER) AS cluster_id
               FROM roots r LEFT JOIN numbered n ON r.root = n.root)"""

SQL = {
    "geo_country_context": """
        SELECT store_id, country, economic_region, gdp_per_capita_usd, urbanization_rate FROM geo_stores""",
    "geo_nearest_city": """
        SELECT store_id, nearest_city, round(distance_to_city_km, 6) AS distance_to_city_km, urban_rural
        FROM geo_stores""",
    "geo_city_distance": f"""
        SELECT store_id, round({km('latitude', 'longitude', '35.6762::DOUBLE', '139.6503::DOUBLE')}, 6) AS to_tokyo,
               true AS unknown_is_far FROM stores""",
    "geo_clusters": f"WITH {_CLUSTERS} SELECT store_id, cluster_id FROM labels",
    "geo_competition_density": "SELECT store_id, stores_within_10km FROM density",
    "geo_competition_density_rows": f"""
        WITH n AS (SELECT store_id, count(*) AS c FROM sales GROUP BY store_id),
        sites AS (SELECT * FROM stores JOIN n USING (store_id))
        SELECT a.store_id, CAST(sum(b.c) - 1 AS BIGINT) AS rows_within_10km
        FROM sites a JOIN sites b ON {km('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} <= 10
        GROUP BY a.store_id""",
    "geo_enriched_stores": f"""
        WITH {_CLUSTERS}
        SELECT store_id, economic_region, nearest_city, round(distance_to_city_km, 6) AS distance_to_city_km,
               urban_rural, gdp_per_capita_usd, urbanization_rate, stores_within_10km, cluster_id
        FROM geo_stores JOIN density USING (store_id) JOIN labels USING (store_id)""",
    "geo_geojson_features": """
        SELECT store_id, 'Feature' AS type, 'Point' AS geometry_type, round(longitude, 6) AS longitude,
               round(latitude, 6) AS latitude, economic_region, CAST(-1 AS BIGINT) AS cluster_id,
               stores_within_10km AS competition_density
        FROM geo_stores JOIN density USING (store_id)""",
    "geo_stores_near_point": f"""
        WITH k AS (SELECT store_id,
            {money_sum("CASE WHEN date >= DATE '2000-06-01' THEN revenue_usd END")} AS mtd,
            {money_sum("CASE WHEN date >= DATE '1999-06-01' AND date < DATE '1999-07-01' THEN revenue_usd END")} AS prior
            FROM usd_sales WHERE date <= DATE '2000-06-30' GROUP BY store_id),
        near AS (SELECT store_id, country, economic_region,
                 {km('latitude', 'longitude', '35.0::DOUBLE', '139.0::DOUBLE')} AS km FROM geo_stores)
        SELECT store_id, country, economic_region, round(km, 6) AS distance_km,
               coalesce(mtd, 0.0) AS revenue_mtd,
               coalesce(mtd, 0.0) / nullif(prior, 0) - 1 AS same_store_sales_growth
        FROM near LEFT JOIN k USING (store_id) WHERE km <= 700""",
}
