"""Neighbours within a radius, without comparing every pair.

Positions become points in space and are put into cubes as wide as the radius; only the 27 cubes
around a cube can hold neighbours. For a pair of cubes the bounding boxes often decide at once:
too far apart (dropped) or everything within the radius (counted wholesale). Only undecided pairs
are compared point by point, and only when both cubes are small; crowded cubes are halved and
looked at again. So a place that holds a third of all stores costs a few more rounds, not a
quadratic number of pairs, and no result is cut off.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.distance import EARTH_RADIUS_KM, GEODESIC_SLACK, distance_km
from ..functions.materialize import checkpointed
from ..functions.ranks import with_rank

# Two cubes are compared point by point up to this many pairs.
LEAF_PAIRS = 4096
# Below a cube width of radius / 2**MAX_LEVEL positions are as good as equal.
MAX_LEVEL = 30

AXES = ("x", "y", "z")
CELL = ("cx", "cy", "cz")


def _chord(km: float) -> float:
    from math import pi, sin
    return 2 * EARTH_RADIUS_KM * sin(min(km / EARTH_RADIUS_KM, pi) / 2)


def site_points(sites: DataFrame, weight: str | None = None) -> DataFrame:
    """Distinct positions with the number of sites at each, stored once."""
    w = F.sum(weight) if weight else F.count(F.lit(1))
    lat, lon = F.radians("latitude"), F.radians("longitude")
    return checkpointed(
        sites.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .groupBy("latitude", "longitude").agg(w.alias("w"))
        .select("latitude", "longitude", "w", F.monotonically_increasing_id().alias("pid"),
                (F.cos(lat) * F.cos(lon) * EARTH_RADIUS_KM).alias("x"),
                (F.cos(lat) * F.sin(lon) * EARTH_RADIUS_KM).alias("y"),
                (F.sin(lat) * EARTH_RADIUS_KM).alias("z")))


def _in_cells(points: DataFrame, side: float) -> DataFrame:
    return points.withColumns({
        c: F.floor(F.col(a) / F.lit(side)) for c, a in zip(CELL, AXES)})


def _cells(points: DataFrame, side: float) -> DataFrame:
    box = [f(a).alias(f"{a}_{n}") for a in AXES for f, n in ((F.min, "lo"), (F.max, "hi"))]
    return _in_cells(points, side).groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), F.min("pid").alias("rep"), *box)


def _side(cells: DataFrame, prefix: str) -> DataFrame:
    return cells.select(*[F.col(c).alias(f"{prefix}{c}") for c in cells.columns])


def _gap2() -> Column:
    """Smallest squared distance the two boxes allow."""
    return reduce(lambda s, t: s + t, [
        F.pow(F.greatest(F.lit(0.0), F.col(f"a_{a}_lo") - F.col(f"b_{a}_hi"),
                         F.col(f"b_{a}_lo") - F.col(f"a_{a}_hi")), F.lit(2)) for a in AXES])


def _span2() -> Column:
    """Largest squared distance the two boxes allow."""
    return reduce(lambda s, t: s + t, [
        F.pow(F.greatest(F.col(f"a_{a}_hi") - F.col(f"b_{a}_lo"),
                         F.col(f"b_{a}_hi") - F.col(f"a_{a}_lo")), F.lit(2)) for a in AXES])


def _levels(points: DataFrame, radius_km: float, distance: str, leaf_pairs: int):
    """Yield (cube width, pairs wholly inside, pairs to compare point by point) per round."""
    slack = GEODESIC_SLACK if distance == "geodesic" else 1e-9
    outer = _chord(radius_km * (1 + slack))
    inner = _chord(radius_km / (1 + slack))
    side = outer
    cells = _cells(points, side)
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    around = cells
    for c in CELL:
        around = around.withColumn(f"d{c}", F.explode(steps))
    around = _side(around, "a_")
    near = [F.col(f"a_{c}") + F.col(f"a_d{c}") == F.col(f"b_{c}") for c in CELL]
    pairs = around.join(_side(cells, "b_"), near).drop(*[f"a_d{c}" for c in CELL])
    crowded = cells.agg(F.max("n")).first()[0] or 0
    level = 0
    while True:
        judged = pairs.withColumn("_span", _span2()).where(_gap2() <= outer * outer)
        whole = judged.where(F.col("_span") <= inner * inner)
        open_pairs = judged.where(F.col("_span") > inner * inner)
        last = level >= MAX_LEVEL or crowded * crowded <= leaf_pairs
        small = F.col("a_n") * F.col("b_n") <= leaf_pairs
        yield side, whole, (open_pairs if last else open_pairs.where(small))
        if last:
            return
        heavy = checkpointed(open_pairs.where(~small).drop("_span"))
        if heavy.isEmpty():
            return
        side, level = side / 2, level + 1
        children = checkpointed(_cells(points, side))
        up = children.withColumns({f"p{c}": F.floor(F.col(c) / 2) for c in CELL})
        ids = heavy.select(*[f"{p}{c}" for p in ("a_", "b_") for c in CELL]).withColumnsRenamed(
            {f"{p}{c}": f"{p}p{c}" for p in ("a_", "b_") for c in CELL})
        pairs = (ids.join(_side(up, "a_"), [f"a_p{c}" for c in CELL])
                 .join(_side(up, "b_"), [f"b_p{c}" for c in CELL])
                 .drop(*[f"{p}p{c}" for p in ("a_", "b_") for c in CELL]))
        crowded = children.agg(F.max("n")).first()[0]


def _close_points(points: DataFrame, pairs: DataFrame, side: float, radius_km: float, distance: str) -> DataFrame:
    """Pairs of points within the radius, from cube pairs of bounded size."""
    placed = _in_cells(points, side).select("pid", "w", "latitude", "longitude", *CELL)
    ids = pairs.select(*[f"{p}{c}" for p in ("a_", "b_") for c in CELL])
    both = (ids.join(_side(placed, "a_"), [f"a_{c}" for c in CELL])
            .join(_side(placed, "b_"), [f"b_{c}" for c in CELL]))
    km = distance_km(distance)(F.col("a_latitude"), F.col("a_longitude"),
                               F.col("b_latitude"), F.col("b_longitude"))
    return both.withColumn("_km", km).where(F.col("_km") <= radius_km)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def with_density(
    sites: DataFrame, radius_km: float = 10.0, *, weight: str | None = None,
    distance: str = "haversine", name: str = "stores_within_10km", leaf_pairs: int = LEAF_PAIRS,
    points: DataFrame | None = None,
) -> DataFrame:
    """Number of other sites within ``radius_km`` (of other rows, when ``weight`` counts rows)."""
    points = site_points(sites, weight) if points is None else points
    counts = []
    for side, whole, leaf in _levels(points, radius_km, distance, leaf_pairs):
        per_cell = whole.groupBy(*[f"a_{c}" for c in CELL]).agg(F.sum("b_w").alias("near"))
        per_cell = per_cell.withColumnsRenamed({f"a_{c}": c for c in CELL})
        counts.append(_in_cells(points, side).join(per_cell, list(CELL)).select("pid", "near"))
        counts.append(_close_points(points, leaf, side, radius_km, distance)
                      .select(F.col("a_pid").alias("pid"), F.col("b_w").alias("near")))
    totals = _union(counts).groupBy("pid").agg(F.sum("near").alias("near"))
    per_place = (points.join(totals, "pid").select("latitude", "longitude", "near"))
    # every point is its own neighbour once
    return (sites.join(per_place, ["latitude", "longitude"], "left")
            .withColumn(name, F.coalesce(F.col("near") - 1, F.lit(0)).cast("bigint"))
            .select(*sites.columns, name))


def _is_star(edges: DataFrame) -> bool:
    several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("u")
    chained = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return several.union(chained).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected edge list (u, v); the component is its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): every round is a few
    joins and minima, the edge list never grows, and the number of rounds is logarithmic.
    """
    e = checkpointed(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _is_star(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpointed(moved.unionByName(low.withColumnRenamed("m", "v")).distinct())
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def with_clusters(
    sites: DataFrame, radius_km: float = 5.0, *, weight: str | None = None,
    order_by: str = "store_id", name: str = "cluster_id", leaf_pairs: int = LEAF_PAIRS,
    points: DataFrame | None = None,
) -> DataFrame:
    """Density clusters with two members or more; -1 marks an isolated site.

    With a minimum of two members these are the connected components of "within ``radius_km``".
    Clusters are numbered from 0 by their first site in ``order_by``.
    """
    points = site_points(sites, weight) if points is None else points
    edges = []
    for side, whole, leaf in _levels(points, radius_km, "haversine", leaf_pairs):
        # all points of two cubes wholly within the radius hang together: link each to one of its cube
        cubes = whole.select(*[F.col(f"a_{c}").alias(c) for c in CELL], F.col("a_rep").alias("rep")).distinct()
        edges.append(_in_cells(points, side).join(cubes, list(CELL)).select(
            F.col("pid").alias("u"), F.col("rep").alias("v")))
        edges.append(whole.where(F.col("a_rep") > F.col("b_rep")).select(
            F.col("a_rep").alias("u"), F.col("b_rep").alias("v")))
        edges.append(_close_points(points, leaf, side, radius_km, "haversine")
                     .where(F.col("a_pid") > F.col("b_pid"))
                     .select(F.col("a_pid").alias("u"), F.col("b_pid").alias("v")))
    found = connected_components(_union(edges))
    placed = (points.join(found.withColumnRenamed("node", "pid"), "pid", "left")
              .select("latitude", "longitude", "w", F.coalesce("component", "pid").alias("component")))
    sizes = placed.groupBy("component").agg(F.sum("w").alias("members"))
    groups = placed.join(sizes.where(F.col("members") >= 2), "component")
    first = (sites.join(groups.select("latitude", "longitude", "component"), ["latitude", "longitude"])
             .groupBy("component").agg(F.min(order_by).alias("_first")))
    numbered = with_rank(first, [], "_first", ascending=True, dense_rank="_no").select("component", "_no")
    labels = groups.join(numbered, "component").select(
        "latitude", "longitude", (F.col("_no") - 1).alias(name))
    alone = sites.limit(2).count() < 2
    return (sites.join(labels, ["latitude", "longitude"], "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0 if alone else -1)).cast("int"))
            .select(*sites.columns, name))
