"""Nearest centre per point, without pairing all points with all centres."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctualis.functions.geo import haversine_m

TREE_DEPTH = 24
LEAF_CENTRES = 64


def nearest(points: DataFrame, centres: DataFrame, leaf_centres: int = LEAF_CENTRES) -> DataFrame:
    """Add ``centre`` and ``distance_m`` of the closest centre to every row of ``points``.

    ``points``: lat, lon plus payload; ``centres``: centre (name), lat, lon. Ties go to the smaller name.
    The search is exact, over the leaves of a quadtree; no job runs while the plan is built.
    """
    centres = centres.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return _by_tree(points, centres.groupBy("lat", "lon").agg(F.min("centre").alias("centre")), leaf_centres)


def _closest(found: Column, lat: Column, lon: Column) -> Column:
    return F.array_min(
        F.transform(found, lambda c: F.struct(haversine_m(lat, lon, c["lat"], c["lon"]).alias("d"), c["centre"].alias("name")))
    )


def _unit_vector(lat: Column, lon: Column) -> list[Column]:
    a, b = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)]


def _by_tree(points: DataFrame, centres: DataFrame, leaf_centres: int) -> DataFrame:
    leaves = _leaves(centres, leaf_centres)
    boxes = leaves.agg(F.collect_list(F.struct("leaf", "lo", "hi")).alias("_boxes"))

    # straight-line distance on the unit sphere grows with the distance along it
    where = points.select("lat", "lon").dropna().distinct()
    where = where.withColumn("_p", F.array(*_unit_vector(F.col("lat"), F.col("lon")))).join(F.broadcast(boxes), F.lit(True))

    def bound(box: Column, near: bool) -> Column:
        total = F.lit(0.0)
        for i in range(3):
            p, lo, hi = F.col("_p")[i], box["lo"][i], box["hi"][i]
            gap = F.greatest(lo - p, F.lit(0.0), p - hi) if near else F.greatest(F.abs(p - lo), F.abs(p - hi))
            total = total + gap * gap
        return total

    where = where.withColumn("_reach", F.array_min(F.transform("_boxes", lambda b: bound(b, near=False))))
    hit = F.filter("_boxes", lambda b: bound(b, near=True) <= F.col("_reach") + 1e-15)
    visits = where.select("lat", "lon", F.explode(F.transform(hit, lambda b: b["leaf"])).alias("leaf"))
    best = (
        visits.join(leaves.select("leaf", "members"), "leaf")
        .select("lat", "lon", _closest(F.col("members"), F.col("lat"), F.col("lon")).alias("_hit"))
        .groupBy("lat", "lon")
        .agg(F.min("_hit").alias("_hit"))
        .select("lat", "lon", F.col("_hit.name").alias("centre"), F.col("_hit.d").alias("distance_m"))
    )
    return points.join(best, ["lat", "lon"], "left").select(*points.columns, "centre", "distance_m")


def _leaves(centres: DataFrame, leaf_centres: int) -> DataFrame:
    """Quadtree leaves over the centres: id, bounding box of the unit vectors and member list.

    A leaf is the largest square with at most ``max(leaf_centres, n/256)`` centres. A level has at
    most 256 larger squares, so there are at most 4 * 256 leaves per level, whatever n is.
    """
    size = 1 << TREE_DEPTH
    cell = lambda share: F.least(F.floor(share * size), F.lit(size - 1)).cast("long")
    x, y = cell((F.col("lon") + 180) / 360), cell((F.col("lat") + 90) / 180)
    nodes = centres.withColumn("_depth", F.explode(F.sequence(F.lit(0), F.lit(TREE_DEPTH))))
    shift = F.pow(F.lit(2), TREE_DEPTH - F.col("_depth"))
    nodes = nodes.withColumn("_x", F.floor(x / shift)).withColumn("_y", F.floor(y / shift))

    counts = nodes.groupBy("_depth", "_x", "_y").agg(F.count(F.lit(1)).alias("_n"))
    limit = counts.filter(F.col("_depth") == 0).agg(F.greatest(F.lit(leaf_centres), F.ceil(F.max("_n") / 256)).alias("_limit"))
    big = counts.join(F.broadcast(limit), F.lit(True))
    parents = big.filter(F.col("_n") > F.col("_limit")).select(
        (F.col("_depth") + 1).alias("_depth"), F.col("_x").alias("_px"), F.col("_y").alias("_py")
    )
    small = big.filter((F.col("_n") <= F.col("_limit")) | (F.col("_depth") == TREE_DEPTH))
    small = small.withColumn("_px", F.floor(F.col("_x") / 2)).withColumn("_py", F.floor(F.col("_y") / 2))
    inner = small.join(parents, ["_depth", "_px", "_py"], "left_semi")
    leaf_ids = inner.unionByName(small.filter(F.col("_depth") == 0)).select("_depth", "_x", "_y")

    v = _unit_vector(F.col("lat"), F.col("lon"))
    return (
        nodes.join(leaf_ids, ["_depth", "_x", "_y"])
        .groupBy(F.struct("_depth", "_x", "_y").alias("leaf"))
        .agg(
            F.array(*[F.min(c) for c in v]).alias("lo"),
            F.array(*[F.max(c) for c in v]).alias("hi"),
            F.collect_list(F.struct("lat", "lon", "centre")).alias("members"),
        )
    )


STEP = 4  # levels of the quadtree that a descent takes at once


def nearest_of_many(points: DataFrame, centres: DataFrame, leaf_centres: int = LEAF_CENTRES) -> DataFrame:
    """As ``nearest``, for any number of centres: leaves hold at most ``leaf_centres`` of them, whatever their number.

    Points descend a quadtree of which every ``STEP``-th level is used, one join per level. Of the children of its nodes a point keeps
    those that may be nearer than the farthest corner of the best child, so it carries a few nodes and never a list of
    all. Nodes with few centres are leaves and wait; the last join meets their members. Centres of one place count once.
    """
    centres = centres.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy("lat", "lon").agg(F.min("centre").alias("centre"))
    tree = _levels(centres)
    is_leaf = (F.col("_n") <= leaf_centres) | (F.col("_depth") == TREE_DEPTH)
    box = F.struct(F.struct("_depth", "_x", "_y").alias("node"), is_leaf.alias("leaf"), "lo", "hi")
    up = lambda c: F.floor(F.col(c) / (1 << STEP)).cast("long")
    parents = F.struct((F.col("_depth") - STEP).cast("int").alias("_depth"), up("_x").alias("_x"), up("_y").alias("_y"))
    families = tree.filter(F.col("_depth") > 0).groupBy("_depth", parents.alias("_node")).agg(F.collect_list(box).alias("_boxes"))

    root = F.struct(F.lit(0).alias("_depth"), F.lit(0).cast("long").alias("_x"), F.lit(0).cast("long").alias("_y"))
    where = points.select("lat", "lon").dropna().distinct().withColumn("_p", F.array(*_unit_vector(F.col("lat"), F.col("lon"))))
    found = where.withColumns({"_open": F.array(root), "_reach": F.lit(9.0), "_leaves": F.array().cast("array<struct<node:struct<_depth:int,_x:bigint,_y:bigint>,near:double>>")})

    def bound(b: Column, near: bool) -> Column:
        total = F.lit(0.0)
        for i in range(3):
            p, lo, hi = F.col("_p")[i], b["lo"][i], b["hi"][i]
            gap = F.greatest(lo - p, F.lit(0.0), p - hi) if near else F.greatest(F.abs(p - lo), F.abs(p - hi))
            total = total + gap * gap
        return total

    for depth in range(STEP, TREE_DEPTH + 1, STEP):
        level = families.filter(F.col("_depth") == depth).select("_node", "_boxes")
        asked = found.select("lat", "lon", "_p", "_reach", "_leaves", F.explode_outer("_open").alias("_node"))
        met = asked.join(level, "_node", "left")
        measured = F.transform("_boxes", lambda b: F.struct(b["node"].alias("node"), b["leaf"].alias("leaf"), bound(b, True).alias("near"), bound(b, False).alias("far")))
        met = met.withColumn("_seen", F.coalesce(measured, F.array().cast("array<struct<node:struct<_depth:int,_x:bigint,_y:bigint>,leaf:boolean,near:double,far:double>>")))
        met = met.withColumn("_reach", F.least("_reach", F.array_min(F.transform("_seen", lambda b: b["far"]))))
        met = met.withColumn("_seen", F.filter("_seen", lambda b: b["near"] <= F.col("_reach") + 1e-15))
        met = met.groupBy("lat", "lon").agg(F.first("_p").alias("_p"), F.min("_reach").alias("_reach"), F.first("_leaves").alias("_leaves"), F.flatten(F.collect_list("_seen")).alias("_seen"))
        near = F.filter("_seen", lambda b: b["near"] <= F.col("_reach") + 1e-15)
        leaves = F.transform(F.filter(near, lambda b: b["leaf"]), lambda b: F.struct(b["node"].alias("node"), b["near"].alias("near")))
        found = met.select("lat", "lon", "_p", "_reach", F.filter(F.concat("_leaves", leaves), lambda b: b["near"] <= F.col("_reach") + 1e-15).alias("_leaves"),
                           F.transform(F.filter(near, lambda b: ~b["leaf"]), lambda b: b["node"]).alias("_open"))

    members = centres.withColumns(_cells()).select(F.explode(F.transform(F.array(*[F.lit(d) for d in range(0, TREE_DEPTH + 1, STEP)]), _node_at)).alias("leaf"), "lat", "lon", "centre")
    used = tree.filter(is_leaf & (F.col("_depth") > 0)).select(F.struct("_depth", "_x", "_y").alias("leaf"))
    members = members.join(used, "leaf", "left_semi").groupBy("leaf").agg(F.collect_list(F.struct("lat", "lon", "centre")).alias("members"))
    visits = found.select("lat", "lon", F.explode(F.array_distinct(F.transform("_leaves", lambda b: b["node"]))).alias("leaf"))
    best = visits.join(members, "leaf").select("lat", "lon", _closest(F.col("members"), F.col("lat"), F.col("lon")).alias("_hit")).groupBy("lat", "lon").agg(F.min("_hit").alias("_hit"))
    best = best.select("lat", "lon", F.col("_hit.name").alias("centre"), F.col("_hit.d").alias("distance_m"))
    return points.join(best, ["lat", "lon"], "left").select(*points.columns, "centre", "distance_m")


def _cells() -> dict[str, Column]:
    """Place of a centre on the finest grid."""
    size = 1 << TREE_DEPTH
    cell = lambda share: F.least(F.floor(share * size), F.lit(size - 1)).cast("long")
    return {"_cx": cell((F.col("lon") + 180) / 360), "_cy": cell((F.col("lat") + 90) / 180)}


def _node_at(depth: Column) -> Column:
    shift = F.pow(F.lit(2), TREE_DEPTH - depth)
    return F.struct(depth.cast("int").alias("_depth"), F.floor(F.col("_cx") / shift).cast("long").alias("_x"), F.floor(F.col("_cy") / shift).cast("long").alias("_y"))


def _levels(centres: DataFrame) -> DataFrame:
    """Nodes of every ``STEP``-th level: depth, cell, number of centres, bounding box of their unit vectors."""
    nodes = centres.withColumns(_cells()).withColumn("_at", F.explode(F.transform(F.array(*[F.lit(d) for d in range(0, TREE_DEPTH + 1, STEP)]), _node_at)))
    v = _unit_vector(F.col("lat"), F.col("lon"))
    return nodes.groupBy("_at").agg(F.count(F.lit(1)).alias("_n"), F.array(*[F.min(c) for c in v]).alias("lo"), F.array(*[F.max(c) for c in v]).alias("hi")).select("_at.*", "_n", "lo", "hi")
