"""Spatial joins and rasters (inventory M1 to M12, C10, C12, A18)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from civicframe.functions.hashing import hash48, sql_hash48
from civicframe.operators import spatial as sp
from civicframe.plans.registry import query

# Customers at hash positions in [0, 100)^2; one box and one diamond per nation on a 5 x 5 grid.
X, Y = f"({sql_hash48('x', 'c_custkey')} % 100000 / 1000.0)::DOUBLE", f"({sql_hash48('y', 'c_custkey')} % 100000 / 1000.0)::DOUBLE"
PTS = f"pts AS (SELECT c_custkey AS pt_id, {X} AS x, {Y} AS y, c_acctbal AS weight FROM customer)"
BOXES = "boxes AS (SELECT n_nationkey AS poly_id, 20.0 * (n_nationkey % 5) + 2 AS x0, 20.0 * floor(n_nationkey / 5) + 2 AS y0, 20.0 * (n_nationkey % 5) + 16 AS x1, 20.0 * floor(n_nationkey / 5) + 16 AS y1 FROM nation)"


def points(t):
    def position(seed):
        return (hash48(seed, "c_custkey") % 100000).cast("double") / 1000.0

    return t.customer.select(F.col("c_custkey").alias("pt_id"), position("x").alias("x"), position("y").alias("y"), F.col("c_acctbal").alias("weight"))


def corner():
    return 20.0 * (F.col("n_nationkey") % 5), 20.0 * F.floor(F.col("n_nationkey") / 5)


def boxes(t):
    x, y = corner()
    return t.nation.select(F.col("n_nationkey").alias("poly_id"), sp.box(x + 2, y + 2, x + 16, y + 16).alias("ring"))


def diamonds(t):
    x, y = corner()
    ring = F.array(sp.xy(x + 10, y + 1), sp.xy(x + 19, y + 10), sp.xy(x + 10, y + 19), sp.xy(x + 1, y + 10), sp.xy(x + 10, y + 1))
    return t.nation.select(F.col("n_nationkey").alias("poly_id"), ring.alias("ring"))


def roads(t):
    y = 10.0 + 20.0 * F.col("r_regionkey")
    return t.region.select(F.col("r_regionkey").alias("road_id"), sp.line((F.lit(0.0), y), (F.lit(60.0), y), (F.lit(60.0), y + 5)).alias("path"))


@query("m3_build_boxes", f"WITH {BOXES} SELECT poly_id, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1 FROM boxes")
def _(t):
    rows = boxes(t)
    return rows.select("poly_id", *[c.alias(k) for k, c in sp.extent(F.col("ring")).items()])


@query("c10_points_in_boxes", f"WITH {PTS}, {BOXES} SELECT pt_id, COALESCE(poly_id, -1) AS poly_id FROM pts LEFT JOIN boxes ON x > x0 AND x < x1 AND y > y0 AND y < y1")
def _(t):
    out = sp.points_in_polygons(points(t), boxes(t), "ring", 10.0)
    return out.select("pt_id", F.coalesce("poly_id", F.lit(-1)).alias("poly_id"))


@query("m5_points_in_polygons", f"WITH {PTS} SELECT n_nationkey AS poly_id, COUNT(pt_id) AS n_inside FROM nation LEFT JOIN pts ON abs(x - (20.0 * (n_nationkey % 5) + 10)) + abs(y - (20.0 * floor(n_nationkey / 5) + 10)) < 9 GROUP BY 1")
def _(t):
    inside = sp.points_in_polygons(points(t), diamonds(t), "ring", 10.0, how="inner").groupBy("poly_id").agg(F.count(F.lit(1)).alias("n_inside"))
    return t.nation.select(F.col("n_nationkey").alias("poly_id")).join(inside, "poly_id", "left").na.fill(0, ["n_inside"])


@query("m4_line_buffer", f"""WITH {PTS}, s AS (SELECT r_regionkey AS road_id, 10.0 + 20.0 * r_regionkey AS ry FROM region)
SELECT pt_id, road_id FROM pts, s WHERE (x <= 60 AND abs(y - ry) <= 1.5) OR (x > 60 AND sqrt((x - 60) * (x - 60) + (y - ry) * (y - ry)) <= 1.5)
OR (y >= ry AND y <= ry + 5 AND abs(x - 60) <= 1.5) OR (y > ry + 5 AND sqrt((x - 60) * (x - 60) + (y - ry - 5) * (y - ry - 5)) <= 1.5)""")
def _(t):
    return sp.points_near_lines(points(t), roads(t), "path", 1.5, 10.0, how="inner").select("pt_id", "road_id")


SUPPLIERS = f"""sup AS (SELECT s_suppkey AS s_id, ({sql_hash48('sx', 's_suppkey')} % 100000 / 1000.0)::DOUBLE AS bx, ({sql_hash48('sy', 's_suppkey')} % 100000 / 1000.0)::DOUBLE AS by_ FROM supplier)"""


def suppliers(t):
    def position(seed):
        return (hash48(seed, "s_suppkey") % 100000).cast("double") / 1000.0

    return t.supplier.select(F.col("s_suppkey").alias("s_id"), position("sx").alias("bx"), position("sy").alias("by"))


def sites(t):
    return points(t).withColumnsRenamed({"x": "ax", "y": "ay"})


GAP = "sqrt((x - bx) * (x - bx) + (y - by_) * (y - by_))"


@query("c12_distance_join", f"WITH {PTS}, {SUPPLIERS} SELECT pt_id, s_id, ROUND({GAP}, 9) AS distance FROM pts, sup WHERE {GAP} <= 5")
def _(t):
    return sp.distance_join(sites(t), suppliers(t), 5.0).select("pt_id", "s_id", F.round("distance", 9).alias("distance"))


@query("m12_neighbourhood_exposure", f"WITH {PTS}, {SUPPLIERS} SELECT pt_id, COUNT(s_id) AS n_near, ROUND(COALESCE(SUM(1.0 / (1 + {GAP})), 0), 9) AS exposure FROM pts LEFT JOIN sup ON {GAP} <= 5 GROUP BY pt_id")
def _(t):
    return sp.neighbourhood(sites(t), "pt_id", suppliers(t), 5.0).select("pt_id", "n_near", F.round("exposure", 9).alias("exposure"))


R = repr(sp.EARTH_RADIUS)


@query("m6_web_mercator", f"WITH {PTS} SELECT pt_id, ROUND({R} * radians(x - 50), 4) AS x, ROUND({R} * ln(tan({math.pi / 4!r} + radians(y / 2) / 2)), 4) AS y FROM pts")
def _(t):
    lonlat = points(t).select("pt_id", (F.col("x") - 50).alias("x"), (F.col("y") / 2).alias("y"))
    return sp.reproject(lonlat, "x", "y", "EPSG:4326", "EPSG:3857").select("pt_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("m6_utm_round_trip", f"WITH {PTS} SELECT pt_id, ROUND(9 + (x - 50) / 20, 6) AS x, ROUND(y / 2, 6) AS y FROM pts")
def _(t):
    lonlat = points(t).select("pt_id", (9 + (F.col("x") - 50) / 20).alias("x"), (F.col("y") / 2).alias("y"))
    there = sp.reproject(lonlat, "x", "y", "EPSG:4326", "EPSG:32632")
    back = sp.reproject(there, "x", "y", "EPSG:32632", "EPSG:4326")
    return back.select("pt_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("m7_crs_check", f"WITH {PTS}, {BOXES} SELECT COUNT(*) AS n FROM pts JOIN boxes ON x > x0 AND x < x1 AND y > y0 AND y < y1")
def _(t):
    pts, polys = points(t).withColumn("crs", F.lit("EPSG:3857")), boxes(t).withColumn("crs", F.lit("EPSG:3857"))
    sp.check_crs(pts, polys)
    return sp.points_in_polygons(pts.drop("crs"), polys, "ring", 10.0, how="inner").agg(F.count(F.lit(1)).alias("n"))


# One pixel per event, 100 columns wide; every 5,000 events are a raster.
PIX = "pix AS (SELECT event_id // 5000 AS raster_id, CAST(event_id % 5000 // 100 AS INT) AS row, CAST(event_id % 100 AS INT) AS col, value, event_type FROM events)"
AFFINE = (1.0, 0.0, 0.0, 0.0, -1.0, 100.0)


def pixels(t):
    return t.events.select(F.floor(F.col("event_id") / 5000).alias("raster_id"), F.floor(F.col("event_id") % 5000 / 100).cast("int").alias("row"),
                           (F.col("event_id") % 100).cast("int").alias("col"), "value", "event_type")


@query("a18_raster_window", f"WITH {PIX} SELECT raster_id, CAST(row - 10 AS INT) AS row, CAST(col - 20 AS INT) AS col, value, CAST(col AS DOUBLE) AS x, CAST(100 - row AS DOUBLE) AS y FROM pix WHERE row BETWEEN 10 AND 41 AND col BETWEEN 20 AND 51")
def _(t):
    return sp.raster_window(pixels(t), AFFINE, 10, 20, 32, 32).select("raster_id", "row", "col", "value", "x", "y")


@query("m1_raster_bounds", f"WITH {PIX} SELECT raster_id, MAX(row) + 1 AS height, MAX(col) + 1 AS width, 0.0::DOUBLE AS left, 100.0::DOUBLE - (MAX(row) + 1) AS bottom, (MAX(col) + 1)::DOUBLE AS right, 100.0::DOUBLE AS top FROM pix GROUP BY raster_id")
def _(t):
    return sp.raster_bounds(pixels(t), AFFINE)


@query("m2_scale_by_max", f"WITH {PIX} SELECT raster_id, row, col, ROUND(value / greatest(MAX(value) OVER (PARTITION BY raster_id), 1), 9) AS scaled FROM pix")
def _(t):
    return sp.scale_by_max(pixels(t), "value").select("raster_id", "row", "col", F.round("scaled", 9).alias("scaled"))


# Shapes: each box is a building (class 2) of its nation; a strip per region is a road (class 1).
SHAPES = f"""{BOXES}, shapes AS (SELECT 2 AS class, 100 + poly_id AS shape_id, poly_id AS ord, x0, y0, x1, y1 FROM boxes
UNION ALL SELECT 1, 1 + r_regionkey, 1000 + r_regionkey, 0, 20.0 * r_regionkey + 10, 100, 20.0 * r_regionkey + 12 FROM region)"""
BURN = f"""burn AS (SELECT raster_id, row, col, COALESCE(MAX(class), 0) AS class, COALESCE(arg_max(shape_id, ord) FILTER (WHERE class = 2), 0) AS instance FROM pix LEFT JOIN shapes ON col + 0.5 > x0 AND col + 0.5 < x1 AND 99.5 - row > y0 AND 99.5 - row < y1 GROUP BY raster_id, row, col)"""


def shapes(t):
    x, y = corner()
    buildings = t.nation.select(F.lit(2).alias("class"), (100 + F.col("n_nationkey")).alias("shape_id"), F.col("n_nationkey").alias("ord"), sp.box(x + 2, y + 2, x + 16, y + 16).alias("ring"))
    ry = 20.0 * F.col("r_regionkey")
    strips = t.region.select(F.lit(1).alias("class"), (1 + F.col("r_regionkey")).alias("shape_id"), (1000 + F.col("r_regionkey")).alias("ord"), sp.box(F.lit(0.0), ry + 10, F.lit(100.0), ry + 12).alias("ring"))
    return buildings.unionByName(strips)


def burned(t):
    return sp.rasterize(pixels(t), shapes(t), "ring", AFFINE, 10.0, "class", "shape_id", "ord", 2)


@query("m8_rasterize", f"WITH {PIX}, {SHAPES}, {BURN} SELECT raster_id, row, col, class, instance FROM burn")
def _(t):
    return burned(t).select("raster_id", "row", "col", "class", "instance")


def components_sql(rounds: int = 40) -> str:
    """Label propagation with pointer jumps, unrolled; far more rounds than a raster this size needs."""
    parts = [f"WITH {PIX}, m AS MATERIALIZED (SELECT raster_id AS k, row AS r, col AS c, raster_id * 5000 + row * 100 + col AS id FROM pix WHERE event_type IN ('click', 'purchase'))",
             "nb AS MATERIALIZED (SELECT a.id AS src, b.id AS dst FROM m a JOIN m b ON b.k = a.k AND b.r = a.r AND b.c = a.c + 1 UNION ALL SELECT b.id, a.id FROM m a JOIN m b ON b.k = a.k AND b.r = a.r AND b.c = a.c + 1 "
             "UNION ALL SELECT a.id, b.id FROM m a JOIN m b ON b.k = a.k AND b.r = a.r + 1 AND b.c = a.c UNION ALL SELECT b.id, a.id FROM m a JOIN m b ON b.k = a.k AND b.r = a.r + 1 AND b.c = a.c)",
             "l0 AS MATERIALIZED (SELECT id, id AS lab FROM m)"]
    for i in range(rounds):
        parts.append(f"h{i} AS MATERIALIZED (SELECT l.id, LEAST(l.lab, COALESCE(MIN(x.lab), l.lab)) AS lab FROM l{i} l LEFT JOIN nb ON nb.src = l.id LEFT JOIN l{i} x ON x.id = nb.dst GROUP BY l.id, l.lab)")
        parts.append(f"l{i + 1} AS MATERIALIZED (SELECT a.id, LEAST(a.lab, b.lab) AS lab FROM h{i} a JOIN h{i} b ON b.id = a.lab)")
    return ", ".join(parts) + f" SELECT id // 5000 AS raster_id, CAST(id % 5000 // 100 AS INT) AS row, CAST(id % 100 AS INT) AS col, dense_rank() OVER (PARTITION BY id // 5000 ORDER BY lab) AS instance FROM l{rounds}"


@query("m9_components", components_sql())
def _(t):
    labelled = sp.components(pixels(t), F.col("event_type").isin("click", "purchase"))
    return sp.instances(labelled)


@query("m10_panoptic", f"WITH {PIX}, {SHAPES}, {BURN} SELECT raster_id, row, col, CAST(CASE class WHEN 2 THEN 2000 + instance WHEN 1 THEN 1000 ELSE 0 END AS INT) AS panoptic FROM burn")
def _(t):
    return burned(t).select("raster_id", "row", "col", sp.panoptic(F.col("class"), F.col("instance")).alias("panoptic"))


@query("m11_segmentation_scores", f"WITH {PIX}, {SHAPES}, {BURN}, p AS (SELECT class AS t, CASE WHEN {sql_hash48('seg', 'raster_id', 'row', 'col')} % 10 = 0 THEN (class + 1) % 3 ELSE class END AS p FROM burn) " + " UNION ALL ".join(
    f"SELECT CAST({c} AS INT) AS class, ROUND(COUNT(*) FILTER (WHERE t = {c} AND p = {c}) / COUNT(*) FILTER (WHERE t = {c} OR p = {c}), 9) AS iou, ROUND(AVG((t = p)::INT), 9) AS accuracy FROM p" for c in (0, 1, 2)))
def _(t):
    wrong = hash48("seg", "raster_id", "row", "col") % 10 == 0
    rows = burned(t).withColumn("predicted", F.when(wrong, (F.col("class") + 1) % 3).otherwise(F.col("class")))
    out = sp.segmentation_scores(rows, "class", "predicted", [0, 1, 2])
    return out.withColumns({"iou": F.round("iou", 9), "accuracy": F.round("accuracy", 9)})
