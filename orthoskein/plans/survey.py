"""A survey derived from ``customer``: nodes in capture order, edges with homographies, matches.

Equal-altitude nadir images along a serpentine: five images a line, 13.4 m
apart on a course of 77 degrees, lines 27 m apart. Everything follows from the
customer key by closed formulas.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import EARTH_RADIUS_M, matrix, multiply, named, project
from ..operators import headings, segments
from ..operators.pairing import proximity_pairs

#: The invented camera and its place.
ROWS, COLS, PPM = 3000, 4000, 30.25
LAT0, LON0 = 41.25, 2.125
COURSE = math.radians(77.0)
YAW_EVEN, YAW_ODD = 64.5, -115.5


def nodes(spark: SparkSession, sf_dir: str, table: str = "customer", key: str = "c_custkey") -> DataFrame:
    """image_id, rows, cols, lat, lon, t, yaw and true metres e, nn; an image for each row of ``table``."""
    s = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(F.col(key).alias("image_id"))
    line, place = F.floor(F.col("image_id") / 5), F.col("image_id") % 5
    step = F.when(line % 2 == 0, place).otherwise(4 - place) * 13.4
    side = line * 27.0
    east = step * math.sin(COURSE) - side * math.cos(COURSE)
    north = step * math.cos(COURSE) + side * math.sin(COURSE)
    return s.select(
        "image_id",
        F.lit(ROWS).alias("rows"),
        F.lit(COLS).alias("cols"),
        (LAT0 + F.degrees(north / EARTH_RADIUS_M)).alias("lat"),
        (LON0 + F.degrees(east / (EARTH_RADIUS_M * math.cos(math.radians(LAT0))))).alias("lon"),
        (1000.0 + 2.5 * F.col("image_id") + 60.0 * line).alias("t"),
        F.when(line % 2 == 0, YAW_EVEN).otherwise(YAW_ODD).alias("yaw"),
        east.alias("e"),
        north.alias("nn"),
    )


def edges(survey: DataFrame, false_edges: bool = False) -> DataFrame:
    """src, dst and the homography of every pair under 40 m, in source pixels.

    With ``false_edges``, some are turned by 30 degrees, scaled by 1.3, mirrored
    or sheared by 20 degrees about the source's centre.
    """
    pairs = proximity_pairs(survey)
    a = survey.select(F.col("image_id").alias("src"), F.col("yaw").alias("ya"), F.col("e").alias("ea"), F.col("nn").alias("na"))
    b = survey.select(F.col("image_id").alias("dst"), F.col("yaw").alias("yb"), F.col("e").alias("eb"), F.col("nn").alias("nb"))
    j = pairs.join(a, "src").join(b, "dst")
    cx, cy = COLS / 2.0, ROWS / 2.0
    turn, back = F.radians(F.col("ya") - F.col("yb")), F.radians(-F.col("yb"))
    px, py = PPM * (F.col("ea") - F.col("eb")), -PPM * (F.col("na") - F.col("nb"))
    tx = cx + F.cos(back) * px - F.sin(back) * py - (F.cos(turn) * cx - F.sin(turn) * cy)
    ty = cy + F.sin(back) * px + F.cos(back) * py - (F.sin(turn) * cx + F.cos(turn) * cy)
    zero, one = F.lit(0.0), F.lit(1.0)
    h = [F.cos(turn), -F.sin(turn), tx, F.sin(turn), F.cos(turn), ty, zero, zero, one]
    out = j.select("src", "dst", *named(h))
    if not false_edges:
        return out
    case = (7 * F.col("src") + 13 * F.col("dst")) % 29
    c30, s30, shear = math.cos(math.radians(30)), math.sin(math.radians(30)), math.tan(math.radians(20))
    p = F.when(case == 0, c30).when(case == 1, 1.3).when(case == 2, -1.0).otherwise(1.0)
    q = F.when(case == 0, -s30).when(case == 3, shear).otherwise(0.0)
    r = F.when(case == 0, s30).otherwise(0.0)
    s = F.when(case == 0, c30).when(case == 1, 1.3).otherwise(1.0)
    about = [p, q, cx - p * cx - q * cy, r, s, cy - r * cx - s * cy, zero, zero, one]
    return out.select("src", "dst", *named(multiply(matrix(), about)))


def matches(links: DataFrame) -> DataFrame:
    """Nine points per edge with small deterministic errors; every seventh or so is an outlier."""
    k = F.explode(F.sequence(F.lit(0), F.lit(8)))
    rows = links.withColumn("k", k).withColumn("sx", 1000.0 + 700.0 * (F.col("k") % 3)).withColumn("sy", 800.0 + 500.0 * F.floor(F.col("k") / 3))
    x, y = project(matrix(), F.col("sx"), F.col("sy"))
    wobble = 0.8 * (((7 * F.col("src") + 11 * F.col("dst") + 5 * F.col("k")) % 13) / 13.0 - 0.5)
    far = (F.col("src") + F.col("dst") + F.col("k")) % 7 == 0
    return rows.select("src", "dst", "k", "sx", "sy", (x + wobble + F.when(far, 80.0).otherwise(0.0)).alias("dx"), (y - wobble).alias("dy"), (~far).alias("is_inlier"))


def loops(links: DataFrame) -> DataFrame:
    """Closed triangles a < b < c of edges: loop_id, step, image_id."""
    ab = links.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    bc = links.select(F.col("src").alias("b"), F.col("dst").alias("c"))
    ac = links.select(F.col("src").alias("a"), F.col("dst").alias("c"))
    tri = ab.join(bc, "b").join(ac, ["a", "c"])
    path = F.posexplode(F.array("a", "b", "c", "a")).alias("step", "image_id")
    return tri.select(F.concat_ws("-", "a", "b", "c").alias("loop_id"), path)




def poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The true pose of every image in a frame of pixels, north up: image_id, rows, cols, t00..t22."""
    n = nodes(spark, sf_dir)
    c, s = F.cos(F.radians("yaw")), F.sin(F.radians("yaw"))
    cx, cy = COLS / 2.0, ROWS / 2.0
    cells = [c, -s, PPM * F.col("e") - (c * cx - s * cy), s, c, -PPM * F.col("nn") - (s * cx + c * cy), F.lit(0.0), F.lit(0.0), F.lit(1.0)]
    return n.select("image_id", "rows", "cols", *[v.alias(f"t{k // 3}{k % 3}") for k, v in enumerate(cells)])


def lag_observations(spark: SparkSession, sf_dir: str, lag_m: float) -> DataFrame:
    """Both ends' observations of every edge, of a survey recorded ``lag_m`` late along its track."""
    true = segments.travel_directions(segments.segments(nodes(spark, sf_dir), [], "t", "image_id"), [])
    late = segments.shift_by_lag(true, F.lit(-lag_m))
    links = headings.edge_geometry(edges(true), late).select("src", "dst", "east", "north", "bx", "by", "fx", "fy")
    way = lambda to, name: late.where("ux is not null").select(F.col("image_id").alias(to), F.col("ux").alias(f"ux_{name}"), F.col("uy").alias(f"uy_{name}"))
    ends = F.inline(
        F.array(
            F.struct(F.col("src").alias("node"), F.lit(1.0).alias("side"), F.atan2("by", "bx").alias("alpha")),
            F.struct(F.col("dst").alias("node"), F.lit(-1.0).alias("side"), F.atan2("fy", "fx").alias("alpha")),
        )
    )
    both = links.join(way("src", "a"), "src").join(way("dst", "b"), "dst")
    return both.select("src", "dst", "east", "north", "ux_a", "uy_a", "ux_b", "uy_b", ends).withColumn("sigma", F.lit(headings.SIGMA_RAD))
