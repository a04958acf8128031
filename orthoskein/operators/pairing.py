"""Joins that choose image pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import EARTH_RADIUS_M, local_xy, usable_fix


def proximity_pairs(nodes: DataFrame, radius_m: float = 40.0) -> DataFrame:
    """(src, dst) with src < dst closer than ``radius_m``, measured from src.

    A theta join would compare all nodes with all; instead each node looks into
    the nine cells around its own. Rows of cells are ``radius_m`` high, and a
    cell's width follows the row's parallel nearest the pole, so that neighbours
    never lie further than one cell away; rows next to each other have different
    widths, hence a node looks up its own longitude range in each of three rows.
    """
    usable = nodes.where(usable_fix(F.col("lat"), F.col("lon"))).select("image_id", "lat", "lon")
    height = F.degrees(F.lit(radius_m / EARTH_RADIUS_M))

    def width(row):
        edge = F.least(F.greatest(F.abs(row * height), F.abs((row + 1) * height)) + height, F.lit(89.999999))
        return height / F.cos(F.radians(edge))

    row = F.floor(F.col("lat") / height)
    right = usable.withColumn("row", row).withColumn("cell", F.floor(F.col("lon") / width(F.col("row"))))
    left = usable.withColumn("row", F.explode(F.array(row - 1, row, row + 1)))
    reach = width(F.col("row"))
    left = left.withColumn("cell", F.explode(F.sequence(F.floor((F.col("lon") - reach) / reach), F.floor((F.col("lon") + reach) / reach))))
    a = left.select(F.col("image_id").alias("src"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"), "row", "cell")
    b = right.select(F.col("image_id").alias("dst"), F.col("lat").alias("lat_b"), F.col("lon").alias("lon_b"), "row", "cell")
    east, north = local_xy(F.col("lat_b"), F.col("lon_b"), F.col("lat_a"), F.col("lon_a"))
    near = (F.col("src") < F.col("dst")) & (F.hypot(east, north) < radius_m)
    return a.join(b, ["row", "cell"]).where(near).select("src", "dst")


def sequential_pairs(nodes: DataFrame, key: str = "image_id", by: list[str] | None = None) -> DataFrame:
    """Each key with its successor in order, within ``by``."""
    order = Window.partitionBy(*(by or [])).orderBy(key)
    return nodes.select(*(by or []), F.col(key).alias("src"), F.lead(key).over(order).alias("dst")).where("dst is not null")


def numbered_edges(edges: DataFrame) -> DataFrame:
    """(edge_ord, src, dst): edges in the order of src and dst, from 0.

    Ranks within a source, plus the number of edges of lesser sources; only the
    sources' counts are summed in one task.
    """
    within = edges.select("src", "dst", F.row_number().over(Window.partitionBy("src").orderBy("dst")).alias("place"))
    counts = edges.groupBy("src").agg(F.count("*").alias("c"))
    before = counts.select("src", (F.sum("c").over(Window.orderBy("src")) - F.col("c")).alias("before"))
    return within.join(before, "src").select((F.col("before") + F.col("place") - 1).alias("edge_ord"), "src", "dst")


def all_pairs(nodes: DataFrame) -> DataFrame:
    """Every pair of a bounded set of nodes, src < dst. The result is quadratic by definition."""
    a, b = nodes.select(F.col("image_id").alias("src")), nodes.select(F.col("image_id").alias("dst"))
    return a.join(b, F.col("src") < F.col("dst"))


def box_overlap_pairs(boxes: DataFrame, cell: float) -> DataFrame:
    """(src, dst) of boxes (id, x0, y0, x1, y1) that overlap or touch.

    Boxes meet in the tiles they cover; a pair is kept in the tile that holds
    the least corner of its intersection, so that no distinct is needed.
    """

    def tiles(lo: str, hi: str):
        return F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))

    tiled = boxes.withColumn("tx", F.explode(tiles("x0", "x1"))).withColumn("ty", F.explode(tiles("y0", "y1")))
    a = tiled.select("tx", "ty", *[F.col(c).alias(f"a_{c}") for c in ("id", "x0", "y0", "x1", "y1")])
    b = tiled.select("tx", "ty", *[F.col(c).alias(f"b_{c}") for c in ("id", "x0", "y0", "x1", "y1")])
    meet = (F.col("a_x0") <= F.col("b_x1")) & (F.col("b_x0") <= F.col("a_x1")) & (F.col("a_y0") <= F.col("b_y1")) & (F.col("b_y0") <= F.col("a_y1"))
    corner = (F.floor(F.greatest("a_x0", "b_x0") / cell) == F.col("tx")) & (F.floor(F.greatest("a_y0", "b_y0") / cell) == F.col("ty"))
    return a.join(b, ["tx", "ty"]).where((F.col("a_id") < F.col("b_id")) & meet & corner).select(F.col("a_id").alias("src"), F.col("b_id").alias("dst"))
