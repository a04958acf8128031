"""Quality metrics of pairs, loops and runs. What cannot be computed is NULL here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import central_jacobian, inverse, matrix, multiply, named, normalise, project, singular_ratio_log

#: Points that a loop's composed transform is measured on.
LOOP_POINTS = ((0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0), (50.0, 50.0))
GRID = 10


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def inlier_stats(matches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Inlier count and ratio of sums, over everything or per ``by``."""
    aggs = [F.count_if("is_inlier").alias("inlier_count"), F.count("*").alias("match_count")]
    out = matches.groupBy(*(by or [])).agg(*aggs)
    return out.withColumn("inlier_ratio", ratio(F.col("inlier_count"), F.col("match_count")))


def reprojection_rmse(matches: DataFrame, edges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Root mean square over all inliers pooled; points that do not project are left out."""
    x, y = project(matrix(), F.col("sx"), F.col("sy"))
    joined = matches.where("is_inlier").join(edges, ["src", "dst"])
    error = (x - F.col("dx")) ** 2 + (y - F.col("dy")) ** 2
    return joined.groupBy(*(by or [])).agg(F.sqrt(F.avg(error)).alias("reprojection_error_px"))


def pair_metrics(matches: DataFrame, edges: DataFrame) -> DataFrame:
    return inlier_stats(matches, ["src", "dst"]).join(reprojection_rmse(matches, edges, ["src", "dst"]), ["src", "dst"], "left")


def median_inliers(counts: DataFrame, column: str) -> DataFrame:
    return counts.agg(F.median(column).alias("median_inliers"))


def distortion(poses: DataFrame) -> DataFrame:
    """Mean |ln(s1/s2)| of the local scale over a 10 x 10 grid of every image with its transform.

    The local scale is a central difference with a step of 1 % of the image's
    short side, one pixel at least. ``poses`` has image_id, rows, cols and h00..h22.
    """
    steps = F.sequence(F.lit(0), F.lit(GRID - 1))
    grid = poses.where("rows > 1 and cols > 1").withColumn("gx", F.explode(steps)).withColumn("gy", F.explode(steps))
    x = F.col("gx") * (F.col("cols") - 1) / float(GRID - 1)
    y = F.col("gy") * (F.col("rows") - 1) / float(GRID - 1)
    step = F.greatest(F.lit(1.0), F.least("rows", "cols") * F.lit(0.01))
    local = grid.select(*[c.alias(f"j{k}") for k, c in enumerate(central_jacobian(normalise(matrix()), x, y, step))])
    return local.agg(F.avg(singular_ratio_log(*[F.col(f"j{k}") for k in range(4)])).alias("distortion"))


def undirected(edges: DataFrame) -> DataFrame:
    """Edges in both directions; a direct edge wins over the inverse of its counterpart."""
    direct = edges.select("src", "dst", F.lit(0).alias("turned"), *named(normalise(matrix())))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(1).alias("turned"), *named(normalise(inverse(normalise(matrix())))))
    cells = [f"h{i}{j}" for i in range(3) for j in range(3)]
    best = direct.unionByName(back).groupBy("src", "dst").agg(F.min(F.struct("turned", *cells)).alias("e"))
    return best.select("src", "dst", "e.*").drop("turned")


def cycle_error(loops: DataFrame, edges: DataFrame) -> DataFrame:
    """Mean over loops of the RMSE of the composed transform; a missing edge drops its loop.

    A point that does not project is left out of its loop's mean. ``loops`` has loop_id, step, image_id with the first image repeated at the end.
    """
    order = Window.partitionBy("loop_id").orderBy("step")
    steps = loops.select("loop_id", "step", F.col("image_id").alias("src"), F.lead("image_id").over(order).alias("dst")).where("dst is not null")
    both = undirected(edges)
    cells = [f"h{i}{j}" for i in range(3) for j in range(3)]
    found = steps.join(both, ["src", "dst"], "left").groupBy("loop_id").agg(
        F.count("*").alias("n"), F.count("h00").alias("known"), F.array_sort(F.collect_list(F.struct("step", F.array(*cells).alias("m")))).alias("path")
    )
    eye = F.array(*[F.lit(1.0 if i in (0, 4, 8) else 0.0) for i in range(9)])

    def times(acc: Column, e: Column) -> Column:
        return F.array(*multiply([F.get(e["m"], i) for i in range(9)], [F.get(acc, i) for i in range(9)]))

    whole = found.where("n >= 1 and n = known").withColumn("m", F.aggregate("path", eye, times))
    m = [F.get("m", i) for i in range(9)]
    errors = []
    for px, py in LOOP_POINTS:
        x, y = project(m, F.lit(px), F.lit(py))
        errors.append((x - px) ** 2 + (y - py) ** 2)
    total = reduce(lambda a, b: a + b, [F.coalesce(e, F.lit(0.0)) for e in errors])
    per_loop = F.sqrt(F.try_divide(total, reduce(lambda a, b: a + b, [e.isNotNull().cast("int") for e in errors])))
    return whole.agg(F.avg(per_loop).alias("cycle_loop_error_px"))


def run_status(total: Column, ok: Column) -> Column:
    """success if all are placed, partial_success if two or more of several are, else failed."""
    return F.when((ok == total) & (total > 0), "success").when((total > 1) & (ok >= 2), "partial_success").otherwise("failed")
