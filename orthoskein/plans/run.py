"""The whole run: images, a matcher and a configuration give a mosaic and one row of metrics."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import matrix
from ..operators import matching, pairing, raster, report, sets
from ..scratch import stash
from . import estimate

log = logging.getLogger(__name__)
TRANSFORM = [f"t{i}{j}" for i in range(3) for j in range(3)]
NO_TRANSFORM = "image_id long, rows int, cols int, " + ", ".join(f"{c} double" for c in TRANSFORM)


@dataclass
class RunConfig:
    """Nothing is required. Tables: ``latlons`` (image_id, lat, lon), ``capture_times`` (image_id, t),
    ``gimbal_yaw`` (image_id, yaw_deg), ``pairs`` (src, dst), ``loops`` (loop_id, step, image_id)."""

    ransac_threshold: float = matching.THRESHOLD_PX
    latlons: DataFrame | None = None
    capture_times: DataFrame | None = None
    anchors: str = "gps"
    gimbal_yaw: DataFrame | None = None
    pairs: DataFrame | None = None
    loops: DataFrame | None = None


@dataclass
class Run:
    """``tiles`` (ty, tx, rgb) of the mosaic of ``height`` by ``width`` pixels, empty if no image succeeded."""

    tiles: DataFrame
    height: int
    width: int
    metrics: DataFrame
    estimate: estimate.PoseEstimate | None = None


class Unmatched:
    """A matcher that finds nothing."""

    name = "unmatched"

    def match(self, image_a, image_b) -> matching.MatchResult:
        return matching.MatchResult(np.zeros((0, 2)), np.zeros((0, 2)))


def default_pairs(images: DataFrame, config: RunConfig) -> DataFrame:
    """The given pairs; else all closer than 40 m where there are positions, else neighbours in order."""
    if config.pairs is not None:
        return config.pairs
    if config.latlons is not None and not config.latlons.isEmpty():
        return pairing.proximity_pairs(sets.present(config.latlons, images.select("image_id")))
    return pairing.sequential_pairs(images.select("image_id"))


def log_estimate(found: estimate.PoseEstimate) -> None:
    """Why images got no pose is told here; the metrics row has no column for it."""
    if found.reason is not None:
        log.warning("pose estimation: %s", found.reason)
    if found.node_reasons is not None:
        counts = {r.reason: r["count"] for r in found.node_reasons.groupBy("reason").count().orderBy("reason").collect()}
        if counts:
            log.warning("images without a pose: %s", counts)
    if found.lag is not None and found.lag.status != "estimated":
        log.warning("recording lag not corrected: %s", " ".join(x for x in (found.lag.status, found.lag.reason) if x))
    elif found.lag is not None:
        log.info("recording lag corrected: %.2f m after %d rounds", found.lag.lag_m, found.lag.rounds)
    if found.checks is not None:
        counts = {r.reason: r["count"] for r in found.checks.where("reason is not null").groupBy("reason").count().orderBy("reason").collect()}
        if counts:
            log.warning("edges rejected: %s", counts)
    if found.refinement is not None and found.refinement.held:
        log.warning("centres held at their bounds: %s", sorted(found.refinement.held))


def _identity(images: DataFrame) -> DataFrame:
    cells = [F.lit(1.0 if k in (0, 4, 8) else 0.0).alias(c) for k, c in enumerate(TRANSFORM)]
    return images.select("image_id", "rows", "cols", *cells)


def run_pipeline(images: DataFrame, matcher: matching.Matcher, config: RunConfig | None = None) -> Run:
    """Match, estimate poses, warp, blend and measure images(image_id, rows, cols, rgb).

    An image succeeds if it has a finite pose and puts at least one pixel on the
    canvas. A single image is taken as it is. Without images, without positions
    or without a converged estimate the run is ``failed`` and the mosaic empty;
    a pair that cannot be matched is left out. Only wrong arguments raise.
    """
    config, began = config or RunConfig(), time.perf_counter()
    estimate.validate_anchors(config.anchors, config.gimbal_yaw)
    spark = images.sparkSession
    total = images.count()
    edges = spark.createDataFrame([], matching.EDGE_SCHEMA)
    matches = spark.createDataFrame([], "src long, dst long, k long, sx double, sy double, dx double, dy double, is_inlier boolean")
    poses, found = spark.createDataFrame([], NO_TRANSFORM), None
    if total == 1:
        poses = _identity(images)
    elif total > 1:
        matched = stash(matching.match_images(images, default_pairs(images, config), matcher, config.ransac_threshold), "run-matches").where("error is null")
        edges = matched.drop("matches", "error")
        matches = matched.select("src", "dst", F.inline("matches"))
        nodes = images.select("image_id", "rows", "cols")
        none = lambda c: F.lit(None).cast("double").alias(c)
        nodes = nodes.join(config.latlons.select("image_id", "lat", "lon"), "image_id", "left") if config.latlons is not None else nodes.select("*", none("lat"), none("lon"))
        nodes = nodes.join(config.capture_times.select("image_id", "t"), "image_id", "left") if config.capture_times is not None else nodes.select("*", none("t"))
        slim = edges.select("src", "dst", *matrix())
        found = estimate.estimate_global_poses(nodes, slim, matches, anchors=config.anchors, gimbal_yaw=config.gimbal_yaw)
        log_estimate(found)
        if found.status == "converged":
            sized = found.poses.join(nodes.select("image_id", "rows", "cols"), "image_id")
            poses = stash(raster.finite(sized.select("image_id", "rows", "cols", *TRANSFORM)), "run-poses")

    tiles, mosaic, box, seam = None, spark.createDataFrame([], "ty int, tx int, rgb binary"), None, None
    if total and not poses.isEmpty():
        renamed = images.select("image_id", F.col("rows").alias("height"), F.col("cols").alias("width"), "rgb")
        tiles = stash(raster.warp_tiles(renamed, poses), "run-tiles")
    placed = tiles.select("image_id").distinct() if tiles is not None else images.select("image_id").limit(0)
    if tiles is not None and not tiles.isEmpty():
        box = raster.canvas(poses).first()
        mosaic, seam = stash(raster.blend(tiles), "run-mosaic"), raster.seam_error(tiles)
    process = report.process_row(images, placed, time.perf_counter() - began)
    row = report.evaluate_metrics(process, matches, edges, poses, matcher.name, config.loops, seam)
    return Run(mosaic, int(box.height) if box else 0, int(box.width) if box else 0, row, found)
