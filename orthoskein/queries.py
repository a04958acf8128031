"""Registered queries over the survey operators, with their SQL counterparts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.geometry import matrix, project, wrap, yaw_from
from .functions.geometry import pixels_per_metre as pinhole_scale
from .operators import headings, lag, matching, metrics, pairing, posegraph, raster, refine, report, rotation, segments, sets
from .operators.components import components
from .plans import estimate, photos, run, survey
from .sources import exif, metadata
from .streaming import sessions


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pair"), (F.col("l_returnflag") != "R").alias("is_inlier"))


def inlier_stats_by_pair(spark, sf_dir):
    out = metrics.inlier_stats(_lines(spark, sf_dir), ["pair"])
    return out.withColumn("inlier_ratio", F.round("inlier_ratio", 9))


def inlier_stats_global(spark, sf_dir):
    out = metrics.inlier_stats(_lines(spark, sf_dir))
    return out.withColumn("inlier_ratio", F.round("inlier_ratio", 9))


def inlier_median_reference(spark, sf_dir):
    return metrics.median_inliers(metrics.inlier_stats(_lines(spark, sf_dir), ["pair"]), "inlier_count")


def proximity_pairs(spark, sf_dir):
    return pairing.proximity_pairs(survey.nodes(spark, sf_dir))


def sequential_pairs(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return pairing.sequential_pairs(orders, "o_orderkey", ["o_custkey"])


def all_pairs(spark, sf_dir):
    return pairing.all_pairs(_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("image_id")))


def bbox_overlap_pairs(spark, sf_dir):
    e = F.col("embedding")
    lo = lambda a, b: F.least(F.get(e, a), F.get(e, b)).cast("double")
    hi = lambda a, b: F.greatest(F.get(e, a), F.get(e, b)).cast("double")
    boxes = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), lo(0, 1).alias("x0"), lo(2, 3).alias("y0"), hi(0, 1).alias("x1"), hi(2, 3).alias("y1"))
    return pairing.box_overlap_pairs(boxes, 0.1)


def reprojection_rmse(spark, sf_dir):
    links = survey.edges(survey.nodes(spark, sf_dir))
    return metrics.reprojection_rmse(survey.matches(links), links).select(F.round("reprojection_error_px", 6).alias("reprojection_error_px"))


def pair_metrics(spark, sf_dir):
    links = survey.edges(survey.nodes(spark, sf_dir))
    out = metrics.pair_metrics(survey.matches(links), links)
    return out.select("src", "dst", "match_count", "inlier_count", F.round("inlier_ratio", 9).alias("inlier_ratio"), F.round("reprojection_error_px", 6).alias("reprojection_error_px"))


def cycle_loop_error(spark, sf_dir):
    links = survey.edges(survey.nodes(spark, sf_dir), false_edges=True)
    return metrics.cycle_error(survey.loops(links), links).select(F.round("cycle_loop_error_px", 4).alias("cycle_loop_error_px"))


def distortion(spark, sf_dir):
    """Each edge's homography stands for a pose; shears and mirrors give a value above zero."""
    links = survey.edges(survey.nodes(spark, sf_dir), false_edges=True)
    poses = links.withColumn("image_id", F.col("src")).withColumn("rows", F.lit(survey.ROWS)).withColumn("cols", F.lit(survey.COLS))
    return metrics.distortion(poses).select(F.round("distortion", 9).alias("distortion"))


def flight_segments(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    return segments.segments(rows, ["user_id"], "t", "event_id").groupBy("user_id").agg((F.max("segment") + 1).alias("segments"), F.count("*").alias("events"))


def travel_directions(spark, sf_dir):
    rows = segments.segments(survey.nodes(spark, sf_dir), [], "t", "image_id")
    out = segments.travel_directions(rows, [])
    return out.select("image_id", "segment", F.round("ux", 6).alias("ux"), F.round("uy", 6).alias("uy"))


def shift_by_lag(spark, sf_dir):
    rows = segments.travel_directions(segments.segments(survey.nodes(spark, sf_dir), [], "t", "image_id"), [])
    out = segments.shift_by_lag(rows, F.lit(2.3))
    return out.select("image_id", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


def circular_mean_time_of_day(spark, sf_dir):
    seconds = F.pmod(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6, F.lit(86400.0))
    rows = _table(spark, sf_dir, "events").select("event_type", wrap(seconds * (2 * math.pi / 86400.0)).alias("h"), "value")
    mean = headings.circular_mean(F.col("h"), 1.0 + F.abs("value"))
    return rows.groupBy("event_type").agg(F.round(mean, 6).alias("mean_angle"))


def heading_observations(spark, sf_dir):
    nodes = survey.nodes(spark, sf_dir)
    out = headings.heading_observations(survey.edges(nodes), nodes)
    return out.select("src", "dst", "node", F.round("h", 6).alias("h"))


def heading_consensus(spark, sf_dir):
    nodes = survey.nodes(spark, sf_dir)
    out = headings.consensus(headings.heading_observations(survey.edges(nodes, True), nodes))
    return out.select("node", F.round("heading", 6).alias("heading"), "n_agree", "n_obs", "trusted")


def edge_consistency_reasons(spark, sf_dir):
    nodes = survey.nodes(spark, sf_dir)
    return headings.edge_consistency(survey.edges(nodes, True), nodes)


def rejection_histogram(spark, sf_dir):
    nodes = survey.nodes(spark, sf_dir)
    return headings.edge_consistency(survey.edges(nodes, True), nodes).where("reason is not null").groupBy("reason").count()


def median_px_per_metre(spark, sf_dir):
    nodes = survey.nodes(spark, sf_dir)
    g = headings.edge_geometry(survey.edges(nodes, True), nodes).where(F.col("metres") >= headings.MIN_DISPLACEMENT_M)
    return g.agg(F.round(F.median("px_per_m"), 6).alias("px_per_m"))


def densest_window(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("v"))
    out = headings.densest_window(rows, "v", ["l_returnflag"])
    return out.select("l_returnflag", F.round("mode", 6).alias("mode"), "support")


def connected_components(spark, sf_dir):
    """Components of all proximity edges of the survey; an image without edges is its own."""
    links = pairing.proximity_pairs(survey.nodes(spark, sf_dir))
    nodes = survey.nodes(spark, sf_dir).select("image_id")
    found = components(links.select(F.col("src").alias("a"), F.col("dst").alias("b")))
    return nodes.join(found, nodes.image_id == found.node, "left").select("image_id", F.coalesce("component", "image_id").alias("component"))


def attribute_map_extract(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", metadata.attributes(F.col("html")).alias("m"))
    return pages.select("page_id", F.size("m").cast("long").alias("attributes"), F.try_element_at("m", F.lit("lang")).alias("lang"), F.try_element_at("m", F.lit("href")).alias("href"))


def provenance_coalesce(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "n_chars"), _table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    first = F.when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(), F.struct(F.col("quality").cast("double").alias("x"), F.col("toxic").cast("double").alias("y"), F.lit("label").alias("origin")))
    other = F.struct(F.col("n_chars").cast("double").alias("x"), F.lit(0.0).alias("y"), F.lit("size").alias("origin"))
    return docs.join(labels, "doc_id", "left").select("doc_id", F.coalesce(first, other).alias("p")).select("doc_id", "p.*")


def run_status(spark, sf_dir):
    done = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") != "F").alias("ok"))
    return done.select("o_custkey", "total", "ok", metrics.run_status(F.col("total"), F.col("ok")).alias("status"), F.round(metrics.ratio(F.col("ok"), F.col("total")), 9).alias("success_rate"))


def exif_gps_fields(spark, sf_dir):
    """Rationals of the GPS directory, in lowest terms."""
    e = F.col("exif")
    part = lambda c, i, f: F.get(e[c], i)[f]
    cells = [part(c, i, f).alias(f"{c}{i}_{f}") for c in ("lat", "lon") for i in range(3) for f in ("num", "den")]
    return exif.read_exif(photos.files(spark, sf_dir), "image_id").select("image_id", e["has_gps"].alias("has_gps"), e["lat_ref"].alias("lat_ref"), e["lon_ref"].alias("lon_ref"), *cells)


def gps_positions(spark, sf_dir):
    """Position with absolute and relative altitude, and its source."""
    rows = metadata.read_metadata(photos.files(spark, sf_dir), "image_id")
    return rows.select("image_id", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"), "source", F.round("abs_alt_m", 6).alias("abs_alt_m"), F.round("rel_alt_m", 6).alias("rel_alt_m"))


def exif_latlons(spark, sf_dir):
    rows = metadata.exif_positions(metadata.read_metadata(photos.files(spark, sf_dir), "image_id"), "image_id")
    return rows.select("image_id", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


def capture_times(spark, sf_dir):
    rows = metadata.capture_times(metadata.read_metadata(photos.files(spark, sf_dir), "image_id"), "image_id")
    return rows.select("image_id", F.round("t", 6).alias("t"))


def gimbal_yaws(spark, sf_dir):
    """Yaw of each file that tells one, and relative to that of the least such file."""
    rows = metadata.read_metadata(photos.files(spark, sf_dir), "image_id").where("gimbal_yaw_deg is not null").select("image_id", "gimbal_yaw_deg")
    first = rows.agg(F.min(F.struct("image_id", "gimbal_yaw_deg")).alias("o")).select(F.col("o.gimbal_yaw_deg").alias("yaw0"))
    turned = yaw_from(F.col("gimbal_yaw_deg"), F.col("yaw0"))
    return rows.crossJoin(F.broadcast(first)).select("image_id", F.round("gimbal_yaw_deg", 6).alias("gimbal_yaw_deg"), F.round(turned, 6).alias("relative_deg"))


def camera_attributes(spark, sf_dir):
    rows = photos.files(spark, sf_dir).select("image_id", metadata.camera_attributes(F.col("content")).alias("m"))
    return rows.select("image_id", F.size("m").cast("long").alias("attributes"), F.try_element_at("m", F.lit("RelativeAltitude")).alias("relative"), F.try_element_at("m", F.lit("Yaw")).alias("other_yaw"))


def projected_positions(spark, sf_dir):
    """East and north metres of every image from the image of least id."""
    out = estimate.project_positions(survey.nodes(spark, sf_dir))
    return out.select("image_id", F.round("east", 6).alias("east"), F.round("north", 6).alias("north"))


def gps_placement(spark, sf_dir):
    """Frame pixels from a chosen origin; every seventh image has no position and is listed as unlocated."""
    nodes = survey.nodes(spark, sf_dir).withColumn("lat", F.when(F.col("image_id") % 7 != 3, F.col("lat")))
    placed = estimate.place_by_gps(nodes, survey.PPM, origin=1)
    inside = placed.centres.select("image_id", F.lit(True).alias("located"), F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))
    nowhere = placed.unlocated.select("image_id", F.lit(False).alias("located"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    return inside.unionByName(nowhere)


def pixels_per_metre(spark, sf_dir):
    """From altitude and diagonal field of view, for flights at several heights."""
    rows = survey.nodes(spark, sf_dir).withColumn("altitude", 60.0 + 10.0 * (F.col("image_id") % 9))
    scale = pinhole_scale(F.hypot("rows", "cols"), F.col("altitude"), F.lit(77.0))
    return rows.groupBy("altitude").agg(F.round(F.max(scale), 9).alias("px_per_m"), F.count("*").alias("images"))


def usable_edges(spark, sf_dir):
    """Edges of four inliers or more with a finite homography that can be inverted."""
    links = survey.edges(survey.nodes(spark, sf_dir))
    counts = survey.matches(links).groupBy("src", "dst").agg(F.count_if(F.col("is_inlier") & ((F.col("src") + F.col("k")) % 3 > 0)).alias("inlier_count"))
    case = (F.col("src") * 5 + F.col("dst")) % 17
    broken = links.withColumn("h02", F.when(case == 0, F.lit(float("nan"))).when(case == 1, F.lit(float("inf"))).otherwise(F.col("h02")))
    flat = F.col("h11") * 0.0
    broken = broken.withColumn("h10", F.when(case == 2, flat).otherwise(F.col("h10"))).withColumn("h11", F.when(case == 2, flat).otherwise(F.col("h11")))
    return estimate.usable_edges(broken, counts).select("src", "dst", "inlier_count")


def edge_weights(spark, sf_dir):
    """Inliers of each edge over their median."""
    links = survey.edges(survey.nodes(spark, sf_dir))
    counts = metrics.inlier_stats(survey.matches(links), ["src", "dst"])
    middle = metrics.median_inliers(counts, "inlier_count")
    return counts.crossJoin(F.broadcast(middle)).select("src", "dst", F.round(F.col("inlier_count") / F.col("median_inliers"), 9).alias("weight"))


def heading_anchors(spark, sf_dir):
    """Robust circular mean of each image's headings, some of them off by 30 degrees."""
    nodes = survey.nodes(spark, sf_dir)
    seen = headings.heading_observations(survey.edges(nodes, True), nodes).withColumn("weight", 1.0 + F.col("src") % 3)
    return headings.heading_anchors(seen).select("node", F.round("heading", 6).alias("heading"))


def plain_heading_anchors(spark, sf_dir):
    nodes = survey.nodes(spark, sf_dir)
    seen = headings.heading_observations(survey.edges(nodes, True), nodes).withColumn("weight", 1.0 + F.col("src") % 3)
    return headings.heading_anchors(seen, robust=False).select("node", F.round("heading", 6).alias("heading"))


def component_offsets(spark, sf_dir):
    """Turn of each line of flight that brings its own angles to the headings seen."""
    nodes = survey.nodes(spark, sf_dir)
    angles = nodes.select(F.col("image_id").alias("node"), (F.radians("yaw") - 0.001 * (F.col("image_id") % 5)).alias("angle"), F.floor(F.col("image_id") / 5).alias("component"))
    seen = headings.heading_observations(survey.edges(nodes), nodes).withColumn("weight", 1.0 + F.col("src") % 3)
    return rotation.component_offsets(angles, seen).select("component", F.round("offset", 6).alias("offset"))


def aligned_poses(spark, sf_dir):
    """Rigid pose of each image from its angle, its offset and its centre in the frame."""
    nodes = survey.nodes(spark, sf_dir)
    angles = nodes.select(F.col("image_id").alias("node"), F.lit(0.0).alias("angle"), F.floor(F.col("image_id") / 5).alias("component"))
    seen = nodes.select(F.col("image_id").alias("node"), F.radians("yaw").alias("h"), F.lit(1.0).alias("weight"))
    out = rotation.poses(rotation.align_components(angles, seen), estimate.place(nodes, survey.PPM))
    return out.select("image_id", *[F.round(c, 4).alias(c) for c in ("t00", "t01", "t02", "t10", "t11", "t12")])


def numbered_components(spark, sf_dir):
    """Flights as components numbered in the order of their least images."""
    rows = survey.nodes(spark, sf_dir).select(F.col("image_id").alias("node"), (1000 - F.floor(F.col("image_id") / 20)).alias("component"))
    return rotation.numbered(rows)


def failure_reasons(spark, sf_dir):
    """Why images have no pose, where edges, positions, accepted edges and alignments are missing by turns."""
    nodes = survey.nodes(spark, sf_dir).select("image_id")
    but = lambda n, r: nodes.where(F.col("image_id") % n != r)
    return report.failure_reasons(nodes, but(5, 1), but(7, 2), but(3, 0), nodes.where("image_id % 2 = 0 and image_id % 5 <> 1 and image_id % 7 <> 2 and image_id % 3 <> 0"), nodes.where("image_id % 11 < 4"))


def canvas_size(spark, sf_dir):
    """Origin and size of the canvas that holds every image of the survey in its true pose."""
    return raster.canvas(survey.poses(spark, sf_dir)).select(F.round("x0", 4).alias("x0"), F.round("y0", 4).alias("y0"), "height", "width")


def canvas_boxes(spark, sf_dir):
    box = raster.corners(survey.poses(spark, sf_dir))
    return box.select("image_id", *[F.round(c, 4).alias(c) for c in ("x0", "y0", "x1", "y1")])


def overlapping_footprints(spark, sf_dir):
    """Pairs of images whose boxes on the canvas overlap."""
    box = raster.corners(survey.poses(spark, sf_dir)).withColumnRenamed("image_id", "id")
    return pairing.box_overlap_pairs(box, 8000.0)


def finite_transforms(spark, sf_dir):
    case = F.col("image_id") % 9
    poses = survey.poses(spark, sf_dir).withColumn("t02", F.when(case == 1, F.lit(float("nan"))).when(case == 2, F.lit(float("-inf"))).when(case == 3, F.lit(None)).otherwise(F.col("t02")))
    return raster.finite(poses).select("image_id")


def summary_metrics(spark, sf_dir):
    """The metrics row of the survey; every fourth image failed."""
    nodes = survey.nodes(spark, sf_dir)
    links = survey.edges(nodes)
    process = report.process_row(nodes, nodes.where("image_id % 4 <> 0"), 60.0)
    row = report.evaluate_metrics(process, survey.matches(links), links, survey.poses(spark, sf_dir), "closed form")
    whole = ("pipeline_status", "input_image_count", "successful_image_count", "failed_image_count", "inlier_count", "method")
    parts = [F.round(c, 6).alias(c) for c in ("stitch_success_rate", "avg_processing_time_per_image_sec", "reprojection_error_px", "inlier_ratio", "distortion")]
    return row.select(*whole, *parts, F.size("failed_image_indices").cast("long").alias("failed"), F.isnan("seam_error").alias("no_seam"))


def lag_objective(spark, sf_dir):
    """The robust objective at the 401 lags of the grid, over the observations of all images, recorded 2.3 m late."""
    out = lag.grid_objective(survey.lag_observations(spark, sf_dir, 2.3))
    return out.select("step", F.round("objective", 2).alias("objective"))


def huber_losses(spark, sf_dir):
    """Sum of Huber losses of standardised discounts by line status."""
    z = (F.col("l_discount") - 0.05) / 0.02
    rows = _table(spark, sf_dir, "lineitem").select("l_linestatus", lag.huber(z).alias("loss"))
    return rows.groupBy("l_linestatus").agg(F.round(F.sum("loss"), 4).alias("loss"))


def edge_sigmas(spark, sf_dir):
    """Spread of each edge's matches, at least 0.1 px."""
    links = survey.edges(survey.nodes(spark, sf_dir))
    # Matches of odd sources are read off their edge, so that these stand at the floor.
    x, y = project(matrix(), F.col("sx"), F.col("sy"))
    told = survey.matches(links).join(links, ["src", "dst"])
    small = told.select("src", "dst", "k", "sx", "sy", "is_inlier", *[F.when(F.col("src") % 2 == 1, v).otherwise(F.col(c)).alias(c) for c, v in (("dx", x), ("dy", y))])
    out = refine.edge_sigma(small, links)
    return out.select("src", "dst", F.round("sigma", 6).alias("sigma"))


def relative_maps(spark, sf_dir):
    """Edges as affine maps about the source's centre, with their weights."""
    nodes = survey.nodes(spark, sf_dir)
    links = survey.edges(nodes, True)
    counts = metrics.inlier_stats(survey.matches(survey.edges(nodes)), ["src", "dst"])
    out = posegraph.relative_maps(links, nodes, counts, 4.0)
    return out.select("src", "dst", *[F.round(c, 6).alias(c) for c in ("m00", "m01", "m10", "m11", "mx", "my", "weight")])


def node_sets(spark, sf_dir):
    """Images with a usable edge, without one, and without a pose, as set operations on ids."""
    nodes = survey.nodes(spark, sf_dir).select("image_id")
    links = survey.edges(survey.nodes(spark, sf_dir)).where("(src + dst) % 4 = 0 and src % 6 <> 5")
    seen = sets.endpoints(links)
    posed = nodes.where("image_id % 3 <> 1")
    parts = (("evidenced", sets.present(nodes, seen)), ("without_edge", sets.missing(nodes, seen)), ("unposed", sets.missing(sets.present(nodes, seen), posed)), ("either", sets.union(seen, posed)))
    out = None
    for name, t in parts:
        row = t.agg(F.lit(name).alias("kind"), F.count("*").alias("n"), F.sum("image_id").alias("ids"))
        out = row if out is None else out.unionByName(row)
    return out


def edge_endpoints(spark, sf_dir):
    """Edges both of whose ends have an angle, in the same component."""
    nodes = survey.nodes(spark, sf_dir)
    angles = nodes.where("image_id % 4 <> 2").select(F.col("image_id").alias("node"), F.radians("yaw").alias("angle"), F.floor(F.col("image_id") / 15).alias("component"))
    out = sets.with_both_ends(survey.edges(nodes), angles)
    return out.select("src", "dst", F.round(wrap(F.col("angle_b") - F.col("angle_a")), 6).alias("turn"), "component")


def rounded_half_even(spark, sf_dir):
    """Grey values rounded half to even, as mosaics round them."""
    half = F.floor(F.col("l_quantity")) / 2
    return _table(spark, sf_dir, "lineitem").groupBy(F.rint(half).cast("long").alias("grey")).agg(F.count("*").alias("n"))


def _few(spark, sf_dir):
    """A survey with an image for each supplier: for solvers that take one graph in one task."""
    return survey.nodes(spark, sf_dir, "supplier", "s_suppkey")


def rotation_averages(spark, sf_dir):
    """Angles of each line of flight from consistent turns between all its images."""
    ids = survey.nodes(spark, sf_dir).select("image_id", (F.col("image_id") % 5).cast("double").alias("p"), F.floor(F.col("image_id") / 5).alias("line"))
    a = ids.select(F.col("image_id").alias("src"), F.col("p").alias("pa"), "line")
    b = ids.select(F.col("image_id").alias("dst"), F.col("p").alias("pb"), "line")
    turn = wrap(0.7 * (F.col("pb") * F.col("pb") - F.col("pa") * F.col("pa")))
    links = a.join(b, "line").where("src < dst").select("src", "dst", turn.alias("theta"), (1.0 + F.col("src") % 3).alias("weight"))
    out = rotation.rotation_averaging(links)
    return out.select("node", F.round("angle", 6).alias("angle"), "component")


def anchored_rotations(spark, sf_dir):
    """The same lines with an absolute heading for the first image of every other line."""
    nodes = survey.nodes(spark, sf_dir).select("image_id", F.floor(F.col("image_id") / 5).alias("line"))
    links = nodes.join(nodes.select((F.col("image_id") - 1).alias("image_id"), F.col("line").alias("other")), "image_id").where("line = other")
    turns = links.select(F.col("image_id").alias("src"), (F.col("image_id") + 1).alias("dst"), F.lit(0.05).alias("theta"), F.lit(1.0).alias("weight"))
    anchors = nodes.where("image_id % 10 = 0").select(F.col("image_id").alias("node"), (0.001 * F.col("line") - 0.5).alias("angle"), F.lit(1.0).alias("weight"))
    # Angles are known up to whole turns; a line's are told on the turn of its anchor.
    line = F.floor(F.col("node") / 5)
    near = F.when(line % 2 == 0, 0.001 * line - 0.5).otherwise(0.0)
    whole = F.rint((near - F.col("angle")) / (2 * math.pi)) * (2 * math.pi)
    return rotation.anchored_averaging(turns, anchors).select("node", F.round(F.col("angle") + whole, 6).alias("angle"))


def matched_homographies(spark, sf_dir):
    """Homographies estimated from nine exact points of each edge and one that is far off."""
    links = survey.edges(_few(spark, sf_dir), True)
    x, y = project(matrix(), F.col("sx"), F.col("sy"))
    k = F.col("k")
    points = links.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("sx", 700.0 + 900.0 * (k % 3) + 35.0 * F.floor(k / 3)).withColumn("sy", 500.0 + 700.0 * F.floor(k / 3))
    told = points.select("src", "dst", "k", "sx", "sy", (x + F.when(k == 9, 90.0).otherwise(0.0)).alias("dx"), y.alias("dy"))
    out = matching.match_edges(told)
    return out.select("src", "dst", *[F.round(f"h{i}{j}", 4).alias(f"h{i}{j}") for i in range(2) for j in range(3)], "match_count", "inlier_count", "error")


def lag_estimate(spark, sf_dir):
    """The recording lag of a survey recorded 2.3 m late, found by search."""
    true = segments.travel_directions(segments.segments(_few(spark, sf_dir), [], "t", "image_id"), [])
    links = survey.edges(true)
    found = lag.estimate_lag(links, segments.shift_by_lag(true, F.lit(-2.3)))
    return spark.createDataFrame([(round(found.lag_m, 1), found.status, found.reason)], "lag_m double, status string, reason string")


def global_poses(spark, sf_dir):
    """The whole chain on exact edges: angles of all images, and centres relative to the first one's."""
    nodes = _few(spark, sf_dir)
    links = survey.edges(nodes)
    exact = survey.matches(links).where("is_inlier").join(links, ["src", "dst"])
    x, y = project(matrix(), F.col("sx"), F.col("sy"))
    told = exact.select("src", "dst", "k", "sx", "sy", x.alias("dx"), y.alias("dy"), "is_inlier")
    out = estimate.estimate_global_poses(nodes.drop("yaw", "e", "nn"), links, told, with_lag=False)
    cx, cy = survey.COLS / 2.0, survey.ROWS / 2.0
    centre = out.poses.select("image_id", (F.col("t00") * cx + F.col("t01") * cy + F.col("t02")).alias("x"), (F.col("t10") * cx + F.col("t11") * cy + F.col("t12")).alias("y"), F.degrees(F.atan2("t10", "t00")).alias("turn"))
    # Directions on a sphere and on the plane part by some thousandths of a degree.
    zero = centre.agg(F.min(F.struct("image_id", "x", "y")).alias("o")).select(F.col("o.x").alias("x0"), F.col("o.y").alias("y0"))
    metres = lambda c, o: F.round((F.col(c) - F.col(o)) / survey.PPM, 0) + 0.0
    return centre.crossJoin(F.broadcast(zero)).select("image_id", F.round(F.col("turn"), 1).alias("turn"), metres("x", "x0").alias("east"), metres("y", "y0").alias("south"))


def refined_positions(spark, sf_dir):
    """Centres refined from exact matches and positions stretched by 0.3 %: the scale comes out, and every edge fits."""
    nodes = _few(spark, sf_dir)
    links = survey.edges(nodes)
    x, y = project(matrix(), F.col("sx"), F.col("sy"))
    told = survey.matches(links).where("is_inlier").join(links, ["src", "dst"]).select("src", "dst", "k", "sx", "sy", x.alias("dx"), y.alias("dy"), "is_inlier")
    posed = nodes.select("image_id", F.radians("yaw").alias("phi"), "rows", "cols", (F.col("e") * 1.003 * survey.PPM).alias("x"), (-F.col("nn") * 1.003 * survey.PPM).alias("y"))
    out = refine.refine_positions(told, links, posed, posed.select("image_id", "x", "y"), survey.PPM, rescale=True)
    centres = spark.createDataFrame([(i, *p) for i, p in out.centres.items()], "image_id long, x double, y double")
    first = centres.agg(F.min(F.struct("image_id", "x", "y")).alias("o")).select(F.col("o.x").alias("x0"), F.col("o.y").alias("y0"))
    return centres.crossJoin(F.broadcast(first)).select("image_id", (F.round(F.col("x") - F.col("x0"), 1) + 0.0).alias("x"), (F.round(F.col("y") - F.col("y0"), 1) + 0.0).alias("y"), F.lit(out.status).alias("status"))


def pose_graph(spark, sf_dir):
    """Similarity poses of all images from exact edges in one solve, relative to the first image."""
    nodes = _few(spark, sf_dir)
    links = survey.edges(nodes)
    counts = metrics.inlier_stats(survey.matches(links), ["src", "dst"])
    out = posegraph.compose_transforms(links, nodes, counts, 0, pixels_per_meter=survey.PPM, inlier_count_reference=8.0)
    rows = [(i, *(float(v) for v in posegraph.pose_parameters(m))) for i, m in out.poses.items()]
    poses = spark.createDataFrame(rows, "image_id long, a double, b double, tx double, ty double")
    return poses.select("image_id", *[(F.round(c, 3) + 0.0).alias(c) for c in ("a", "b", "tx", "ty")])


def yaw_targets(spark, sf_dir):
    """Direction that each image's yaw asks of its pose, relative to the first image."""
    rows = [(r.image_id, *posegraph.yaw_target(r.yaw, r.yaw0)) for r in _few(spark, sf_dir).crossJoin(_few(spark, sf_dir).agg(F.min(F.struct("image_id", "yaw")).alias("o")).select(F.col("o.yaw").alias("yaw0"))).collect()]
    return spark.createDataFrame(rows, "image_id long, u double, v double").select("image_id", (F.round("u", 6) + 0.0).alias("u"), (F.round("v", 6) + 0.0).alias("v"))


def spread_samples(spark, sf_dir):
    """At most 30 spread inliers of each edge; edges with fewer keep all."""
    links = survey.edges(_few(spark, sf_dir))
    kept = matching.farthest_point_sample(survey.matches(links))
    return kept.groupBy("src", "dst").agg(F.count("*").alias("n"), F.sum("k").alias("ks"))


def _strip(spark, sf_dir):
    """A flat image of 8 by 10 pixels for each nation, each 6 pixels to the right of the one before."""
    n = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("image_id"))
    grey = F.lpad(F.hex(F.col("image_id") * 37 % 200 + 20), 2, "0")
    images = n.select("image_id", F.lit(8).alias("height"), F.lit(10).alias("width"), F.unhex(F.repeat(grey, 240)).alias("rgb"))
    one, zero = F.lit(1.0), F.lit(0.0)
    cells = [one, zero, (6 * F.col("image_id")).cast("double"), zero, one, zero, zero, zero, one]
    poses = n.select("image_id", F.lit(8).alias("rows"), F.lit(10).alias("cols"), *[c.alias(f"t{k // 3}{k % 3}") for k, c in enumerate(cells)])
    return images, poses


def warped_pixels(spark, sf_dir):
    """Pixels and their sum, of each image warped onto the common canvas."""
    return raster.pixel_sums(raster.warp_tiles(*_strip(spark, sf_dir)))


def seam_differences(spark, sf_dir):
    """Summed difference over the common pixels of images that overlap."""
    out = raster.seam_differences(raster.warp_tiles(*_strip(spark, sf_dir)))
    return out.select("src", "dst", F.round("total", 4).alias("total"), "n")


def seam_error(spark, sf_dir):
    tiles = raster.warp_tiles(*_strip(spark, sf_dir))
    whole, band = raster.seam_error(tiles), raster.seam_error(tiles, raster.alphas(tiles))
    return whole.select(F.round("seam_error", 6).alias("seam_error")).crossJoin(band.select(F.round("seam_error", 6).alias("in_band")))


def blend_shares(spark, sf_dir):
    """The images' shares of all pixels add up to the covered pixels."""
    return raster.share_sums(raster.alphas(raster.warp_tiles(*_strip(spark, sf_dir)))).agg(F.count("*").alias("images"), F.round(F.sum("share"), 2).alias("pixels"))


def run_pipeline(spark, sf_dir):
    """Statuses of whole runs over no image, one image, and images without positions."""
    images, _ = _strip(spark, sf_dir)
    images = images.select("image_id", F.col("height").alias("rows"), F.col("width").alias("cols"), "rgb")
    out = None
    for name, some in (("none", images.where("image_id < 0")), ("one", images.where("image_id = 3")), ("unlocated", images)):
        row = run.run_pipeline(some, run.Unmatched()).metrics.select(F.lit(name).alias("run"), "pipeline_status", "input_image_count", "successful_image_count", "failed_image_count", "inlier_count", F.size("failed_image_indices").cast("long").alias("listed"), "method")
        out = row if out is None else out.unionByName(row)
    return out


def capture_sessions(spark, sf_dir):
    """Sessions of each user, ended by two hours without an event."""
    rows = _table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    out = sessions.capture_sessions(rows, "ts", "user_id", "2 hours")
    return out.select("user_id", F.unix_micros("first").alias("first_us"), F.unix_micros("last").alias("last_us"), "n")


def ordered_edges(spark, sf_dir):
    """Edges numbered in the order of their ends."""
    return pairing.numbered_edges(pairing.proximity_pairs(survey.nodes(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        inlier_stats_by_pair, inlier_stats_global, inlier_median_reference, proximity_pairs, sequential_pairs, all_pairs, bbox_overlap_pairs,
        reprojection_rmse, pair_metrics, cycle_loop_error, distortion, flight_segments, travel_directions, shift_by_lag, circular_mean_time_of_day,
        heading_observations, heading_consensus, edge_consistency_reasons, rejection_histogram, median_px_per_metre, densest_window, connected_components,
        attribute_map_extract, provenance_coalesce, run_status,
        exif_gps_fields, gps_positions, exif_latlons, capture_times, gimbal_yaws, camera_attributes, projected_positions, gps_placement, pixels_per_metre,
        usable_edges, edge_weights, heading_anchors, plain_heading_anchors, component_offsets, aligned_poses, numbered_components, failure_reasons, canvas_size,
        canvas_boxes, overlapping_footprints, finite_transforms, summary_metrics, lag_objective, huber_losses, edge_sigmas, relative_maps, node_sets,
        edge_endpoints, rounded_half_even, rotation_averages, anchored_rotations, matched_homographies, lag_estimate, global_poses, refined_positions, pose_graph,
        yaw_targets, spread_samples, warped_pixels, seam_differences, seam_error, blend_shares, run_pipeline, capture_sessions, ordered_edges,
    )
}
