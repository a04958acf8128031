"""Whole runs over small rendered images whose matches are known."""

import math

import numpy as np
import pytest

from orthoskein.operators import matching, raster, report, rotation
from orthoskein.plans import estimate, run

H, W, PPM, R = 64, 84, 4.0, 6_371_000.0
LAT0, LON0 = 41.25, 2.125
SCHEMA = "image_id long, rows int, cols int, rgb binary"


def pose(i):
    """Pixels to frame pixels (east, south): two lines of flight, the second one back."""
    line, step = divmod(i, 6)
    angle = math.radians(20.0 if line == 0 else 200.0)
    east, north = 6.0 * (step if line == 0 else 5 - step) * math.cos(0.1), 6.0 * (step if line == 0 else 5 - step) * math.sin(0.1) + 8.0 * line
    c, s = math.cos(angle), math.sin(angle)
    centre = np.array([PPM * east, -PPM * north])
    r = np.array([[c, -s], [s, c]])
    out = np.eye(3)
    out[:2, :2], out[:2, 2] = r, centre - r @ (W / 2, H / 2)
    return out, (LAT0 + math.degrees(north / R), LON0 + math.degrees(east / (R * math.cos(math.radians(LAT0)))))


def picture(i):
    y, x = np.mgrid[0:H, 0:W]
    p = pose(i)[0] @ np.stack([x.ravel(), y.ravel(), np.ones(x.size)])
    value = [120 + 60 * np.sin(p[0] / a) * np.cos(p[1] / b) for a, b in ((23, 31), (17, 41), (37, 13))]
    out = np.stack(value, -1).reshape(H, W, 3).astype(np.uint8)
    out[0, 0] = (i, 7, 7)
    return out


class Known:
    """Finds the grid of ground points that both images show; their first pixel tells which they are."""

    name = "known"

    def __init__(self, fails=()):
        self.fails = fails

    def match(self, image_a, image_b):
        a, b = int(image_a[0, 0, 0]), int(image_b[0, 0, 0])
        if (a, b) in self.fails:
            raise RuntimeError("no features")
        y, x = np.mgrid[3:H:6, 3:W:6]
        src = np.stack([x.ravel(), y.ravel(), np.ones(x.size)]).astype(float)
        dst = np.linalg.inv(pose(b)[0]) @ pose(a)[0] @ src
        inside = (dst[0] > 0) & (dst[0] < W) & (dst[1] > 0) & (dst[1] < H)
        return matching.MatchResult(src[:2, inside].T, dst[:2, inside].T)


def images(spark, ids):
    return spark.createDataFrame([(i, H, W, bytearray(picture(i).tobytes())) for i in ids], SCHEMA)


def positions(spark, ids):
    return spark.createDataFrame([(i, *pose(i)[1]) for i in ids], "image_id long, lat double, lon double")


def test_a_whole_run(spark):
    ids = range(12)
    out = run.run_pipeline(images(spark, ids), Known(fails=[(0, 1)]), run.RunConfig(latlons=positions(spark, ids)))
    row = out.metrics.first()
    assert (row.pipeline_status, row.successful_image_count, row.failed_image_indices, row.method) == ("success", 12, [], "known")
    assert row.reprojection_error_px < 1e-6 and row.inlier_ratio == 1.0 and row.seam_error < 0.03 and row.distortion < 1e-6
    assert out.estimate.lag.status == "no_capture_times" and out.estimate.px_per_m == pytest.approx(PPM, rel=1e-3)
    assert out.height > H and out.width > W and out.tiles.count() >= 1
    turn = {r.image_id: math.degrees(math.atan2(r.t10, r.t00)) for r in out.estimate.poses.collect()}
    assert all(abs((turn[i] - (20 if i < 6 else 200) + 180) % 360 - 180) < 0.05 for i in ids)
    tile = np.frombuffer(out.tiles.where("ty = 0 and tx = 0").first().rgb, np.uint8)
    assert 100 < tile[tile > 0].mean() < 140


def test_runs_without_result(spark):
    empty = run.run_pipeline(images(spark, []), Known()).metrics.first()
    assert (empty.pipeline_status, empty.input_image_count, empty.failed_image_indices) == ("failed", 0, []) and np.isnan(empty.inlier_ratio)
    lost = run.run_pipeline(images(spark, range(4)), Known())
    row = lost.metrics.first()
    assert (row.pipeline_status, row.failed_image_indices, lost.estimate.reason) == ("failed", [0, 1, 2, 3], "no_gps")
    assert row.inlier_count > 0 and lost.tiles.count() == 0 and (lost.height, lost.width) == (0, 0)
    assert {r.reason for r in lost.estimate.node_reasons.collect()} == {"unlocated"}
    with pytest.raises(ValueError):
        run.run_pipeline(images(spark, [0]), Known(), run.RunConfig(anchors="compass"))
    with pytest.raises(ValueError):
        run.run_pipeline(images(spark, [0]), Known(), run.RunConfig(anchors="gimbal"))


def test_a_single_image_is_taken_as_it_is(spark):
    out = run.run_pipeline(images(spark, [3]), Known())
    assert out.metrics.first().pipeline_status == "success" and (out.height, out.width) == (H, W)
    tile = np.frombuffer(out.tiles.first().rgb, np.uint8).reshape(raster.TILE, raster.TILE, 3)
    assert (tile[:H, :W] == picture(3)).all() and not tile[H:].any() and not tile[:, W:].any()


def test_anchors_and_reasons_of_the_estimate(spark):
    ids = range(12)
    matched = matching.match_images(images(spark, ids), run.default_pairs(images(spark, ids), run.RunConfig(latlons=positions(spark, ids))), Known())
    matched = matched.cache()
    edges, matches = matched.drop("matches", "error").where("src <> 11 and dst <> 11"), matched.selectExpr("src", "dst", "inline(matches)").where("src <> 11 and dst <> 11")
    nodes = images(spark, ids).select("image_id", "rows", "cols").join(positions(spark, [i for i in ids if i != 4]), "image_id", "left").selectExpr("*", "cast(null as double) as t")
    yaws = spark.createDataFrame([(i, 20.0 if i < 6 else 200.0) for i in ids], "image_id long, yaw_deg double")
    turns = []
    for anchors, given in (("gps", None), ("gimbal", yaws), ("none", None)):
        out = estimate.estimate_global_poses(nodes, edges.select("src", "dst", *[f"h{i}{j}" for i in range(3) for j in range(3)]), matches, anchors=anchors, gimbal_yaw=given)
        assert out.status == "converged" and out.anchors == anchors
        assert {r.image_id: r.reason for r in out.node_reasons.collect()} == {11: "no_determined_edge", 4: "unlocated"}
        turns.append({r.image_id: math.atan2(r.t10, r.t00) for r in out.poses.collect()})
    assert all(abs((t[i] - turns[0][i] + 3) % (2 * math.pi) - 3) < 0.01 for t in turns for i in turns[0])
    with pytest.raises(ValueError):
        estimate.estimate_global_poses(nodes, edges, matches, gimbal_yaw=yaws)


def test_placement_rules(spark):
    rows = [(1, H, W, None, 2.0), (2, H, W, 41.0, 2.0), (3, H, W, 41.001, float("nan")), (4, H, W, 41.001, 2.0)]
    nodes = spark.createDataFrame(rows, "image_id long, rows int, cols int, lat double, lon double")
    out = estimate.place_by_gps(nodes, 10.0)
    assert out.origin == 2 and {r.image_id for r in out.unlocated.collect()} == {1, 3}
    assert {r.image_id: round(r.y, 1) for r in out.centres.collect()} == {2: 0.0, 4: round(-10 * math.radians(0.001) * R, 1)}
    assert {r.image_id: round(r.y, 1) for r in estimate.place_by_gps(nodes, 10.0, 4).centres.collect()}[4] == 0.0
    for bad in (lambda: estimate.place_by_gps(nodes, 0.0), lambda: estimate.place_by_gps(nodes, float("nan")), lambda: estimate.place_by_gps(nodes, 1.0, 1), lambda: estimate.place_by_gps(nodes.fillna(95.0), 1.0)):
        with pytest.raises(ValueError):
            bad()
    assert estimate.place_by_gps(nodes.where("image_id = 1"), 1.0).origin is None


def test_shares_and_bands(spark):
    eye, move = np.eye(3).ravel().tolist(), [1.0, 0.0, 40.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    flat = spark.createDataFrame([(k, 40, 80, bytearray(np.full((40, 80, 3), v, np.uint8).tobytes())) for k, v in ((1, 100), (2, 151))], "image_id long, height int, width int, rgb binary")
    poses = spark.createDataFrame([(1, 40, 80, *eye), (2, 40, 80, *move)], ["image_id", "rows", "cols", *run.TRANSFORM])
    tiles = raster.warp_tiles(flat, poses).cache()
    share = {r.image_id: np.frombuffer(r.alpha, np.float32).reshape(raster.TILE, raster.TILE) for r in raster.alphas(tiles).collect()}
    covered = (share[1] + share[2]) > 0
    assert np.allclose((share[1] + share[2])[covered], 1) and covered[:40, :120].all() and covered.sum() == 40 * 120
    assert raster.seam_error(tiles).first()[0] == pytest.approx(51 / 255, abs=1e-6)
    n = lambda band: raster.seam_differences(tiles, band).first().n
    assert n(None) == 40 * 40 * 3
    left = np.zeros((raster.TILE, raster.TILE), np.float32)
    left[:, :50] = 1
    one = spark.createDataFrame([(1, 0, 0, bytearray(left.tobytes()))], "image_id long, ty int, tx int, alpha binary")
    assert n(one) == 40 * 10 * 3 and n(raster.alphas(tiles)) == 40 * 40 * 3


def test_borders_share_with_zero():
    image = np.full((10, 10, 3), 200, np.uint8)
    half = np.array([[1, 0, 0.5], [0, 1, 0], [0, 0, 1.0]])
    rgb, mask, (top, left) = raster.warp(image, half, 0.0, 0.0, 10, 12)
    assert (top, left) == (0, 0) and mask[5, :12].tolist() == [128] + [255] * 9 + [128, 0][: mask.shape[1] - 10]
    assert rgb[5, 0, 0] == 100 and rgb[5, 4, 0] == 200
    nothing = raster.warp(image, np.diag([0.0, 0.0, 1.0]), 0.0, 0.0, 10, 10)
    assert not nothing[1].size


def test_distances_of_a_large_mask_take_seconds():
    import time

    y, x = np.mgrid[0:700, 0:900]
    mask = ((x - 450) * 0.9 + (y - 350) * 0.3 < 300) & ((x - 450) * 0.9 + (y - 350) * 0.3 > -300) & (np.abs((y - 350) * 0.9 - (x - 450) * 0.3) < 220)
    began = time.perf_counter()
    got = raster.edge_distance(mask.astype(np.uint8))
    assert time.perf_counter() - began < 5
    zero = np.argwhere(~mask)
    for py, px in ((350, 450), (300, 400), (420, 500)):
        assert got[py, px] == pytest.approx(np.hypot(*(zero - (py, px)).T).min(), abs=1e-4)


def test_components_are_numbered(spark):
    rows = [(0, 1, 0.3, 1.0), (7, 8, 0.2, 1.0), (4, 5, 0.1, 2.0)]
    angles = rotation.rotation_averaging(spark.createDataFrame(rows, "src long, dst long, theta double, weight double"))
    assert {r.node: r.component for r in rotation.numbered(angles).collect()} == {0: 0, 1: 0, 4: 1, 5: 1, 7: 2, 8: 2}
    tied = rotation.anchored_averaging(spark.createDataFrame(rows, "src long, dst long, theta double, weight double"), spark.createDataFrame([(0, 1.0, 1.0), (4, -1.0, 1.0)], "node long, angle double, weight double"))
    out = {r.node: r for r in tied.collect()}
    assert out[0].component == out[4].component != out[7].component and out[1].angle == pytest.approx(1.3) and out[5].angle == pytest.approx(-0.9)
    with pytest.raises(ValueError):
        rotation.anchored_averaging(spark.createDataFrame(rows, "src long, dst long, theta double, weight double"), spark.createDataFrame([(0, float("nan"), 1.0)], "node long, angle double, weight double"))


def test_compose(spark):
    from orthoskein.operators import posegraph

    cells = [f"h{i}{j}" for i in range(3) for j in range(3)]
    move = lambda x, y: [1.0, 0.0, x, 0.0, 1.0, y, 0.0, 0.0, 1.0]
    edges = spark.createDataFrame([(0, 1, *move(-40.0, 0.0)), (1, 2, *move(0.0, -30.0))], ["src", "dst", *cells])
    sizes = spark.createDataFrame([(i, H, W) for i in range(3)], "image_id long, rows int, cols int")
    counts = spark.createDataFrame([(0, 1, 50), (1, 2, 40)], "src long, dst long, inlier_count long")
    out = posegraph.compose_transforms(edges, sizes, counts, pixels_per_meter=4.0, inlier_count_reference=45.0)
    assert out.status == "converged" and out.poses[2][:2, 2] == pytest.approx([40, 30]) and posegraph.pose_parameters(out.poses[2]) == pytest.approx([1, 0, 40, 30])
    at = spark.createDataFrame([(1, 10.0, 0.0), (2, 10.0, 7.5)], "image_id long, east double, north double")
    yaw = spark.createDataFrame([(2, 0.0)], "image_id long, yaw_deg double")
    same = posegraph.compose_transforms(edges, sizes, counts, pixels_per_meter=4.0, inlier_count_reference=45.0, positions=at, relative_yaw=yaw, yaw_weight=1.0)
    assert same.poses[2][:2, 2] == pytest.approx([40, 30], abs=1e-6)
    with pytest.raises(ValueError):
        posegraph.compose_transforms(edges, sizes, counts, pixels_per_meter=4.0, inlier_count_reference=45.0, relative_yaw=yaw)
    assert report.COLUMNS[0] == "pipeline_status"
