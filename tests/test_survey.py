import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orthoskein.functions import geometry as g
from orthoskein.operators import headings, matching, metrics, pairing, raster, rotation, segments
from orthoskein.operators.components import components
from orthoskein.sources import metadata


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(1).alias("one"))
    return row.select(column).first()[0]


def test_angles_and_scale(spark):
    assert one(spark, g.wrap(F.lit(math.pi))) == pytest.approx(-math.pi)
    assert one(spark, g.wrap_degrees(F.lit(-170.0) - F.lit(170.0))) == pytest.approx(20.0)
    assert one(spark, g.pixels_per_metre(F.lit(math.hypot(3040, 4056)), F.lit(100.0), F.lit(82.9))) == pytest.approx(28.7, abs=0.05)


def test_proximity_pairs(spark):
    step = 30.0 / 6_371_000.0 * 180 / math.pi
    rows = [(3, 10.0, 20.0), (7, 10.0 + step, 20.0), (9, 10.0 + step, 20.0 + step), (5, 10.0, 20.0 + 10 * step), (4, None, 1.0), (8, 10.0, 20.0 - 10 * step)]
    df = spark.createDataFrame(rows, "image_id long, lat double, lon double")
    assert {tuple(r) for r in pairing.proximity_pairs(df).collect()} == {(3, 7), (7, 9)}
    rng = np.random.default_rng(0)
    many = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(60 + rng.random(300) * 0.004, rng.random(300) * 0.008))]
    got = {tuple(r) for r in pairing.proximity_pairs(spark.createDataFrame(many, "image_id long, lat double, lon double")).collect()}
    want = set()
    for i, a, b in many:
        for j, c, d in many:
            east, north = math.radians(d - b) * g.EARTH_RADIUS_M * math.cos(math.radians(a)), math.radians(c - a) * g.EARTH_RADIUS_M
            if i < j and math.hypot(east, north) < 40:
                want.add((i, j))
    assert got == want and want


def test_loop_and_inliers(spark):
    cells = [f"h{i}{j}" for i in range(3) for j in range(3)]
    move = lambda x, y: [1.0, 0.0, x, 0.0, 1.0, y, 0.0, 0.0, 1.0]
    edges = spark.createDataFrame([(0, 1, *move(5.0, 0.0)), (1, 2, *move(0.0, 4.0)), (0, 2, *move(5.0, 1.0))], ["src", "dst", *cells])
    loops = spark.createDataFrame([("a", k, n) for k, n in enumerate((0, 1, 2, 0))] + [("b", k, n) for k, n in enumerate((0, 9, 0))], "loop_id string, step int, image_id long")
    assert metrics.cycle_error(loops, edges).first()[0] == pytest.approx(3.0)
    assert metrics.cycle_error(loops.where("loop_id = 'b'"), edges).first()[0] is None
    rows = [(i % 2, i % 8 != 3 and i < 65) for i in range(96)]
    row = metrics.inlier_stats(spark.createDataFrame(rows, "pair int, is_inlier boolean")).first()
    assert (row.inlier_count, row.inlier_ratio) == (57, pytest.approx(57 / 96))


@pytest.mark.parametrize("one_task", [10**6, 0])
def test_components(spark, one_task):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)] + [tuple(map(int, e)) for e in rng.integers(200, 400, (90, 2))]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), one_task).collect()}
    assert got == {n: r for n, r in root.items() if n != r}


def test_segments(spark):
    rows = [(i, t) for i, t in enumerate((0.0, 1.0, 2.0, 3.0, 7.0, 8.0, 9.0))]
    df = spark.createDataFrame(rows, "image_id long, t double")
    assert [r.segment for r in segments.segments(df, [], "t", "image_id").orderBy("t").collect()] == [0, 0, 0, 0, 1, 1, 1]
    even = spark.createDataFrame([(0, 0.0), (1, 1.0), (2, 2.0), (3, 5.0)], "image_id long, t double")
    assert {r.segment for r in segments.segments(even, [], "t", "image_id").collect()} == {0}


def test_consensus_takes_the_first_of_equal_sets(spark):
    sigma = math.radians(1.0)
    rows = [(1, 2, 0, 0.0, sigma), (1, 3, 0, 0.01, sigma), (1, 4, 0, 2.0, sigma), (1, 5, 0, 2.01, sigma)]
    r = headings.consensus(spark.createDataFrame(rows, "src long, dst long, node long, h double, sigma double")).first()
    assert r.heading == pytest.approx(0.005) and (r.n_agree, r.n_obs, r.trusted) == (2, 4, False)


def test_rotation_averaging_spreads_a_loop_error(spark):
    rows = [(0, 1, 0.3, 1.0), (1, 2, 0.2, 1.0), (0, 2, 0.5 + 0.03, 1.0), (10, 11, 3.0, 2.0)]
    out = {r.node: r for r in rotation.rotation_averaging(spark.createDataFrame(rows, "src long, dst long, theta double, weight double")).collect()}
    assert out[0].angle == 0 and out[1].angle == pytest.approx(0.31, abs=1e-4) and out[2].angle == pytest.approx(0.52, abs=1e-4)
    assert out[11].component == 10 and out[11].angle == pytest.approx(3.0)
    with pytest.raises(ValueError):
        rotation.rotation_averaging(spark.createDataFrame([(1, 1, 0.0, 1.0)], "src long, dst long, theta double, weight double"))


def test_ransac_and_spread_sample():
    h = np.array([[1.02, 0.03, 5], [-0.02, 0.98, -7], [1e-5, 2e-5, 1]])
    a = np.array([[x, y] for x in range(0, 500, 90) for y in range(0, 400, 72)], float)
    p = np.c_[a, np.ones(len(a))] @ h.T
    b = p[:, :2] / p[:, 2:]
    b[:6] += 80
    got, mask = matching.ransac_homography(a, b)
    assert np.allclose(got, h, atol=1e-6) and mask.sum() == len(a) - 6 and not mask[:6].any()
    assert matching.ransac_homography(a[:3], b[:3])[0] is None
    # All corners are as far from the middle: the first; then the one across; then the middle, which beats the near corners.
    assert matching.farthest_points(np.array([[0, 0], [10, 0], [0, 4], [10, 4], [5, 2]], float), 3) == [0, 3, 4]
    assert matching.farthest_points(np.array([[x, 0.0] for x in (0, 1, 2, 6, 7)]), 3) == [4, 0, 2]


def test_edge_distance():
    rng = np.random.default_rng(1)
    mask = (rng.random((23, 31)) > 0.05).astype(np.uint8)
    zero = np.argwhere(mask == 0)
    want = np.array([[np.hypot(*(zero - (y, x)).T).min() for x in range(31)] for y in range(23)])
    assert np.allclose(raster.edge_distance(mask), want, atol=1e-5)
    assert raster.edge_distance(np.ones((3, 4), np.uint8))[0, 0] == 5.0


def test_warp_blend_and_seam(spark):
    eye = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    move = [1.0, 0.0, 20.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    flat = lambda v: np.full((40, 50, 3), v, np.uint8).tobytes()
    images = spark.createDataFrame([(1, 40, 50, bytearray(flat(100))), (2, 40, 50, bytearray(flat(151)))], "image_id long, height int, width int, rgb binary")
    cells = [f"t{i}{j}" for i in range(3) for j in range(3)]
    poses = spark.createDataFrame([(1, 40, 50, *eye), (2, 40, 50, *move)], ["image_id", "rows", "cols", *cells])
    tiles = raster.warp_tiles(images, poses)
    assert raster.seam_error(tiles).first()[0] == pytest.approx(51 / 255, abs=1e-6)
    mosaic = np.frombuffer(raster.blend(tiles).first().rgb, np.uint8).reshape(raster.TILE, raster.TILE, 3)
    assert mosaic[5, 5, 0] == 100 and mosaic[5, 65, 0] == 151 and 100 < mosaic[20, 35, 0] < 151 and mosaic[200, 200, 0] == 0


def test_metadata(spark):
    packet = 'x <x:xmpmeta a="1" b:C="+36.5" a="2"/> y</x:xmpmeta>'
    m = one(spark, metadata.attributes(F.lit(packet)))
    assert m == {"a": "2", "b:C": "+36.5"}
    assert one(spark, metadata.attributes(F.lit("none"))) == {}
    assert one(spark, metadata.signed_decimal(F.lit("+36.42"))) == 36.42
    assert one(spark, metadata.capture_time(F.lit("1970:01:01 00:00:10"), F.lit("25"))) == 10.25
    assert one(spark, metadata.capture_time(F.lit("garbage"), F.lit("25"))) is None
    dms = F.array(*[F.struct(F.lit(n).alias("num"), F.lit(d).alias("den")) for n, d in ((36, 1), (30, 1), (0, 1))])
    assert one(spark, metadata.degrees_of(dms, F.lit("S"))) == -36.5
