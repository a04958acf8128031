"""Queries on surveys tens of kilometres long, whose images lie in two groups, against their SQL."""

import duckdb
import numpy as np
import pytest

from orthoskein import queries
from orthoskein.operators import matching, refine
from orthoskein.oracles import ORACLES

#: Three lines of flight at the start and three some 27 km further on.
KEYS = [*range(15), *range(5000, 5015)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("far"))
    spark.createDataFrame([(k,) for k in KEYS], "s_suppkey long").write.parquet(path + "/supplier.parquet")
    return path


def equals_sql(spark, folder, name):
    c = duckdb.connect()
    c.execute(f"create view supplier as select * from '{folder}/supplier.parquet/*.parquet'")
    want = c.sql(ORACLES[name])
    df = queries.QUERIES[name](spark, folder).select(*want.columns)
    assert sorted(map(tuple, df.collect())) == sorted(want.fetchall())


def test_global_poses_keep_to_the_plane(spark, folder):
    equals_sql(spark, folder, "global_poses")


def test_refined_positions_find_the_scale(spark, folder):
    """0.3 % of 27 km are 81 m, where a box around the stretched position reaches 5 m."""
    equals_sql(spark, folder, "refined_positions")


def test_boxes_at_the_scale_of_the_edges():
    """Images 500 m apart to 20 km, positions stretched by 1 %; one recorded 20 m off is held within 5 m of its place at that scale."""
    ppm, truth = 30.0, {i: (15000.0 * i, 40.0 * (i % 3)) for i in range(40)}
    offsets = [(i, i + 1, truth[i][0] - truth[i + 1][0], truth[i][1] - truth[i + 1][1]) for i in range(39) for _ in range(4)]
    placed = {i: (1.01 * x, 1.01 * y + (606.0 if i == 30 else 0.0)) for i, (x, y) in truth.items()}
    sigmas = dict.fromkeys([(i, i + 1) for i in range(39)], 0.1)
    out = refine.refine(offsets, sigmas, placed, ppm, rescale=True)
    assert out.status == "converged" and out.kappa == pytest.approx(1 / 1.01, rel=1e-6) and {30} <= out.held <= set(range(25, 36))
    assert out.centres[30][1] == pytest.approx(placed[30][1] / 1.01 - 5.0 * ppm, abs=1e-6)
    assert max(abs(out.centres[i][0] - truth[i][0]) for i in truth) < 1.0


def test_samples_of_large_and_small_edges(spark):
    """Edges of 5, 30 and 45 inliers, and outliers that take no part."""
    points = {(e, k): (float(k * 37 % 101), float(k * k % 89)) for e, n in ((1, 5), (2, 30), (3, 45)) for k in range(n)}
    rows = [(e, e + 1, k, x, y, x, y, True) for (e, k), (x, y) in points.items()] + [(e, e + 1, 99, 500.0, 500.0, 0.0, 0.0, False) for e in (1, 2, 3)]
    out = matching.farthest_point_sample(spark.createDataFrame(rows, "src long, dst long, k int, sx double, sy double, dx double, dy double, is_inlier boolean"))
    got = sorted((r.src, r.k) for r in out.collect())
    spread = matching.farthest_points(np.array([points[3, k] for k in range(45)]))
    assert got == sorted([(1, k) for k in range(5)] + [(2, k) for k in range(30)] + [(3, k) for k in spread]) and len(spread) == 30
