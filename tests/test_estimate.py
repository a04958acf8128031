import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orthoskein.operators import lag, report, segments
from orthoskein.plans import estimate, survey
from orthoskein.streaming import sessions


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("survey"))
    spark.range(20).select(F.col("id").alias("c_custkey")).write.parquet(folder + "/customer.parquet")
    nodes = survey.nodes(spark, folder)
    edges = survey.edges(nodes)
    return nodes, edges, survey.matches(edges).withColumn("dy", F.col("dy") + 0.0)


def test_lag_is_recovered(spark, world):
    nodes, edges, _ = world
    ways = segments.travel_directions(segments.segments(nodes, [], "t", "image_id"), [])
    late = segments.shift_by_lag(ways, F.lit(-2.3)).cache()
    found = lag.estimate_lag(edges, late)
    assert found.status == "estimated" and found.lag_m == pytest.approx(2.3, abs=0.06)


def test_poses_of_the_exact_world(spark, world):
    nodes, edges, matches = world
    out = estimate.estimate_global_poses(nodes.drop("yaw", "e", "nn"), edges, matches, with_lag=False)
    assert out.status == "converged" and out.px_per_m == pytest.approx(survey.PPM, rel=1e-3)
    yaw = {r.image_id: r.yaw for r in nodes.collect()}
    for r in out.poses.collect():
        angle = math.degrees(math.atan2(r.t10, r.t00))
        assert abs((angle - yaw[r.image_id] + 180) % 360 - 180) < 0.05
    assert estimate.estimate_global_poses(nodes.withColumn("lat", F.lit(None).cast("double")), edges, matches).reason == "no_gps"


def test_report(spark, tmp_path):
    images = spark.range(10).withColumnRenamed("id", "image_id")
    row = report.process_row(images, images.where("image_id not in (7, 9)"), 5.0)
    out = report.summary_row(row, spark.sql("SELECT 0.5D AS inlier_ratio, CAST(NULL AS DOUBLE) AS seam_error"), method="plain")
    r = out.first()
    assert out.columns == [*report.COLUMNS, "method"]
    assert (r.pipeline_status, r.stitch_success_rate, r.failed_image_indices, r.avg_processing_time_per_image_sec) == ("partial_success", 0.8, [7, 9], 0.5)
    assert np.isnan(r.seam_error) and np.isnan(r.distortion) and r.inlier_ratio == 0.5
    report.write_text(out, str(tmp_path / "metrics.txt"))
    assert "partial_success" in (tmp_path / "metrics.txt").read_text()
    report.write_csv(out, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().failed_image_indices == "[7,9]"


def test_sessions(spark):
    rows = spark.sql("SELECT 1 AS k, timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, m, 0) AS ts FROM VALUES (0), (20), (50), (81) t(m)")
    got = sorted(r.n for r in sessions.capture_sessions(rows, "ts", "k").collect())
    assert got == [1, 3]
