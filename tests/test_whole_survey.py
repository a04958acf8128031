"""Queries over all of a survey, against brute force on a customer table with gaps and uneven lines."""

import itertools

import numpy as np
import pytest

from orthoskein import queries
from orthoskein.plans import survey

#: Three places far from each other: six lines, five lines and a single image.
KEYS = [*range(28), *range(200, 223), 500]


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame([(k,) for k in KEYS], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    return str(tmp_path)


def test_every_closed_triangle_counts(spark, folder):
    links = survey.edges(survey.nodes(spark, folder), false_edges=True)
    h = {(r.src, r.dst): np.array([[r[f"h{i}{j}"] for j in range(3)] for i in range(3)]) for r in links.collect()}
    triangles = [t for t in itertools.combinations(KEYS, 3) if all(p in h for p in itertools.combinations(t, 2))]
    assert {sum(t) % 5 for t in triangles} == set(range(5))
    points = np.array([(0, 0, 1), (100, 0, 1), (100, 100, 1), (0, 100, 1), (50, 50, 1)], float)
    errors = []
    for a, b, c in triangles:
        moved = points @ (np.linalg.inv(h[a, c]) @ h[b, c] @ h[a, b]).T
        errors.append(np.sqrt((((moved / moved[:, 2:]) - points) ** 2).sum(1).mean()))
    assert survey.loops(links).select("loop_id").distinct().count() == len(triangles)
    assert queries.cycle_loop_error(spark, folder).first()[0] == pytest.approx(np.mean(errors), abs=1e-4)


def test_components_reach_across_blocks_of_ids(spark, folder):
    at = {r.image_id: (r.e, r.nn) for r in survey.nodes(spark, folder).collect()}
    root = {k: k for k in KEYS}
    for _ in KEYS:
        for a, b in itertools.combinations(KEYS, 2):
            if np.hypot(at[a][0] - at[b][0], at[a][1] - at[b][1]) < 39.9:
                root[a] = root[b] = min(root[a], root[b])
    assert set(root.values()) == {0, 200, 500}
    assert {r.image_id: r.component for r in queries.connected_components(spark, folder).collect()} == root
