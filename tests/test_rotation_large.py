"""Components too large for a dense problem."""

import numpy as np
import pyarrow as pa
import pytest

from orthoskein import queries
from orthoskein.operators import rotation


def strip(n, noise, rng):
    src, dst = (np.concatenate([a(d) for d in (1, 2, 5)]) for a in (lambda d: np.arange(n - d), lambda d: np.arange(d, n)))
    turned = rng.random(len(src)) < 0.5
    src, dst = np.where(turned, dst, src), np.where(turned, src, dst)
    angle = rng.uniform(-np.pi, np.pi, n)
    return src, dst, angle[dst] - angle[src] + rng.normal(0, noise, len(src)), rng.uniform(0.5, 2, len(src)), np.zeros(len(src), int)


@pytest.mark.parametrize("noise", [0.0, 0.02, 0.2])
def test_sparse_equals_dense(monkeypatch, noise):
    edges = [np.concatenate([c, c[:40]]) for c in strip(500, noise, np.random.default_rng(2))]
    node, angle, _ = rotation._average(*edges)
    monkeypatch.setattr(rotation, "DENSE", 10_000)
    same, dense, _ = rotation._average(*edges)
    assert (node == same).all()
    assert np.abs(np.angle(np.exp(1j * (angle - dense)))).max() < 1e-8


def test_components_in_any_batches():
    """Batches that end anywhere, stacks of equal sizes and sizes that differ."""
    rng, rows, want = np.random.default_rng(5), [], {}
    for c, n in enumerate([2, 5, 3, 5, 260, 2, 5]):
        angle = rng.uniform(-3, 3, n)
        rows += [(1000 * c + k, 1000 * c + k + 1, angle[k + 1] - angle[k], 1.0, 1000 * c) for k in range(n - 1)]
        want |= {1000 * c + k: (angle[k] - angle[0], 1000 * c) for k in range(n)}
    whole = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["src", "dst", "theta", "weight", "component"])
    for size in (1, 7, 1000):
        out = [r for b in rotation._averaged(whole.slice(at, size) for at in range(0, len(rows), size)) for r in b.to_pylist()]
        assert len(out) == len(want)
        assert all(abs(np.angle(np.exp(1j * (r["angle"] - want[r["node"]][0])))) < 1e-9 and r["component"] == want[r["node"]][1] for r in out)


def test_anchors_join_more_lines_than_a_dense_matrix_holds():
    """The ground reaches 6,000 lines of five: 14 GB as a dense matrix."""
    lines, rng = 6_000, np.random.default_rng(3)
    first = 1 + 5 * np.arange(lines)
    angle = rng.uniform(-np.pi, np.pi, lines)
    src = np.concatenate([np.zeros(lines, int), *[first + k for k in range(4)]])
    dst = np.concatenate([first, *[first + k + 1 for k in range(4)]])
    theta = np.concatenate([angle, np.full(4 * lines, 0.05)])
    _, found, _ = rotation._average(src, dst, theta, np.ones(len(src)), np.zeros(len(src), int))
    want = np.concatenate([[0.0], (angle[:, None] + 0.05 * np.arange(5)).ravel()])
    assert np.abs(np.angle(np.exp(1j * (found - want)))).max() < 1e-9


def test_anchors_beyond_half_a_turn(spark, tmp_path):
    """Lines whose anchors exceed pi keep them, and 301 lines meet in one component."""
    keys = [*range(20_000, 20_200), *range(40_000, 43_000)]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    got = {r.node: r.angle for r in queries.anchored_rotations(spark, str(tmp_path)).collect()}
    assert got == pytest.approx({k: 0.05 * (k % 5) + (0.001 * (k // 5) - 0.5 if k // 5 % 2 == 0 else 0.0) for k in keys}, abs=2e-6)
