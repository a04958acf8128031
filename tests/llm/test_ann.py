import numpy as np
import pytest

from orthoskein.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5):
    fine = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, q in fine:
        if i % 50 == 0:
            near = [(-round(float(x @ q / np.sqrt(x @ x) / np.sqrt(q @ q)), 12), j) for j, x in fine if j != i]
            out[i] = [(j, -s) for s, j in sorted(near)[:k]]
    return out


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = {}
    for r in ann.search(df, df.vec_id % 50 == 0, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=32).tolist()) for i in range(6000)]
    got, want = run(spark, rows), brute(rows)
    assert got.keys() == want.keys()
    assert all(len(v) == 5 for v in got.values())
    exact = {(q, j): s for q, near in want.items() for j, s in near}
    hits = [(q, j) in exact for q, near in got.items() for j, _ in near]
    assert np.mean(hits) >= 0.9
    assert all(abs(s - exact[q, j]) < 1e-9 for q, near in got.items() for j, s in near if (q, j) in exact)


def test_whole_share_is_exact_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    same = rng.normal(size=8).tolist()
    rows = [(i, same if i % 3 == 0 else rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(1000, None), (1050, [0.0] * 8), (1100, [1.0, None] * 4), (1150, [float("nan")] * 8), (1200, [float("inf")] * 8), (None, same), (1250, [1e30] * 8), (1251, [1e-30] * 8)]
    got, want = run(spark, rows, share=1.0), brute(rows[:-2] + [(1250, [1.0] * 8), (1251, [1.0] * 8)])
    assert {q: [j for j, _ in v] for q, v in got.items()} == {q: [j for j, _ in v] for q, v in want.items()}


def test_small_tables(spark):
    assert run(spark, []) == {}
    assert run(spark, [(50, [1.0, 2.0])]) == {}
    assert run(spark, [(50, [1.0, 2.0]), (1, [2.0, 1.0])])[50] == [(1, pytest.approx(0.8))]
    assert run(spark, [(50, [3.0]), (1, [2.0]), (2, [-2.0])])[50] == [(1, 1.0), (2, -1.0)]


def test_traversal_order():
    rng = np.random.default_rng(2)
    d1, d2, counts = rng.random(9), rng.random(7), rng.integers(0, 4, 63)
    pairs = sorted((d1[i] + d2[j], counts[i * 7 + j]) for i in range(9) for j in range(7))
    for wanted in (1, 10, 40, 1000):
        met, last = 0, 0.0
        for d, c in pairs:
            if met >= wanted:
                break
            met, last = met + c, d
        assert ann.traverse(d1, d2, counts, wanted) == pytest.approx(last)


def test_scored_pairs_follow_the_share():
    """Work is done for visited cells alone, and every visited cell is scored."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16))
    ids, u = np.arange(len(x)), ann.unit(x)
    books = ann.Codebooks(ann._kmeans(u[:, :8], 32), ann._kmeans(u[:, 8:], 32))
    cells = books.cells(u)
    counts = np.bincount(cells, minlength=32 * 32)
    d1, d2 = books.distances(u[:60])
    for share in (0.05, 0.2, 0.6):
        wanted = int(share * len(x))
        reach = np.array([ann.traverse(a, b, counts, wanted) for a, b in zip(d1, d2)])
        scored = 0
        for code in range(32):
            order = np.lexsort((ids, cells))
            of = order[cells[order] // 32 == code]
            if len(of):
                scored += ann.best_visited(books, code, (ids[:60], x[:60], reach), (ids[of], x[of]), 5)[3]
        assert wanted <= scored / 60 <= wanted + 2 * counts.max()


def test_other_columns_are_not_read(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist(), 1, "x") for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, code int, rank string")
    out = ann.search(df, df.vec_id % 50 == 0, share=1.0)
    assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 15
