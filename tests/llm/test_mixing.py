from collections import defaultdict

import pytest

from orthoskein.llm import mixing

SCHEMA = "doc_id long, text string, source string, target int"


def fill(sizes):
    """Targets by refilling the excess until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHT_CYCLE[k % 3] for k, s in enumerate(order)}
    limit = {s: 2.0 * sizes[s] for s in order}
    target, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while open_ and left > 1e-9:
        whole = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / whole for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= limit[s]:
                left += target[s] - limit[s]
                target[s] = limit[s]
                open_.discard(s)
    return target


def rows_for(counts):
    rows, n = [], 0
    for source, docs in counts.items():
        for k in range(docs):
            rows.append((n, "word " * (k % 9), source, 0))
            n += 1
    return rows


COUNTS = {"b": 400, "a": 30, "Z": 900, None: 120, "é": 60, "empty": 0, "c": 5}


@pytest.mark.parametrize("bound", [mixing.BROADCAST_SOURCES, 0])
def test_targets_and_taken(spark, monkeypatch, bound):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", bound)
    rows = [*rows_for(COUNTS), (9001, None, "b", 0), (9002, "", "nothing", 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = mixing.mixing_plan(df).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    want = fill(sizes)
    taken = defaultdict(int)
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - want[s]) <= 0.1 * want[s] + 60 for s in want)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert sorted((r.doc_id, r.target) for r in mixed.collect()) == sorted((r.doc_id, 0) for r in out for _ in range(r.copies))


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mixing_plan(empty).collect() == [] and mixing.mix(empty).collect() == []
    blank = spark.createDataFrame([(1, None, None, 0), (None, " ", "x", 0), (1, None, None, 0)], SCHEMA)
    assert [r.copies for r in mixing.mixing_plan(blank).collect()] == [0, 0, 0]
