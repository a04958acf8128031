"""Connected components: union-find in one task up to a checked size, alternating stars beyond."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stash, unstash

#: Distinct edges (16 bytes each) that one task takes.
ONE_TASK = 1_000_000


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    found = [(x, find(x)) for x in root]
    for at in range(0, len(found), 1 << 16):
        part = [r for r in found[at : at + (1 << 16)] if r[0] != r[1]]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.int64()), pa.array([y for _, y in part], pa.int64())], names=["node", "component"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours and itself to its least one.

    The least neighbour comes from a partially aggregated minimum joined back,
    so that a hub is never gathered as one list.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least, "a")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component) of every node of ``edges(a, b)`` but the least of each component.

    The result is a star: ``component`` is the least node reachable. At most
    ``one_task`` edges go through one task; more are contracted by stars.
    """
    now = stash(edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct(), "cc")
    state = _state(now)
    if state[0] <= one_task:
        return now.coalesce(1).mapInArrow(_union, "node long, component long")
    while state[0]:
        new = stash(_star(_star(now, True), False), "cc")
        unstash(now)
        now, before, state = new, state, _state(new)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
