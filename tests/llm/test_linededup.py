import hashlib

import numpy as np
import pytest

from orthoskein.llm import blooms, linededup

SCHEMA = "doc_id long, text string, n_lines int, key string"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows):
    first = {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for line in (text or "").split("\n"):
            first.setdefault(key_of(line), i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(key_of(x)) < 10 or first[key_of(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = (
    [(i, f"line number {i % 7} is here\n\nUnique {i * i} words\r\n  LINE NUMBER {i % 7} is HERE\t\nshort") for i in range(60)]
    + [(100, None), (101, ""), (102, "\n\n"), (103, "line number 1 is here"), (104, "été été été"), (105, "ÉTÉ ÉTÉ ÉTÉ\nété été été"), (106, "é" * 9), (107, "é" * 9)]
    + [(None, "line number 1 is here"), (200, "a long common line\n" * 5000), (3, ""), (201, "same row again\nand more of it"), (201, "same row again\nand more of it")]
)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], SCHEMA).repartition(4)
    out = linededup.line_dedup(df)
    assert out.columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect()), key=str)


def test_matches_brute_force(spark):
    assert run(spark, ROWS) == brute(ROWS)
    assert run(spark, []) == []


def test_many_shards_give_the_same(spark):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in ROWS], SCHEMA).repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        lost = {(r.doc_id, r.line) for r in linededup.suspected_lines(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    held = {}
    for i, t in ROWS:
        for j, line in enumerate((t or "").split("\n")):
            if i is not None and len(key_of(line)) >= 10:
                held.setdefault(key_of(line), set()).add((i, j))
    repeated = {x for places in held.values() if len({i for i, _ in places}) > 1 for x in places}
    alone = {x for places in held.values() if len(places) == 1 for x in places}
    assert repeated <= lost and len(lost & alone) < 3


def test_names_of_other_columns_do_not_matter(spark):
    rows = [(1, "a long common line", 1, 2, 3, 4), (2, "a long common line\nand more", 5, 6, 7, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, stamp int, lines int, gone int")
    out = linededup.line_dedup(df).orderBy("doc_id").collect()
    assert [tuple(r) for r in out] == [(1, "a long common line", 1, 2, 3, 4, 1, 0), (2, "and more", 5, 6, 7, 8, 2, 1)]


def test_filters_have_no_false_negatives():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    seen = blooms.Repeats()
    seen.meet(np.unique(h[:3000]), h[:10])
    seen.meet(np.unique(h[2000:]), h[:0])
    twice = seen.twice()
    assert twice.has(h[2000:3000]).all() and twice.has(h[:10]).all() and twice.has(h[3000:]).mean() < 0.05


@pytest.mark.parametrize("text, n", [("0123456789", 1), (" 012345678 ", 0), ("日" * 10, 1), ("日" * 9, 0)])
def test_key_length_counts_code_points(text, n):
    assert sum(bool(k) for k in linededup.line_keys(text.encode())) == n
