import hashlib
import random

import numpy as np
import pytest

from orthoskein.llm import sufdedup


def brute(rows):
    """By a table of all strings of LENGTH bytes, in order."""
    seen, out = {}, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for a in range(len(raw) - sufdedup.LENGTH + 1) if i is not None else ():
            s = raw[a : a + sufdedup.LENGTH]
            if seen.setdefault(s, (i, a)) < (i, a):
                gone[a : a + sufdedup.LENGTH] = [True] * sufdedup.LENGTH
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(n=60, seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeiou rstnlé") for _ in range(rng.randint(2, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(40) for _ in range(5)]
    rows = []
    for i in range(n):
        text = prose(rng.randint(1, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, 30)
            text += p[a : a + rng.randint(60, 200)] + prose(rng.randint(0, 20))
        rows.append((3 * i, text))
    rows += [(1, rows[7][1]), (500, rows[7][1]), (501, rows[8][1][:150] + "x" + rows[8][1][150:])]
    return rows


ODD = [(900, None), (901, ""), (902, "a" * 99), (903, "a" * 450), (904, "a" * 300 + "b"), (905, "ab" * 200), (906, "c" * 100), (907, "c" * 100), (908, "=-" * 100 + "z")]


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted((tuple(r)[:5] for r in sufdedup.suffix_dedup(df).collect()), key=lambda r: (r[0] is None, r[0] or 0))


@pytest.mark.parametrize("rows", [corpus() + ODD + [(None, "c" * 100)], [], ODD[:2], ODD[3:4]])
def test_matches_brute_force(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_are_one_document(spark):
    text = corpus()[2][1] + "tail " * 60
    out = run(spark, [(5, text), (5, text)])
    assert out[0] == out[1] == brute([(5, text)])[0]


def test_texts_that_share_a_doc_id(spark):
    """Spans stay with the text in which they were found."""
    prose = [t for _, t in corpus(80) if len(t) > 150]
    rows = [(1, prose[0]), (5, prose[0] + " x"), (5, prose[1] + prose[2]), (5, prose[3])]
    out = run(spark, rows)
    assert sorted(r[2] for r in out) == sorted(r[2] for r in brute([(1, prose[0]), (5, prose[0] + " x"), (6, prose[1] + prose[2]), (7, prose[3])]))


def test_many_small_shards_and_bins(spark, monkeypatch):
    rows = corpus(40) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        monkeypatch.setattr(sufdedup, "BIN_BYTES", 64)
        spans = sufdedup.suffix_dedup(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(tuple(r)[:5] for r in spans) == sorted(brute(rows))


def test_long_text_is_cut_into_pieces_without_loss(spark, monkeypatch):
    rows = [(1, "x" + corpus(40)[5][1] * 3), (2, corpus(40)[6][1] + corpus(40)[5][1] * 2)]
    want = {}
    for piece in (1 << 20, 130):
        monkeypatch.setattr(sufdedup, "PIECE", piece)
        got = set()
        for *_, owner, start, size in sufdedup.segments([t.encode() for _, t in rows]):
            for o, s, n in zip(owner.tolist(), start.tolist(), size.tolist()):
                got |= {(o, s + k) for k in range(n - sufdedup.LENGTH + 1)}
        want.setdefault("windows", got)
        assert got == want["windows"] == {(i, a) for i, (_, t) in enumerate(rows) for a in range(len(t.encode()) - 99)}


def test_disk_gives_the_same(monkeypatch):
    parts = [t.encode() for _, t in corpus(30) if len(t) > 120]
    doc, start = np.arange(len(parts)), np.zeros(len(parts), np.int64)
    a, b = (sorted(zip(*(np.concatenate(x).tolist() for x in zip(*sufdedup.repeated_windows(parts, doc, start, limit))))) for limit in (10**7, 300))
    assert a == b and a
