import random
import re
from collections import Counter

import numpy as np

from orthoskein.llm import neardup
from orthoskein.operators.components import components
from orthoskein.llm.textkernel import shingle_sets


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def set_of(text):
    w = words_of(text)
    return {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """Rows that share a doc_id are one node; each of its texts links by itself."""
    root = {i: i for i, _ in rows}
    sets = dict(enumerate(set_of(t) for _, t in rows))
    of = dict(enumerate(i for i, _ in rows))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in range(a + 1, len(sets)):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(of[a]), find(of[b])
                root[max(x, y)] = min(x, y)
    least = lambda a: find(of[a]) if sets[a] else of[a]
    return sorted((of[a], len(sets[a]), least(a), least(a) == of[a]) for a in sets)


def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7)))
    base = [[word() for _ in range(rng.randint(60, 200))] for _ in range(8)]
    rows = []
    for i in range(150):
        w = list(base[i % 8])
        for _ in range(rng.choice((0, 0, 1, 1, 2, 4, 9))):
            w[rng.randrange(len(w))] = word()
        rows.append((2 * i, " ".join(w)))
    rows += [(1001, None), (1003, ""), (1005, " \n\t"), (1007, "one two"), (1009, "One  TWO\n"), (1011, "two one"), (1013, "a b c d e"), (1015, "A b c d E ")]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 0, "k", 1) for i, t in rows], "doc_id long, text string, rep int, cls string, component_id int").repartition(4)
    assert sorted(tuple(r) for r in neardup.near_dedup(df).collect()) == brute(rows)


def variants(seed=3, size=420):
    """A large group around two versions of one text; most pairs have a similarity of 0.6 to 0.9."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(4, 8)))
    base = [word() for _ in range(150)]
    other = list(base)
    for at in (20, 60, 100, 140):
        other[at] = word()
    pool = [(rng.randrange(150), word()) for _ in range(40)]  # edits that several texts share
    rows = []
    for i in range(size):
        w = list(rng.choice((base, other)))
        for _ in range(rng.choice((1, 2, 2, 3, 3, 4, 5))):
            at, new = rng.choice(pool) if rng.random() < 0.5 else (rng.randrange(150), word())
            w[at] = new
        rows.append((i, " ".join(w)))
    return rows


def test_large_group_of_middling_similarity(spark):
    rows = variants()
    want = brute(rows)
    sizes = sorted(Counter(r[2] for r in want).values())
    assert sizes[-1] > 100 and sizes.count(1) > 50  # one large component and many texts beside it
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in neardup.near_dedup(df).collect()) == want


def test_texts_that_share_a_doc_id(spark):
    rng = random.Random(5)
    texts = [" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(100)) for x in "abcd"]
    rows = [(5, texts[0]), (5, texts[1]), (7, texts[1] + " more"), (9, texts[2]), (8, texts[0]), (3, texts[3]), (9, texts[3] + " end"), (9, ""), (4, None)]
    out = neardup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(tuple(r) for r in out) == brute(rows)
    assert {r.doc_id: r.component_id for r in out if r.n_shingles} == {5: 5, 7: 5, 8: 5, 9: 3, 3: 3}


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(2)
    for differ in (0, 3, 40, 900):
        x = np.unique(rng.integers(0, 1 << 62, 3000, dtype=np.uint64))
        y = np.unique(np.append(x[differ:], rng.integers(0, 1 << 62, differ, dtype=np.uint64)))
        apart = sum(int(v).bit_count() for v in (neardup.parities(x) ^ neardup.parities(y)).view(np.uint64))
        assert apart <= len(np.setxor1d(x, y)) and (differ > 3 or apart > 0 or not differ)


def test_words_of_regular_structure_differ():
    """Words that collide under any polynomial hash modulo 2**64."""
    a = b"a"
    while len(a) < 2048:
        a += a.translate(bytes.maketrans(b"ab", b"ba"))
    b = a.translate(bytes.maketrans(b"ab", b"ba"))
    x, y = shingle_sets([a, b])
    assert len(x) == len(y) == 1 and x[0] != y[0]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_dedup(empty).collect() == []
    rows = [(None, "some words that are long enough"), (1, "some words that are long enough"), (1, "some words that are long enough")]
    out = sorted((tuple(r) for r in neardup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert out == [(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True)]


def test_signatures_agree_as_often_as_sets():
    rng = np.random.default_rng(0)
    agree = []
    for _ in range(300):
        x = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
        y = np.concatenate([x[:180], rng.integers(0, 1 << 62, 20, dtype=np.uint64)])
        s = neardup.signatures([x, y])
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - (180 / 220) ** neardup.PER_GROUP) < 0.03


def test_blocks_of_long_texts_change_nothing(monkeypatch):
    from orthoskein.llm import textkernel

    text = (" ".join(f"w{i}" for i in range(5000))).encode()
    whole = list(shingle_sets([text, b"a b"]))
    monkeypatch.setattr(textkernel, "BLOCK", 500)
    parts = list(shingle_sets([text, b"a b"]))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}}
