import hashlib
import re

import pytest

from orthoskein.llm import pii

RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
)


def luhn(s):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0


def brute(text):
    found = []
    for rank, (kind, pattern, holds) in enumerate(RULES):
        for m in re.finditer(pattern, text or ""):
            if holds(m[0]):
                found.append((m.start(), rank, m.end(), kind))
    found.sort()
    return [sum(f[3] == k for f in found) for k, _, _ in RULES], ",".join(f"{k}:{s}:{e}" for s, _, e, k in found)


PLAIN = [
    None,
    "",
    "nothing to see here, 12 of 34 and 2024-01-05 at 10:30:15, version 1.2.3, order 1234567",
    "mail a.b%c@x-y.example.com, a@b, x@y.zz.q@r.st+1@2.3 end",
    "10.20.30.40 and 256.1.1.1 1.2.3.4.5.6.7.8 000255.0.0.01 99999999999999999999.1.1.1",
    "4539 1488 0343 6467 4539148803436467 4539-1488-0343-6468 1 2 3 4 5 6 7 8 9 0 1 2 3",
    "+1 (555) 010-9999 ++49 30 1234567 +1 2 +123456789012345678 +44.20.7946.0958-",
    "é😀 a@b.co 😀 +1 (555) 010-9999",
    "7" * 30_000 + " " + "1 " * 30_000 + "a" * 60_000 + "@" + "+1" * 20_000 + "1." * 20_000 + "a@b.c" * 5000,
    "192.168.0.1 " * 3000,
]


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: r for r in pii.detect(df).collect()}


def test_base_matches_brute_force(spark):
    out = run(spark, PLAIN)
    assert len(out) == len(PLAIN)
    for i, text in enumerate(PLAIN):
        counts, listed = brute(text)
        r = out[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
    assert all(out[i].spans == "" for i in range(3))


@pytest.mark.parametrize(
    "text, want",
    [
        ("call me at (555) 123-4567 today", "phone:11:25"),
        ("contact: john.doe [at] mail [dot] com now", "email:9:37"),
        ("card 4539.1488.0343.6467 please", "card:5:24"),
        ("host 192[.]168[.]10[.]20 is down", "ip:5:24"),
    ],
)
def test_added_spans(spark, text, want):
    assert run(spark, [text])[0].spans == want


def test_rows_stay_apart_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a@b.co"), (1, "a@b.co"), (None, "a@b.co")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.spans) for r in pii.detect(df).collect()) == [("1", "email:0:6")] * 2 + [("None", "email:0:6")]
    assert pii.detect(df.limit(0)).collect() == []


def test_no_python_on_the_main_path(spark):
    docs = spark.sql("SELECT 1L AS doc_id, 'x' AS text")
    plan = pii.detect(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize(
    "text, want",
    [
        ("call 555-123-4567 555-987-6543 now", "phone:5:17,phone:18:30"),
        ("room 4411 (555) 123-4567 today", "phone:10:24"),
        ("+1 555 010 9999 555-987-6543", "phone:3:15,phone:16:28"),
        ("numbers (555) 123-4567, (555) 987-6543, 555-222-3333", "phone:8:22,phone:24:38,phone:40:52"),
    ],
)
def test_numbers_beside_numbers(spark, text, want):
    assert run(spark, [text])[0].spans == want


@pytest.mark.parametrize("text, want", [("write to john [AT] example [DOT] com", "email:9:36"), ("please call 5551234567", "phone:12:22")])
def test_plain_variants(spark, text, want):
    assert run(spark, [text])[0].spans == want


def test_selection_takes_all_that_do_not_overlap_better_ones(spark):
    rows = [(0, 10, 1.0), (8, 20, 3.0), (18, 30, 2.0), (19, 22, 0.5), (28, 40, 1.0)]
    df = spark.createDataFrame([(-w, a - b, a, 4, b, "phone") for a, b, w in rows], "worse double, shorter int, start int, rank int, stop int, kind string")
    out = df.groupBy().agg(pii.F.collect_list(pii.F.struct("*")).alias("a")).select(pii._greedy(pii.F.col("a"))).first()[0]
    assert sorted((s.start, s.stop) for s in out) == [(8, 20), (28, 40)]
