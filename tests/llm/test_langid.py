import random

import numpy as np

from orthoskein.llm import langid

WORDS = {
    "en": "the of and to in that was with for which ing tion th wh ou ough".split(),
    "de": "der die und nicht sch ein mit auf für über ung keit lich zu".split(),
    "fr": "le la les des est que pour dans eau eux oi é ç une vous".split(),
    "es": "el los que de para ción ñ por una su osa ado mente ll".split(),
}


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = sorted(WORDS)[i % 4]
        rows.append((i, " ".join(rng.choice(WORDS[lang]) + rng.choice(["", rng.choice(WORDS[lang])]) for _ in range(rng.randint(8, 60))), lang))
    return rows


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = langid.identify(df, langid.fit(df), ["doc_id", "lang"])
    return {r.doc_id: r for r in out.withColumn("held_out", langid.held_out(out.doc_id)).collect()}


def test_held_out_accuracy(spark):
    out = run(spark, corpus(800))
    held = [r for r in out.values() if r.held_out]
    assert len(held) > 200
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out.values())


def test_edges(spark):
    rows = corpus(60) + [(1000, None, "en"), (1001, "", None), (1002, "12 34 --- 5", "en"), (1003, "the and of " * 50_000, None), (None, "der die und", "xx")]
    out = run(spark, rows)
    assert [out[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert out[1000].score == 0
    assert out[1003].lang_pred == "en"
    assert out[None].held_out is False and out[None].lang_pred != "xx"


def test_nothing_to_learn(spark):
    assert {r.lang_pred for r in run(spark, [(1, "some words", None), (2, None, None)]).values()} == {"und"}
    assert run(spark, []) == {}
    assert {r.lang_pred for r in run(spark, [(i, "some words", "en") for i in range(9)]).values()} == {"en"}


def test_scores_do_not_depend_on_neighbours():
    x = langid.frequencies([b"abc def", b"ghi"])
    y = np.concatenate([langid.frequencies([b"abc def"]), langid.frequencies([b"zzz", b"ghi"])[1:]])
    assert np.array_equal(x, y)


def test_kept_columns_may_have_any_name(spark):
    rows = [(*r, 7, "x", 1, True) for r in corpus(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, lang_pred string, row int, lettered boolean")
    out = langid.identify(df, langid.fit(df), df.columns)
    assert out.columns == ["doc_id", "text", "lang", "row", "lettered", "lang_pred", "score"]
    got = out.collect()
    assert {(r.row, r.lettered) for r in got} == {(1, True)} and {r.lang_pred for r in got} <= set(WORDS)


def test_repeated_rows_are_drawn_once(spark):
    rows = corpus(200) + [(4, corpus(200)[4][1], corpus(200)[4][2])] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    out = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(df, langid.fit(df), ["doc_id"]).collect()}
    assert len(out) == 200


def test_every_language_is_learned(spark):
    """More languages than the table of families knows, each with its own letters."""
    rng, rows = random.Random(3), []
    names = [f"x{k:02d}" for k in range(66)]
    words = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(12)] for n in names}
    for i in range(66 * 24):
        rows.append((i, " ".join(rng.choice(words[names[i % 66]]) for _ in range(40)), names[i % 66]))
    out = run(spark, rows)
    held = [r for r in out.values() if r.held_out]
    assert {r.lang_pred for r in held} == set(names)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
