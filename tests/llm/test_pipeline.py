import random

from pyspark.sql import functions as F

import corpus_pipeline


def corpus(spark):
    rng = random.Random(1)
    words = {"en": "the of and to in that was with for which".split(), "fr": "le la les des est que pour dans eau une".split()}
    rows = []
    for i in range(120):
        lang = ("en", "fr")[i % 2]
        text = "\n".join(" ".join(rng.choice(words[lang]) + rng.choice(["", "ra", "ti", "on"]) for _ in range(12)) for _ in range(4))
        rows.append((i, text, lang, f"s{i % 3}", len(text), "extra"))
    copy = rows[5][1]
    rows += [(500, copy, "fr", "s1", len(copy), "x"), (501, copy.replace("\n", " \n"), "fr", "s1", len(copy) + 3, "x")]
    rows += [(600, None, "en", "s0", 0, "x"), (601, "123 456", "en", "s0", 7, "x"), (602, "", None, None, 0, "x"), (603, "a word", "en", None, 6, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, tokens string")


def test_stages_and_run(spark, tmp_path):
    docs = corpus(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = docs
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == corpus_pipeline.COLUMNS, name
        path = str(tmp_path / name.replace(" ", "-"))
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
        counts.append(kept.count())
    assert counts[0] == docs.count() - 3  # without a letter
    lines = spark.read.parquet(str(tmp_path / "line-dedup")).where("doc_id in (500, 501)").collect()
    assert all(r.text == "" and r.n_chars == 0 for r in lines)
    near = {r.doc_id for r in spark.read.parquet(str(tmp_path / "MinHash-near-dedup")).collect()}
    assert {5, 603} <= near and not {600, 601, 602} & near
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in kept.collect())
    assert all(r.exact and r.n_tokens == len(r.tokens) for r in out)


def test_empty_table(spark, tmp_path):
    corpus(spark).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_language_is_the_predicted_one(spark):
    """Documents without a letter go; a missing label and a wrong one (of a held-out document) are replaced."""
    docs = corpus(spark).withColumn("lang", F.expr("CASE WHEN doc_id = 15 THEN 'en' WHEN doc_id = 8 THEN NULL ELSE lang END"))
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept.keys() == {r.doc_id for r in docs.where(r"text rlike '\\p{L}'").collect()}
    assert kept[15] == "fr" and kept[8] == "en" and set(kept.values()) == {"en", "fr"}
    unlabelled = corpus_pipeline.language_id(spark, docs.withColumn("lang", F.lit(None).cast("string")), "")
    assert {r.doc_id for r in unlabelled.collect()} == kept.keys()


def test_one_of_repeated_rows_stays(spark):
    long, other = "some words that are long enough to be compared", "quite different words under the very same id as before"
    rows = [(1, long, "en", "s1"), (1, long, "en", "s0"), (1, long, "en", "s0"), (1, other, "en", "s0"), (2, long, "en", "s0"), (3, "", "en", "s0"), (3, "", "en", "s0"), (4, "", "en", "s0")]
    rows += [(None, long, "en", "s0"), (None, long, "en", "s0"), (None, other, None, "s0"), (5, None, "en", "s0"), (5, None, "en", "s0")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = sorted((tuple(r)[:4] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()), key=str)
    want = [(1, long, "en", "s0"), (1, other, "en", "s0"), (3, "", "en", "s0"), (4, "", "en", "s0"), (None, long, "en", "s0"), (None, other, None, "s0"), (5, None, "en", "s0")]
    assert got == sorted(want, key=str)


def test_long_texts_and_ties(spark, tmp_path):
    """A text of a megabyte goes through whole; equal texts of several sources leave one document."""
    line = lambda i: f"sentence number {i} of the long text that has its own words w{i * 7} and x{i * 13}"
    long = "\n".join(line(i) for i in range(14_000))
    rows = [(1, long, "en", "a", len(long)), (2, "the of and to in that " * 40, "en", "b", 9), (3, "the of and to in that " * 40, "en", "c", 9), (4, "und der die das nicht ein " * 30, "de", None, 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    near = corpus_pipeline.near_dedup(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), "")
    assert sorted(r.doc_id for r in near.collect()) == [1, 2, 4]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r.exact for r in out) and max((r.n_tokens for r in out if r.doc_id == 1), default=0) > 100_000
