"""Corpus pipeline: five stages over ``documents``, each written and read again.

Odd rows: null texts, empty texts and texts without a letter go in the first
stage. Rows without doc_id take part: they lose no lines, link with nothing,
and are mixed and encoded as others are. Of repeated rows (equal doc_id and
text) near-dedup keeps one. A document that loses all its lines stays, empty,
until the mix, which takes no words from it. Texts of any length are whole;
columns beyond those of documents are not carried; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orthoskein.llm import langid, linededup, mixing, neardup, sentencepiece
from orthoskein.scratch import new_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language; ``lang`` becomes the language found in the text.

    Null texts and texts without a letter have none. Labels that were missing or
    wrong thus do not reach the mix and the tokens. Where there is nothing to
    learn from, all texts with a letter stay as they are.
    """
    machines = langid.fit(docs)
    if machines is None:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    found = langid.identify(docs, machines, COLUMNS).where(F.col("lang_pred") != langid.UNDETERMINED)
    return found.select(*(F.col("lang_pred").alias(c) if c == "lang" else F.col(c) for c in COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated lines; documents that lose lines get a new n_chars."""
    out = linededup.line_dedup(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near-duplicates, and one of repeated rows.

    Rows are repeated if doc_id and text are equal, null ids and null texts
    included; the least by the other columns stays. Different texts under one id
    stay, and so does a row without doc_id beside an equal text that has one.
    """
    gone = neardup.near_dedup(docs).where(~F.col("kept")).select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    same = Window.partitionBy("doc_id", "digest").orderBy("lang", "source", "n_chars")
    return left.withColumn("place", F.row_number().over(same)).where("place = 1").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emit each document as often as the target of its source asks."""
    return mixing.mix(docs.select(*COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that the mix takes."""
    out = sentencepiece.encode(docs, ["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source", F.size("tokens").cast("long").alias("n_tokens"), "tokens", "exact")


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("SentencePiece", tokenize),
]

#: Language machines and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        path = new_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
