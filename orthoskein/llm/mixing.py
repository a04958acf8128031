"""Mixing of sources to target weights.

Token counts are summed per source, targets are filled by weight up to a cap,
and every document is emitted ``floor(rate)`` times plus one Bernoulli copy
whose probability is the fraction of its source's rate. The Bernoulli draw is a
hash of the document's id and a seed, so that reruns agree.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; rows with equal doc_id draw alike; a null doc_id draws as the
word ``null``; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stash

WORD = r"[^\x20\x09-\x0D]+"
WEIGHT_CYCLE = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2
#: A table of targets of at most this many rows (about 40 bytes each) is broadcast.
BROADCAST_SOURCES = 200_000
SALTS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def unit_hash(doc_id: Column, seed: str) -> Column:
    """Uniform in [0, 1): the first 48 bits of an MD5 of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_targets(
    sizes: DataFrame,
    cycle: tuple[int, ...] = WEIGHT_CYCLE,
    share: float = TOTAL_SHARE,
    cap: int = MAX_REPEATS,
) -> DataFrame:
    """One row per source of ``sizes(source, source_size)`` with its target.

    Refilling the excess by weight until no source is above ``cap`` times its
    size has one fixed point: with sources ordered by ``cap * size / weight``,
    a prefix is capped and the rest gets ``level * weight``. Running sums find
    that level without a loop. The windows run over sources, not documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (rank % len(cycle) + 1).cast("int"))
    ranked = sizes.withColumn("rank", rank).withColumn("weight", weight).withColumn("limit", F.col("source_size").cast("double") * cap)
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    every = Window.partitionBy()
    levelled = (
        ranked.withColumn("total", F.sum("source_size").over(every).cast("double") * share)
        .withColumn("before", F.sum("limit").over(fill) - F.col("limit"))
        .withColumn("left", F.sum("weight").over(every) - F.sum("weight").over(fill) + F.col("weight"))
        .withColumn("level", (F.col("total") - F.col("before")) / F.col("left"))
    )
    # The level belongs to the first source that it leaves under its limit.
    under = F.when(F.col("level") * F.col("weight") < F.col("limit"), F.col("level"))
    level = F.first(under, ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.coalesce(F.least(level * F.col("weight"), F.col("limit")), F.col("limit"))
    return levelled.select("source", "source_size", target.alias("target"))


def mixing_plan(docs: DataFrame, seed: str = "mix", **shares) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies, rate."""
    sized = stash(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = stash(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), **shares), "mix-targets")
    joined = _join_sources(sized, targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("rate")
    extra = (unit_hash(F.col("doc_id"), seed) < F.col("rate") - whole).cast("long")
    return joined.withColumn("rate", rate).withColumn("copies", (whole + extra).cast("long"))


def _join_sources(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Join on source, null safe: broadcast below a checked size, salted beyond."""
    keyed = targets.withColumnRenamed("source", "__s")
    if targets.count() <= BROADCAST_SOURCES:
        return sized.join(F.broadcast(keyed), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    salted = keyed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = sized.withColumn("__own", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    both = F.col("source").eqNullSafe(F.col("__s")) & (F.col("__own") == F.col("__salt"))
    return spread.join(salted, both).drop("__s", "__salt", "__own")


def mix(docs: DataFrame, seed: str = "mix", **shares) -> DataFrame:
    """Emit every document as often as its source's rate asks.

    The draw depends on source and id only, so it is made on the fly; texts are
    read twice and never shuffled unless the sources are too many to broadcast.
    """
    columns = docs.columns
    sized = docs.select(F.col("source"), word_count(F.col("text")).alias("size"))
    targets = stash(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), **shares), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = targets.select("source", rate.alias("__rate"))
    extra = (unit_hash(F.col("doc_id"), seed) < F.col("__rate") - F.floor("__rate")).cast("int")
    copies = (F.floor("__rate").cast("int") + extra).cast("int")
    return _join_sources(docs, rates).withColumn("__copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*columns)
