"""MinHash near-duplicates with tensored banding and exact verification.

Two small collections of minhash groups are computed per text; every pair (one
group of each) is the key of one table, so that 121 tables of six minhashes
cost 66 minhashes instead of 726. Texts with equal shingle sets are one class.

A bucket is not expanded into pairs. Its most central class is its pivot, and
every member meets the pivot alone (a row a member). Classes that link with the
pivot are connected. Any other pair of the bucket is decided by differences to
the pivot: if A does not link with it, A and B can only link when they share
at least ``need`` elements of their differences. Elements that no other
difference of that pivot holds count for nothing, so most classes are settled
by counting. The rest meet by the rarest of their shared elements (a prefix
filter), first with one class a bucket of that kind, then with all that are
not connected yet, where the counts of shared elements and bitmaps of the sets
(a lower bound of their difference) still allow a link. So every pair that
shares a table is tested, already connected, or cannot link.

A pair at similarity 0.85 shares a table with probability 0.99994, one at 0.9
with 0.999999; at 0.3 it is 0.07. Links are confirmed on the full sets of 64-bit
shingle hashes, which sum one code for each byte and place of a word.

Defined results: null, empty or blank texts have empty sets and are linked with
nothing; rows without doc_id are linked with nothing and have no component;
rows that share a doc_id share a component, also where their texts differ (then
each text links by itself); columns other than doc_id and text are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..scratch import stash, unstash
from .textkernel import U, mix, parts, shingle_sets

WIDTH = 5
GROUPS = 11
PER_GROUP = 3
PERCENT = 85
#: 64-bit words of a set's bitmap.
SKETCH = 8


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), 2 * GROUPS) group hashes; empty sets must be left out."""
    out = np.zeros((len(sets), 2 * GROUPS), np.uint64)
    if not sets:
        return out
    values, at = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    seeds = mix(np.arange(1, 2 * GROUPS * PER_GROUP + 1, dtype=np.uint64) * U(0xA0761D6478BD642F))
    for g in range(2 * GROUPS):
        for k in range(PER_GROUP):
            seed = seeds[g * PER_GROUP + k]
            low = np.minimum.reduceat((values ^ seed) * (seed | U(1)) >> U(16), at)
            out[:, g] = mix(out[:, g] + low + U(g + 1))
    return out


def _class(items: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(items.tobytes())


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in parts(batch):
            sets = list(shingle_sets(texts, WIDTH))
            keys = np.zeros((len(texts), 2 * GROUPS), np.uint64)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys[full] = signatures([sets[i] for i in full])
            flat = pa.array(keys.view(np.int64).reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(texts) * 2 * GROUPS + 1, 2 * GROUPS, dtype=np.int32)), flat)
            columns = [part.column("doc_id"), pa.array([_class(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "cls", "n", "keys"])


def parities(items: np.ndarray) -> np.ndarray:
    """Bitmap of SKETCH words: whether an odd number of items fall on each bit.

    Two sets differ in at least as many items as their bitmaps differ in bits.
    """
    odd = np.bincount((items & U(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets by class, with their bitmaps; one row for equal sets of a part of a batch."""
    for batch in batches:
        for _, texts in parts(batch):
            found = {_class(s): s for s in shingle_sets(texts, WIDTH)}
            columns = [pa.array([f(s) for s in found.values()], pa.list_(pa.int64())) for f in (lambda s: s.view(np.int64), parities)]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), *columns], names=["cls", "items", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, cls (digest of the shingle set), n (its size), keys (group hashes)."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprint, "doc_id long, cls binary, n long, keys array<long>")


def _shared(rows: DataFrame) -> DataFrame:
    """(cls, heads, w) from ``rows(cls, k)``: the keys that another class has too, and how often they occur."""
    often = rows.groupBy("k").agg(F.count("*").alias("c")).where("c > 1")
    return rows.join(often, "k").groupBy("cls").agg(F.sum("c").alias("w"), F.collect_list("k").alias("ks"))


def pivot_pairs(classes: DataFrame) -> DataFrame:
    """(cls, pivot) of every member of every table bucket with two members or more.

    The pivot is the member whose first groups are shared most often. A bucket
    can only have two members if both groups of its key have, so groups that
    one class alone holds are left out before they are combined.
    """
    keys = classes.select("cls", "keys")
    half = keys.select("cls", F.posexplode(F.slice("keys", 1, GROUPS)).alias("i", "k"))
    heads = stash(_shared(half.select("cls", F.xxhash64("i", "k").alias("k"))), "nd-heads")
    other = keys.join(heads.select("cls"), "cls", "left_semi").select("cls", F.posexplode(F.slice("keys", GROUPS + 1, GROUPS)).alias("i", "k"))
    tails = _shared(other.select("cls", F.xxhash64("i", "k").alias("k")))
    both = heads.join(tails.select("cls", F.col("ks").alias("ts")), "cls")
    tables = both.select("cls", "w", "ts", F.explode("ks").alias("k")).select("cls", "w", "k", F.explode("ts").alias("t"))
    paired = stash(tables.select(F.xxhash64("k", "t").alias("key"), "cls", "w"), "nd-paired")
    top = paired.groupBy("key").agg(F.count("*").alias("c"), F.max(F.struct("w", "cls")).alias("top")).where("c > 1").select("key", F.col("top.cls").alias("pivot"))
    pairs = stash(paired.join(top, "key").where("cls <> pivot").select("cls", "pivot").distinct(), "nd-pairs")
    unstash(heads)
    unstash(paired)
    return pairs


def _class_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cls, items) of every class of ``pairs``, from the texts of its least doc_id."""
    wanted = pairs.select("cls").unionByName(pairs.select(F.col("pivot").alias("cls"))).distinct()
    wanted = classes.select("cls", F.col("rep").alias("doc_id")).join(wanted, "cls", "left_semi")
    texts = docs.select("doc_id", "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = texts.select("text").mapInArrow(_sets, "cls binary, items array<long>, bits array<long>").join(wanted.select("cls"), "cls", "left_semi")
    return stash(sets.groupBy("cls").agg(F.first("items").alias("items"), F.first("bits").alias("bits")), "nd-sets")


def _met(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs(cls, pivot)`` with both sets' sizes, the class's bitmap and what only one set holds."""
    left = pairs.join(sets.withColumnRenamed("items", "x"), "cls")
    both = left.join(sets.select(F.col("cls").alias("pivot"), F.col("items").alias("y")), "pivot")
    parts = both.select("cls", "pivot", "bits", F.size("x").alias("n"), F.size("y").alias("m"), F.array_except("x", "y").alias("a"), F.array_except("y", "x").alias("b"))
    return parts.select("cls", "pivot", "bits", "n", "m", F.concat("a", "b").alias("diff"))


def _links(percent: int):
    """100 * intersection >= percent * union, by sizes n, m and the size of the difference."""
    return F.lit(100 + percent) * F.size("diff") <= F.lit(100 - percent) * (F.col("n") + F.col("m"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    return _met(pairs, sets).where(_links(percent)).select("cls", "pivot")


def _open_differences(tested: DataFrame, percent: int) -> DataFrame:
    """Per class and pivot of a star that is not settled: its shared elements, rarest first.

    ``need`` is the least number of shared elements with which the class can link
    with anything of the star but the pivot; classes with fewer are left out.
    """
    star = tested.groupBy("pivot").agg(F.count("*").alias("c"), F.count_if(~F.col("linked")).alias("outer")).where("c > 1 and outer > 0").select("pivot")
    rows = tested.join(star, "pivot")
    each = rows.select("pivot", "cls", F.explode("diff").alias("e"))
    often = each.groupBy("pivot", "e").agg(F.count("*").alias("f")).where("f > 1")
    own = each.join(often, ["pivot", "e"]).groupBy("pivot", "cls").agg(F.sort_array(F.collect_list(F.struct("f", "e"))).alias("own"))
    d = F.size("diff")
    least = F.ceil((F.lit(100 + percent) * d - F.lit(100 - percent) * (F.col("n") + F.col("m"))) / 200)
    judged = rows.select("pivot", "cls", "bits", "n", "linked", d.alias("d"), least.alias("need")).join(own, ["pivot", "cls"])
    return judged.withColumn("c", F.size("own")).where("linked or need <= c")


def _meetings(judged: DataFrame, what: list[str]) -> tuple[DataFrame, DataFrame]:
    """Classes outside a pivot by the rarest shared elements of which one must meet, and all by each element.

    ``left`` is the number of a class's shared elements from that one on.
    """
    outer = judged.where("not linked").select("pivot", "c", F.posexplode(F.expr("slice(own, 1, c - need + 1)")).alias("at", "e"), *what)
    every = judged.select("pivot", "c", "linked", F.posexplode("own").alias("at", "e"), *what)
    outer = outer.select("pivot", F.col("e.e").alias("e"), (F.col("c") - F.col("at")).alias("left"), *what)
    return outer, every.select("pivot", F.col("e.e").alias("e"), "linked", (F.col("c") - F.col("at")).alias("left2"), *(F.col(c).alias(c + "2") for c in what))


def _may_link(percent: int):
    """Whether counts and bitmaps allow a link of two classes whose first common element is the one they meet by.

    Elements are in one order for all, so no more than ``left`` can be common.
    """
    sizes = F.lit(100 - percent) * (F.col("n") + F.col("n2"))
    need = F.lit(100 + percent) * (F.col("d") + F.col("d2")) - sizes
    apart = sum((F.bit_count(F.get("bits", i).bitwiseXOR(F.get("bits2", i))) for i in range(1, SKETCH)), F.bit_count(F.get("bits", 0).bitwiseXOR(F.get("bits2", 0))))
    return (F.col("cls") != F.col("cls2")) & (need <= F.lit(2 * (100 + percent)) * F.least("left", "left2")) & (F.lit(100 + percent) * apart <= sizes)


def near_links(docs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): least doc_ids of classes such that links connect the classes as all links would."""
    pairs = pivot_pairs(classes)
    sets = _class_sets(docs, classes, pairs)
    reps = classes.select("cls", "rep")

    def named(found: DataFrame) -> DataFrame:
        pivots = reps.select(F.col("cls").alias("pivot"), F.col("rep").alias("b"))
        return found.join(reps.withColumnRenamed("rep", "a"), "cls").join(pivots, "pivot").select("a", "b")

    tested = stash(_met(pairs, sets).withColumn("linked", _links(percent)), "nd-tested")
    judged = stash(_open_differences(tested, percent), "nd-judged")
    links = named(tested.where("linked").select("cls", "pivot"))
    if judged.where("not linked").isEmpty():
        return links
    # One class a shared element first: it connects what belongs to the same text that is not the pivot.
    what = ["cls", "n", "d", "bits"]
    outer, every = _meetings(judged, what)
    head = outer.groupBy("pivot", "e").agg(F.min(F.struct("d", "cls", "n", "left", "bits")).alias("h")).select("pivot", "e", "h.*")
    second = head.join(every, ["pivot", "e"]).where(_may_link(percent)).select("cls", F.col("cls2").alias("pivot")).distinct()
    links = stash(links.unionByName(named(_confirmed(second, sets, percent))), "nd-links")
    group = components(links)
    labels = reps.join(judged.select("cls").distinct(), "cls", "left_semi").join(group, F.col("rep") == F.col("node"), "left")
    labels = labels.select("cls", F.coalesce("component", "rep").alias("g"))
    outer, every = _meetings(judged.join(labels, "cls"), [*what, "g"])
    third = outer.join(every, ["pivot", "e"]).where((F.col("g") != F.col("g2")) & (F.col("linked") | (F.col("cls") < F.col("cls2"))) & _may_link(percent))
    third = third.select("cls", F.col("cls2").alias("pivot")).distinct()
    return links.unionByName(named(_confirmed(third, sets, percent)))


def near_components(docs: DataFrame, percent: int = PERCENT, prints: DataFrame | None = None) -> DataFrame:
    """(cls, component) of every class of equal sets; component is its least doc_id."""
    prints = stash(fingerprints(docs), "nd-prints") if prints is None else prints
    known = prints.where("n > 0 and doc_id is not null")
    classes = stash(known.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys")), "nd-classes")
    links = near_links(docs, classes, percent)
    # A doc_id with several texts connects their classes.
    several = known.groupBy("doc_id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("doc_id")
    same = known.join(several, "doc_id", "left_semi").select("doc_id", "cls").distinct().join(classes.select("cls", "rep"), "cls")
    merged = components(links.unionByName(same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    return classes.select("cls", "rep").join(merged, F.col("rep") == F.col("node"), "left").select("cls", F.coalesce("component", "rep").alias("component"))


def near_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    prints = stash(fingerprints(docs), "nd-prints")
    found = near_components(docs, percent, prints)
    joined = prints.select("doc_id", "cls", "n").join(found, "cls", "left")
    root = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    root = F.when(F.col("doc_id").isNotNull(), root)
    return joined.select("doc_id", F.col("n").alias("n_shingles"), root.alias("component_id"), F.coalesce(F.col("doc_id") == root, F.lit(True)).alias("kept"))
