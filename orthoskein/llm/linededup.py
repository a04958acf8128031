"""Line deduplication with two Bloom filters.

Every line's digest travels, packed by part of a batch and by shard of its hash, with the
place of the line. A shard streams the hashes through a once-seen filter; those
met again form its twice-seen filter, which is sized to them. Only the places
whose hash that filter holds go on: an exact group-by on the digest confirms
them and chooses the first document. Filters have no false negatives and stay
in their task; false positives end in the group-by. A line that a part holds in
several documents needs no answer: its places go on at once, spread over the
shards, and its hash is sent to its own shard once a part, so a line of any
frequency costs a shard little.

The digest is 128 bits of BLAKE2b over the whole key and stands for it.

Defined results: a null or empty text is one empty line; rows that share a
doc_id are one document; rows without doc_id neither claim nor lose lines;
a document whose lines all go keeps an empty text; other columns are kept, of
any name, but for those named n_lines or n_dropped, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import input_bytes, shuffle_width, stash
from . import blooms
from .textkernel import parts

MIN_KEY = 10
SPACE = b" \t\n\x0b\x0c\r"
#: Input bytes (compressed) for each shard; the number of shards grows with the input.
SHARD_BYTES = 16 << 20
PLACE = np.dtype([("h", "u8"), ("g", "u8"), ("doc", "i8"), ("stamp", "i8"), ("line", "i4")])


def line_keys(text: bytes | None) -> list[bytes]:
    """Keys of all lines; empty where a key is shorter than MIN_KEY code points."""
    keys = [x.strip(SPACE) for x in (text or b"").lower().split(b"\n")]
    return [k if len(k) >= 4 * MIN_KEY or len(k) >= MIN_KEY and len(k.decode("utf-8", "replace")) >= MIN_KEY else b"" for k in keys]


def _places(batch: pa.RecordBatch, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Digest and place of every line with a key, and the row of each."""
    digests, owners, lines = [], [], []
    for i, t in enumerate(texts):
        keys = line_keys(t)
        at = [j for j, k in enumerate(keys) if k]
        digests += [blake2b(keys[j], digest_size=16).digest() for j in at]
        owners += [i] * len(at)
        lines += at
    out, owner = np.zeros(len(lines), PLACE), np.array(owners, np.int64)
    pairs = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    out["h"], out["g"], out["line"] = pairs[:, 0], pairs[:, 1], lines
    out["doc"], out["stamp"] = np.asarray(batch.column("doc_id"))[owner], np.asarray(batch.column("stamp"))[owner]
    return out, owner


def _ask(shards: int):
    """Rows by shard: places that need an answer, hashes met here once or again, and places that need none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (x for batch in batches for x in parts(batch)):
            places, owner = _places(part, texts)
            order = np.argsort(places["h"], kind="stable")
            places, owner = places[order], owner[order]
            keys, at, of = np.unique(places["h"], return_index=True, return_inverse=True)
            count = np.diff(np.append(at, len(places)))
            # Rows of one hash are in order of their document here: the sort is stable.
            several = owner[np.append(at[1:], len(places)) - 1] != owner[at] if len(at) else np.zeros(0, bool)
            alone = count == 1
            asked, told = places[alone[of]], places[~alone[of]]
            rows: dict[int, list] = {}
            for what, h in ((0, asked["h"]), (1, keys[~alone]), (2, keys[several])):
                for s, some in blooms.by_shard(h, shards):
                    rows.setdefault(s, [b""] * 4)[what] = (asked[some] if what == 0 else h[some]).tobytes()
            spread = blooms.shard_of(told["doc"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), shards)
            for s in np.unique(spread).tolist():
                rows.setdefault(s, [b""] * 4)[3] = told[spread == s].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), *(pa.array([r[k] for r in rows.values()], pa.binary()) for k in range(4))], names=["shard", "asked", "met", "again", "told"])

    return run


def _given(places: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(places), 1 << 16):
        part = places[a : a + (1 << 16)]
        key = np.stack([part["h"], part["g"]], axis=1).tobytes()
        column = [pa.array(part["doc"]), pa.array(part["stamp"]), pa.array(part["line"]), pa.array([key[16 * i : 16 * i + 16] for i in range(len(part))], pa.binary())]
        yield pa.RecordBatch.from_arrays(column, names=["doc_id", "stamp", "line", "key"])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of suspected lines of one shard."""
    held: dict[int, list[np.ndarray]] = {}
    filters: dict[int, blooms.Repeats] = {}
    for batch in batches:
        for shard, asked, met, again, told in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield from _given(np.frombuffer(told, PLACE))
            places = np.frombuffer(asked, PLACE)
            hashes = np.unique(np.concatenate([places["h"], np.frombuffer(met, np.uint64)]))
            filters.setdefault(shard, blooms.Repeats()).meet(hashes, np.frombuffer(again, np.uint64))
            held.setdefault(shard, []).append(places)
    for shard, parts in held.items():
        twice = filters.pop(shard).twice()
        for places in parts:
            yield from _given(places[twice.has(places["h"])])


def suspected_lines(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, stamp, line, key) of lines whose key may occur in two documents; no such line is missing."""
    texts = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64("text").alias("stamp"))
    shards = blooms.power_of_two(max(shuffle_width(docs.sparkSession), input_bytes(docs) // shard_bytes))
    asked = texts.mapInArrow(_ask(shards), "shard int, asked binary, met binary, again binary, told binary")
    return asked.repartitionById(shards, "shard").mapInArrow(_answer, "doc_id long, stamp long, line int, key binary")


def repeated_lines(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, stamp, dropped lines) of each document that loses lines."""
    suspects = stash(suspected_lines(docs, shard_bytes), "line-suspects")
    # Written, so that both sides of the join are plain exchanges: small ones are broadcast, hot keys split.
    first = stash(suspects.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last"), "line-first")
    lost = suspects.join(first, "key").where("doc_id > first")
    return lost.groupBy("doc_id", "stamp").agg(F.collect_set("line").alias("dropped"))


def line_dedup(docs: DataFrame, dropped: DataFrame | None = None) -> DataFrame:
    """Documents with repeated lines taken out of ``text``; adds n_lines, n_dropped."""
    lost = (repeated_lines(docs) if dropped is None else dropped).select(F.col("doc_id").alias("id"), F.col("stamp").alias("mark"), F.col("dropped").alias("gone"))
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # Rows travel as one column, so that no name of theirs can clash.
    rows = docs.select(F.struct(*others).alias("row"), F.xxhash64("text").alias("stamp"))
    joined = rows.join(lost, (F.col("row.doc_id") == F.col("id")) & (F.col("stamp") == F.col("mark")), "left")
    lines = F.split(F.coalesce("row.text", F.lit("")), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    out = joined.select("row", "gone", lines.alias("lines"))
    return out.select(
        *[(kept if c == "text" else F.col("row").getField(c)).alias(c) for c in others],
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
