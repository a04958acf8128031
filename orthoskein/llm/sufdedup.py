"""Exact removal of repeated byte strings with suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts earlier (in
a smaller doc_id, or earlier in the document).

Windows of LENGTH bytes choose an anchor: the least hash among their GRAM-byte
grams. Equal windows choose equal anchors, so shards by anchor never part equal
windows. A run of windows with one anchor is a segment (150 bytes at most).

1. All segments go to the shard of their anchor, packed by batch: anchor, digest
   and place. Equal segments of a batch are told apart there: all but the first
   repeat as a whole, so a hot passage costs a shard one row a batch. The shard's
   once-seen and twice-seen Bloom filters leave out segments whose anchor is met
   once. Of equal segments all but the first go; where an anchor has several
   different ones, the first of each is wanted.
2. The bytes of wanted segments are sorted in bins of about BIN_BYTES, whole
   anchors in each, by external induced sorting (``induced``) of all suffixes,
   common prefixes included. Suffixes that share LENGTH bytes are one string:
   all but its earliest start go.

The spans then meet their documents by doc_id and a digest of the text. Digests
of segments are 64 bits of a polynomial hash beside the 64-bit anchor hash.

Defined results: a null text is an empty one; rows without doc_id keep all and
repeat nothing; rows that share a doc_id and text are one document; texts that
share a doc_id and differ are documents of their own, in the order of their
digests; columns other than doc_id and text are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import input_bytes, shuffle_width, stash
from . import blooms
from .induced import IN_MEMORY, sorted_suffixes
from .textkernel import BASE, BYTE_CODE, U, mix, parts, powers, slices

LENGTH = 100
GRAM = 50
PIECE = 1 << 20
#: Input bytes (compressed) of one shard.
SHARD_BYTES = 8 << 20
_TOP = np.iinfo(np.uint64).max


def _least_in_window(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(v)
    full = np.full(-(-n // width) * width, _TOP, np.uint64)
    full[:n] = v
    rows = full.reshape(-1, width)
    left = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    right = np.minimum.accumulate(rows, axis=1).ravel()
    return np.minimum(left[: n - width + 1], right[width - 1 : n])


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(text, offset, bytes) with texts over PIECE cut so that each window lies in one piece."""
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - LENGTH + 1), PIECE):
            part = t[a : a + PIECE + LENGTH - 1]
            if len(part) >= LENGTH:
                yield i, a, part


def segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per slice: anchor hash, segment digest, text, first window's start, bytes of each segment."""
    pieces = list(_pieces(texts))
    for a, b in slices([p for _, _, p in pieces], PIECE):
        raw = b"".join(p for _, _, p in pieces[a:b])
        data = np.frombuffer(raw, np.uint8)
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODE[data] * up[: len(data)], out=total[1:])
        gram = mix((total[GRAM:] - total[:-GRAM]) * down[: len(data) - GRAM + 1])
        # The place in the low bits makes ties go to the left, as equal windows do.
        least = _least_in_window((gram >> U(22) << U(22)) | np.arange(len(gram), dtype=np.uint64), LENGTH - GRAM + 1)
        size = np.array([len(p) for _, _, p in pieces[a:b]])
        begin = np.cumsum(size) - size
        fresh = np.append(True, least[1:] != least[:-1])
        inside = np.zeros(len(least) + 1, np.int64)  # whether a window lies in one piece
        inside[begin] += 1
        np.add.at(inside, np.minimum(begin + size - LENGTH + 1, len(least)), -1)
        inside = np.cumsum(inside)[:-1] > 0
        fresh[begin] = True
        starts = np.flatnonzero(fresh & inside)
        stop = np.append(np.flatnonzero(fresh)[1:], len(least))[np.searchsorted(np.flatnonzero(fresh), starts)]
        piece = np.searchsorted(begin, starts, side="right") - 1
        stop = np.minimum(stop, begin[piece] + size[piece] - LENGTH + 1)
        ends = stop - 1 + LENGTH
        digest = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        # Least hashes are small ones; mixed again, they spread over all shards.
        anchor = mix(gram[(least[starts] & U((1 << 22) - 1)).astype(np.int64)] + U(0xA24BAED4963EE407))
        owner = np.array([i for i, _, _ in pieces[a:b]])[piece]
        offset = np.array([o for _, o, _ in pieces[a:b]])[piece]
        yield anchor, digest, owner, starts - begin[piece] + offset, ends - starts


_ROW = np.dtype([("anchor", "u8"), ("digest", "u8"), ("doc", "i8"), ("stamp", "i8"), ("start", "i8"), ("size", "i4")])
#: ``bin`` is where the bytes of a wanted segment are sorted; -1 for spans that go.
SPANS = "doc_id long, stamp long, start long, stop long, bin long"
#: Bytes of segments that are sorted at a time (one anchor's are never parted).
BIN_BYTES = 1 << 20
BINS = 1 << 24


def _firsts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of anchor, digest and place, and whether each is the first of its segment."""
    rows = rows[np.lexsort([rows[c] for c in ("size", "start", "stamp", "doc", "digest", "anchor")])]
    fresh = np.append(True, rows[1:] != rows[:-1])[: len(rows)]
    rows = rows[fresh]
    return rows, np.append(True, (rows["anchor"][1:] != rows["anchor"][:-1]) | (rows["digest"][1:] != rows["digest"][:-1]))[: len(rows)]


def _columns(rows: np.ndarray) -> bytes:
    """Rows as one column behind the other, which compress better than rows do."""
    return b"".join(np.ascontiguousarray(rows[c]).tobytes() for c in _ROW.names)


def _rows(raw: bytes) -> np.ndarray:
    n, at = len(raw) // _ROW.itemsize, 0
    out = np.empty(n, _ROW)
    for c in _ROW.names:
        out[c] = np.frombuffer(raw, _ROW[c], n, at)
        at += n * _ROW[c].itemsize
    return out


def _ask(shards: int):
    """Segments by shard of their anchor: the first of each kind, and others (certain repeats, spread over all shards)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in (x for batch in batches for x in parts(batch)):
            found = []
            docs, stamps = (np.asarray(batch.column(c)) for c in ("doc_id", "stamp"))
            for anchor, digest, owner, start, size in segments([t or b"" for t in texts]):
                part = np.empty(len(anchor), _ROW)
                for name, values in zip(_ROW.names, (anchor, digest, docs[owner], stamps[owner], start, size), strict=True):
                    part[name] = values
                found.append(part)
            if not found:
                continue
            rows, first = _firsts(np.concatenate(found))
            rest, rows = rows[~first], rows[first]
            out: dict[int, list[bytes]] = {}
            for s, part in blooms.by_shard(rows["anchor"], shards):
                out.setdefault(s, [b"", b""])[0] = _columns(np.sort(rows[part], order=("doc", "stamp", "start")))
            for s, part in blooms.by_shard(rest["doc"].astype(np.uint64) * U(BASE), shards):
                out.setdefault(s, [b"", b""])[1] = _columns(rest[part])
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), *(pa.array([r[k] for r in out.values()], pa.binary()) for k in (0, 1))], names=["shard", "first", "rest"])

    return run


def _span_batches(rows: np.ndarray, bins: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    bins = np.full(len(rows), -1) if bins is None else bins
    for a in range(0, len(rows), 1 << 16):
        part = rows[a : a + (1 << 16)]
        columns = [pa.array(part[c]) for c in ("doc", "stamp", "start")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(part["start"] + part["size"]), pa.array(bins[a : a + (1 << 16)])], names=["doc_id", "stamp", "start", "stop", "bin"])


def _judge(shards: int):
    """Spans of segments that repeat as a whole; and the segments that are wanted, with their bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        filters = blooms.Repeats()
        for batch in batches:
            for first, rest in zip(batch.column("first").to_pylist(), batch.column("rest").to_pylist(), strict=True):
                yield from _span_batches(_rows(rest))
                rows = _rows(first)
                keys, counts = np.unique(rows["anchor"], return_counts=True)
                filters.meet(keys, keys[counts > 1])
                held.append(rows)
        twice = filters.twice()
        # A segment whose anchor is met once in all cannot repeat.
        rows, fresh = _firsts(np.concatenate([np.zeros(0, _ROW), *(r[twice.has(r["anchor"])] for r in held)]))
        del held
        if not len(rows):
            return
        yield from _span_batches(rows[~fresh])
        rows = rows[fresh]
        group = np.cumsum(np.append(True, rows["anchor"][1:] != rows["anchor"][:-1])) - 1
        rows = rows[np.bincount(group)[group] > 1]
        if len(rows):
            heads = np.append(True, rows["anchor"][1:] != rows["anchor"][:-1])
            place = (np.cumsum(rows["size"]) - rows["size"])[heads] // BIN_BYTES
            yield from _span_batches(rows, blooms.shard_of(rows["anchor"], shards) * BINS + place[np.cumsum(heads) - 1])

    return run


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted segments."""
    for batch, texts in (x for batch in batches for x in parts(batch)):
        rows, starts, bins, found = [], [], [], []
        for i, (text, spans) in enumerate(zip(texts, batch.column("spans").to_pylist(), strict=True)):
            rows += [i] * len(spans)
            starts += [x["start"] for x in spans]
            bins += [x["bin"] for x in spans]
            found += [(text or b"")[x["start"] : x["stop"]] for x in spans]
        at = np.array(rows, np.int64)
        columns = [pa.array(bins, pa.int64()), *(pa.array(np.asarray(batch.column(c))[at]) for c in ("doc_id", "stamp")), pa.array(starts, pa.int64()), pa.array(found, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["bin", "doc_id", "stamp", "start", "bytes"])


def repeated_windows(parts: list[bytes], rank: np.ndarray, start: np.ndarray, limit: int = IN_MEMORY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rank, start) of all windows of ``parts`` but the earliest of each string; rank is the order of documents."""
    size = np.array([len(p) for p in parts])
    begin = np.cumsum(size + 1) - size - 1
    text = np.frombuffer(b"\0".join(parts), np.uint8)
    for at, lcp in sorted_suffixes(text, limit):
        part = np.searchsorted(begin, at, side="right") - 1
        whole = begin[part] + size[part] - at >= LENGTH
        group = np.cumsum(lcp < LENGTH)[whole]
        shared = np.bincount(group)[group] > 1 if len(group) else group.astype(bool)
        at, part, group = at[whole][shared], part[whole][shared], group[shared]
        d, s = rank[part], start[part] + at - begin[part]
        order = np.lexsort((s, d, group))
        g, d, s = group[order], d[order], s[order]
        head = np.maximum.accumulate(np.where(np.append(True, g[1:] != g[:-1])[: len(g)], np.arange(len(g)), 0))
        later = (d != d[head]) | (s != s[head])
        yield d[later], s[later]


def _sort_bin(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    places = np.array([r[:3] for r in rows], np.int64)
    docs, rank = np.unique(places[:, :2], axis=0, return_inverse=True)
    found = [np.stack(x) for x in repeated_windows([r[3] for r in rows], rank.ravel(), places[:, 2])]
    every = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    order = np.lexsort((every[1], every[0]))
    d, s = every[0][order], every[1][order]
    # Runs of starts of one document become one span.
    heads = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (s[1:] > s[:-1] + 1))[: len(d)])
    tails = np.append(heads[1:], len(d)) - 1 if len(d) else heads
    out = np.zeros(len(heads), _ROW)
    out["doc"], out["stamp"], out["start"], out["size"] = docs[d[heads], 0], docs[d[heads], 1], s[heads], s[tails] - s[heads] + LENGTH
    yield from _span_batches(out)


def _sort_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of their bins; one bin is held at a time."""
    held: list[tuple] = []
    now = None
    for batch in batches:
        for to, *row in zip(*(batch.column(c).to_pylist() for c in ("bin", "doc_id", "stamp", "start", "bytes")), strict=True):
            if to != now and held:
                yield from _sort_bin(held)
                held = []
            now = to
            held.append(tuple(row))
    if held:
        yield from _sort_bin(held)


def repeated_spans(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, stamp, start, stop) of byte spans that repeat earlier strings; spans may overlap."""
    texts = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("stamp"), "text")
    shards = blooms.power_of_two(max(shuffle_width(docs.sparkSession), input_bytes(docs) // shard_bytes))
    asked = texts.mapInArrow(_ask(shards), "shard int, first binary, rest binary")
    judged = stash(asked.repartitionById(shards, "shard").mapInArrow(_judge(shards), SPANS), "suf-judged")
    wanted = judged.where("bin >= 0").groupBy("doc_id", "stamp").agg(F.collect_list(F.struct("start", "stop", "bin")).alias("spans"))
    # One row of those that repeat a document: it is the document's text that counts.
    wanted = wanted.withColumnsRenamed({"doc_id": "id", "stamp": "mark"})
    chosen = texts.join(wanted, (F.col("doc_id") == F.col("id")) & (F.col("stamp") == F.col("mark")))
    parts = chosen.select("doc_id", "stamp", "text", "spans").mapInArrow(_wanted, "bin long, doc_id long, stamp long, start long, bytes binary")
    dealt = parts.repartitionById(shards, F.expr(f"cast(bin div {BINS} as int)")).sortWithinPartitions("bin")
    sorted_ = stash(dealt.mapInArrow(_sort_shard, SPANS), "suf-sorted")
    return judged.where("bin < 0").unionByName(sorted_).drop("bin")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in (x for batch in batches for x in parts(batch)):
        out = []
        for text, starts, stops in zip((t or b"" for t in texts), batch.column("starts").to_pylist(), batch.column("stops").to_pylist(), strict=True):
            kept, at, removed, runs = [], 0, 0, 0
            for a, b in sorted(zip(starts or [], stops or [], strict=True)):
                a, b = max(a, at), min(b, len(text))
                if b <= a:
                    continue
                # A span that touches the one before belongs to its run.
                runs += not (runs and a == at)
                removed += b - a
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            out.append((len(text), removed, runs, b"".join(kept)))
        columns = [batch.column("doc_id"), *(pa.array([r[i] for r in out], pa.int64()) for i in range(3)), pa.array([hashlib.sha256(r[3]).hexdigest() for r in out], pa.string()), pa.array([r[3] for r in out], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every document."""
    spans = repeated_spans(docs).groupBy("doc_id", "stamp").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("id"), F.col("stamp").alias("mark"), F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("stamp"))
    joined = rows.join(spans, (F.col("doc_id") == F.col("id")) & (F.col("stamp") == F.col("mark")), "left")
    return joined.select("doc_id", "text", "starts", "stops").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
