"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes proposes boundaries. Chunk sizes are
normalised: a strict mask up to NORMAL bytes, a lax one beyond, limits at both
ends. A fingerprint is the set of chunk digests with chunk lengths; the
likeness of two texts is the share, by length, of the first one's chunks that
the second one contains. An edit only changes the chunks around it.

Defined results: a null text is an empty one; an empty fingerprint is like
another empty one (1) and unlike all others (0); documents are taken in order
of doc_id, ties by text, rows without doc_id last; a single document follows
itself; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import input_bytes, shuffle_width
from .textkernel import mix, slices

WINDOW = 32
LEAST, NORMAL, MOST = 16, 48, 256
STRICT, LAX = np.uint32(1 << 24), np.uint32(1 << 28)
GEAR = (mix(np.arange(1001, 1257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
PARTITION_BYTES = 24 << 20

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def gear_hashes(data: np.ndarray, gap: np.ndarray | None = None) -> np.ndarray:
    """Gear hash at every byte, of the WINDOW bytes that end there; ``gap`` bytes count nothing."""
    h = GEAR[data]
    if gap is not None:
        h[gap] = 0
    step = 1
    while step < WINDOW:
        h[step:] += h[:-step].copy() << np.uint32(step)
        step *= 2
    return h


def cut(texts: list[bytes], heads: list[int]) -> list[list[int]]:
    """Chunk ends of each text; its first ``heads[i]`` bytes are context, not content."""
    out: list[list[int]] = []
    filler = bytes(WINDOW)
    for a, b in slices(texts):
        part = texts[a:b]
        data = np.frombuffer(filler.join([b"", *part]), np.uint8)
        begins, at = [], 0
        for t in part:
            at += WINDOW
            begins.append(at)
            at += len(t)
        gap = (np.asarray(begins)[:, None] - np.arange(1, WINDOW + 1)).reshape(-1)
        h = gear_hashes(data, gap)
        lax = np.flatnonzero(h < LAX)
        strict = lax[h[lax] < STRICT].tolist()
        lax = lax.tolist()
        for begin, t, head in zip(begins, part, heads[a:b], strict=True):
            ends, start, stop = [], begin + head, begin + len(t)
            while start < stop:
                end = min(start + MOST, stop)
                normal = start + NORMAL
                k = bisect_left(strict, start + LEAST - 1)
                if k < len(strict) and strict[k] < normal - 1 and strict[k] < end:
                    end = strict[k] + 1
                else:
                    k = bisect_left(lax, normal - 1)
                    if k < len(lax) and lax[k] < end:
                        end = lax[k] + 1
                ends.append(end - begin)
                start = end
            out.append(ends)
    return out


def chunk_set(text: bytes, start: int, ends: list[int]) -> list[int]:
    """Codes of the chunks: 48 bits of digest, 8 of length less one."""
    digest, codes = xxhash.xxh3_64_intdigest, []
    for end in ends:
        codes.append((digest(text[start:end]) >> 16 << 8) | (end - start - 1))
        start = end
    return codes


def pack(codes: np.ndarray) -> str:
    """Sorted distinct codes as text: seven bytes each, base64."""
    return base64.b64encode(codes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 1:].tobytes()).decode()


def unpack(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 7)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, 1:] = raw
    return full.view(">u8").reshape(-1).astype(np.uint64)


def weight(codes: np.ndarray) -> int:
    return int((codes & np.uint64(255)).sum()) + len(codes)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share by length of ``a``'s chunks that ``b`` holds."""
    if not len(a):
        return float(not len(b))
    return weight(np.intersect1d(a, b, assume_unique=True)) / weight(a)


def _unique(codes: list[int]) -> np.ndarray:
    return np.unique(np.array(codes, np.uint64))


def _compare(rows: list[tuple]) -> Iterator[tuple]:
    """Result rows of all of ``rows`` (doc_id, text) but the final one, which follows."""
    raw = [t.encode() for _, t in rows]
    ends = cut(raw, [0] * len(raw))
    codes = [chunk_set(t, 0, e) for t, e in zip(raw, ends, strict=True)]
    sets = [_unique(c) for c in codes]
    edits, keep, tails, heads = [], [], [], []
    for i in range(len(rows) - 1):
        text = rows[i][1]
        n = len(text) // 4
        stem = text[: len(text) - n].encode()
        edited = stem + rows[i + 1][1][:n].encode()
        # Chunks that end within the common stem are the same, but for the text's own end.
        same = bisect_left(ends[i], len(stem) + 1)
        if same and ends[i][same - 1] == len(raw[i]):
            same -= 1
        begin = ends[i][same - 1] if same else 0
        head = min(begin, WINDOW - 1)
        edits.append(edited)
        keep.append(same)
        tails.append(edited[begin - head :])
        heads.append(head)
    for i, more in enumerate(cut(tails, heads)):
        own = _unique(codes[i][: keep[i]] + chunk_set(tails[i], heads[i], more))
        yield (
            rows[i][0],
            len(rows[i][1]),
            hashlib.sha256(edits[i]).hexdigest(),
            pack(sets[i]),
            pack(own),
            containment(sets[i], own),
            containment(sets[i], sets[i + 1]),
        )


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket, in order, each bucket's end followed by the next bucket's first row."""
    held: list[tuple] = []
    bucket, size, done = None, 0, False
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal held, size
        if len(held) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*_compare(held), strict=True), schema, strict=True)], schema=schema)
        held, size = held[-1:], 0

    for batch in batches:
        for b, guest, doc, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text")), strict=True):
            if b != bucket:
                yield from flush()
                held, bucket, done = [], b, False
            if done:
                continue
            held.append((doc, text or ""))
            size += len(held[-1][1])
            done = guest
            if size > 1 << 21:
                yield from flush()
    yield from flush()


def _bucket_of(doc_id: Column, bounds: list[int]) -> Column:
    """Number of bounds not above doc_id, in two steps of square-root length; nulls go last."""
    step = max(1, int(len(bounds) ** 0.5))
    coarse = bounds[step - 1 :: step]
    fine = [bounds[i : i + step] for i in range(0, len(bounds) + 1, step)]

    def below(array: Column) -> Column:
        return F.size(F.filter(array, lambda x: x <= doc_id))

    def lit(values: list[int]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<bigint>")

    block = below(lit(coarse))
    inner = F.get(F.array(*[lit(x) for x in fine]), block)
    return F.when(doc_id.isNull(), F.lit(len(bounds))).otherwise(block * step + below(inner)).cast("int")


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    Ids alone give range bounds; texts shuffle once, into ordered buckets. The
    first row of a bucket also goes to the bucket before it as a guest (that of
    the first bucket to the last), so each row meets its follower.
    """
    spark = docs.sparkSession
    parts = max(1, shuffle_width(spark), input_bytes(docs) // PARTITION_BYTES)
    ids = docs.select("doc_id")
    spots = [i / parts for i in range(1, parts)]
    found = ids.agg(F.percentile_approx("doc_id", spots, F.lit(100 * parts)).alias("q")).first()[0] if spots else []
    bounds = sorted(set(found or []))
    bucket = _bucket_of(F.col("doc_id"), bounds)
    firsts = sorted((r[0], r[1]) for r in ids.groupBy(bucket.alias("b")).agg(F.min("doc_id").alias("m")).collect())
    leads = [m for _, m in firsts]
    hosts = {m: firsts[i - 1][0] for i, m in enumerate(leads)}
    # A null lead only occurs where no row has an id, hence with one bucket.
    lead = F.col("doc_id").isin([m for m in leads if m is not None])
    if leads and leads[0] is None:
        lead, host = F.col("doc_id").isNull(), F.lit(firsts[0][0])
    elif leads and None in leads:
        raise AssertionError("rows without doc_id share the last bucket")
    elif leads:
        host = F.get(F.array(*[F.lit(hosts[m]) for m in leads]), F.array_position(F.array(*map(F.lit, leads)).cast("array<bigint>"), F.col("doc_id")).cast("int") - 1)
    else:
        host = F.lit(0)
    own = F.struct(bucket.alias("bucket"), F.lit(False).alias("guest"))
    visit = F.struct(host.cast("int").alias("bucket"), F.lit(True).alias("guest"))
    placed = docs.select("doc_id", "text", F.explode(F.when(lead, F.array(own, visit)).otherwise(F.array(own))).alias("at")).select("at.bucket", "at.guest", "doc_id", "text")
    ordered = placed.repartitionById(len(bounds) + 1, "bucket").sortWithinPartitions("bucket", "guest", F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first())
    return ordered.mapInArrow(_in_order, SCHEMA)
