"""Vectorised hashing of words and word shingles over UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once; longer texts are cut at white space.
BLOCK = 1 << 20
#: Text bytes of a batch that a kernel holds as Python objects at a time.
PART = 1 << 22
BASE = 0x9E3779B97F4A7C15 | 1
U = np.uint64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash; a bijection."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * U(BASE))
#: A code for each byte at each place of a word (places count on beyond 63): no sum of them follows from the text's structure.
WORD_CODE = mix(np.arange(1, (256 << 6) + 1, dtype=np.uint64) * U(0xA3B195354A39B70D)).reshape(256, 64)
PLACE_CODE = mix(np.arange(1, 65, dtype=np.uint64) * U(0xD1342543DE82EF95))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2**64, for i below at least n."""
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _powers:
        up, down = np.full(size, U(BASE)), np.full(size, U(pow(BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        _powers.clear()
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _hash_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of one block."""
    data = np.frombuffer(raw, np.uint8)
    edge = np.diff(is_space(data).view(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    begin = np.zeros(len(data), np.int32)
    begin[starts] = starts
    place = np.arange(len(data), dtype=np.int32) - np.maximum.accumulate(begin)
    code = WORD_CODE[data, place & 63]
    far = np.flatnonzero(place > 63)
    code[far] = mix(code[far] + (place[far] >> 6).astype(np.uint64) * U(0xD6E8FEB86659FD93))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code, out=total[1:])
    return mix(total[ends] - total[starts] + (ends - starts).astype(np.uint64)), starts


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words `[^\\x20\\x09-\\x0D]+` of ``raw``."""
    if len(raw) <= 2 * BLOCK:
        return _hash_words(raw)
    found, at = [], 0
    while at < len(raw):
        end = at + BLOCK
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        h, s = _hash_words(raw[at:end])
        found.append((h, s + at))
        at = end
    return np.concatenate([h for h, _ in found]), np.concatenate([s for _, s in found])


def slices(texts: list[bytes], most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``most`` bytes together."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def parts(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Consecutive pieces of a batch with about PART text bytes each, and their texts; a text is never cut.

    A batch holds a number of rows whatever their length, so this bounds what a
    kernel needs beside the longest text. ``column`` may be a field of ``row``.
    """
    texts = batch.column(column) if column in batch.schema.names else pc.struct_field(batch.column("row"), column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART, side="right")))
        yield batch.slice(at, end - at), texts.slice(at, end - at).cast(pa.binary()).to_pylist()
        at = end


def shingle_sets(texts: list[bytes | None], width: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles.

    A-Z are lower-cased. Fewer words than ``width`` make one shingle; no words none.
    """
    plain = [t or b"" for t in texts]
    for a, b in slices(plain):
        part = plain[a:b]
        words, starts = word_hashes(b"\n".join(part).lower())
        ends = np.cumsum([len(t) + 1 for t in part])
        cuts = np.searchsorted(starts, ends)
        full = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for j in range(width):
            full += words[j : j + len(full)] * PLACE_CODE[j]
        full = mix(full)
        first = 0
        for last in cuts.tolist():
            n = last - first
            if n >= width:
                yield np.unique(full[first : last - width + 1])
            elif n:
                yield mix((words[first:last] * PLACE_CODE[:n]).sum(keepdims=True) + U(n))
            else:
                yield np.zeros(0, np.uint64)
            first = last
