"""Bloom filters that stay with the shard of their hashes.

Hashes go to shards by their top bits. A shard streams what arrives through a
once-seen filter; hashes met again enter its twice-seen filter, which answers
for the rows that the shard holds. Filters have no false negatives and never
leave their task; their size follows from the shard, whose number follows from
the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Slots of a shard's once-seen filter, and those a key takes at least.
ONCE_SLOTS = 1 << 24
BITS_PER_KEY = 16
PROBES = 4


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each hash; ``shards`` is a power of two."""
    return (h >> np.uint64(64 - shards.bit_length() + 1)).astype(np.int64) if shards > 1 else np.zeros(len(h), np.int64)


def power_of_two(wanted: int) -> int:
    """Least power of two that is not below ``wanted``."""
    return 1 << max(0, int(wanted - 1).bit_length())


def by_shard(h: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, indices) of the hashes, for shards that have any."""
    of = shard_of(h, shards)
    order = np.argsort(of, kind="stable")
    full, at = np.unique(of[order], return_index=True)
    for s, part in zip(full.tolist(), np.split(order, at[1:]), strict=False):
        yield s, part


def _probes(h: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    """Slots of each hash: double hashing of its halves."""
    a, b = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    for i in range(PROBES):
        yield ((a + np.uint64(i) * b) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(slots)


class Bloom:
    """A filter of one byte a slot while it is filled, and of one bit when packed."""

    def __init__(self, slots: int):
        self.slots, self.marks, self.bits = slots, np.zeros(slots, bool), None

    def add(self, h: np.ndarray) -> None:
        for at in _probes(h, self.slots):
            self.marks[at] = True

    def pack(self) -> Bloom:
        self.bits, self.marks = np.packbits(self.marks), None
        return self

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for at in _probes(h, self.slots):
            if self.bits is None:
                found &= self.marks[at]
            else:
                found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0
        return found


class Repeats:
    """The two filters of one shard."""

    def __init__(self):
        self.once: Bloom | None = Bloom(ONCE_SLOTS)
        self.again: list[np.ndarray] = []

    def meet(self, h: np.ndarray, certain: np.ndarray) -> None:
        """Take distinct hashes, and those known to be met again."""
        self.again += [h[self.once.has(h)], certain]
        self.once.add(h)
        if len(self.again) > 64:
            self.again = [np.unique(np.concatenate(self.again))]

    def twice(self) -> Bloom:
        """The twice-seen filter; the once-seen one is given up."""
        keys = np.unique(np.concatenate([*self.again, np.zeros(0, np.uint64)]))
        self.once, self.again = None, []
        found = Bloom(max(64, len(keys) * BITS_PER_KEY))
        found.add(keys)
        return found.pack()
