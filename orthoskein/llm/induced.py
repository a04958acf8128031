"""External induced sorting of the suffixes of a byte string.

Order of work: the S* suffixes (ascending suffixes behind descending ones) are
sorted by naming the substrings between them and recursing on the names. Then
all descending (L) suffixes are induced from left to right and all ascending
(S) ones from right to left: a suffix that is met sends the suffix before it to
a priority queue, keyed by its first character, where suffixes arrive in their
final order. Tuples carry the common prefix with the tuple before them, so that
no text is compared again.

At the byte level the queue is one stream per byte, handled in blocks; at the
levels of names it is a heap. Both move to disk what exceeds a given number of
tuples, and the text is a mapped file beyond it.
"""

from __future__ import annotations

import heapq
import os
import shutil
import tempfile
from array import array
from collections.abc import Iterator

import numpy as np

#: Tuples that a queue keeps in memory, and the block in which it is read.
IN_MEMORY = 8_000_000
NAMES_IN_MEMORY = 500_000
BLOCK = 1 << 18
#: Common prefixes are told up to this length.
CAP = 127


class Spool:
    """A folder for spilled tuples, removed at the end."""

    def __init__(self):
        self.path, self.files = None, 0

    def name(self) -> str:
        self.path = self.path or tempfile.mkdtemp(prefix="induced-")
        self.files += 1
        return os.path.join(self.path, str(self.files))

    def close(self) -> None:
        if self.path:
            shutil.rmtree(self.path, ignore_errors=True)


class ByteQueue:
    """First-in first-out streams of (position, common prefix), one per byte."""

    def __init__(self, spool: Spool, limit: int):
        self.spool, self.limit, self.held = spool, limit, 0
        self.memory: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(256)]
        self.disk: list[list[tuple[str, int]]] = [[] for _ in range(256)]

    def push(self, byte: int, at: np.ndarray, lcp: np.ndarray) -> None:
        self.memory[byte].append((at, lcp))
        self.held += len(at)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        for byte, parts in enumerate(self.memory):
            if parts:
                name = self.spool.name()
                at, lcp = (np.concatenate(x) for x in zip(*parts, strict=True))
                at.tofile(name)
                lcp.tofile(name + "l")
                self.disk[byte].append((name, len(at)))
                parts.clear()
        self.held = 0

    def take(self, byte: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What the stream holds now, in order, in blocks."""
        disk, self.disk[byte] = self.disk[byte], []
        memory, self.memory[byte] = self.memory[byte], []
        self.held -= sum(len(a) for a, _ in memory)
        for name, n in disk:
            at, lcp = np.memmap(name, np.int64, "r"), np.memmap(name + "l", np.uint8, "r")
            for a in range(0, n, BLOCK):
                yield np.array(at[a : a + BLOCK]), np.array(lcp[a : a + BLOCK])
            del at, lcp
            os.remove(name)
            os.remove(name + "l")
        if memory:
            at, lcp = (np.concatenate(x) for x in zip(*memory, strict=True))
            for a in range(0, len(at), BLOCK):
                yield at[a : a + BLOCK], lcp[a : a + BLOCK]

    def any(self, byte: int) -> bool:
        return bool(self.memory[byte] or self.disk[byte])


PLACE = 40
_LOW = (1 << PLACE) - 1


class NameQueue:
    """Heap of (name, order of arrival, position), as one integer; the larger half spills as sorted runs."""

    def __init__(self, spool: Spool, limit: int):
        self.spool, self.limit = spool, max(2, min(limit, NAMES_IN_MEMORY))
        self.heap: list[int] = []
        self.heads: list[tuple[int, int]] = []
        self.runs: list[Iterator[int]] = []
        self.arrived = 0

    def push(self, name: int, at: int) -> None:
        self.arrived += 1
        heapq.heappush(self.heap, (((name << PLACE) + self.arrived) << PLACE) + at)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        half = len(self.heap) // 2
        file = self.spool.name()
        rows = np.array([(k >> 2 * PLACE, k >> PLACE & _LOW, k & _LOW) for k in self.heap[half:]], np.int64)
        rows.tofile(file)
        del self.heap[half:]
        self.runs.append(self._run(file))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _run(file: str) -> Iterator[int]:
        rows = np.memmap(file, np.int64, "r").reshape(-1, 3)
        for a in range(0, len(rows), 4096):
            for name, arrived, at in rows[a : a + 4096].tolist():
                yield (((name << PLACE) + arrived) << PLACE) + at

    def _advance(self, run: int) -> None:
        key = next(self.runs[run], None)
        if key is not None:
            heapq.heappush(self.heads, (key, run))

    def least(self) -> int | None:
        """The least tuple; its name is in the bits above both places."""
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> None:
        """Drop the least tuple."""
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            self._advance(heapq.heappop(self.heads)[1])
        else:
            heapq.heappop(self.heap)


def ascending(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is less than the next one; the end is least of all."""
    n = len(s)
    turn = np.append(np.flatnonzero(s[1:] != s[:-1]), n - 1)
    up = np.append(s[turn[:-1]] < s[turn[:-1] + 1], False)
    return np.repeat(up, np.diff(turn, prepend=-1))


def names_between(s: np.ndarray, up: np.ndarray, stars: np.ndarray) -> np.ndarray:
    """Order-preserving names of the substrings from each S* position to the next."""
    n, m = len(s), len(stars)
    length = np.append(np.diff(stars), n - stars[-1]) + 1
    name, active, r = np.zeros(m, np.int64), np.arange(m), 0
    while len(active):
        at = stars[active] + r
        inside = at < n
        at = np.where(inside, at, 0)
        key = np.where(inside, (s[at].astype(np.int64) + 1) * 2 + up[at], 0)
        old = name[active]
        order = np.lexsort((key, old))
        c, k = old[order], key[order]
        fresh_c = np.append(True, c[1:] != c[:-1])
        fresh = fresh_c | np.append(True, k[1:] != k[:-1])
        index = np.arange(len(c))
        first = np.maximum.accumulate(np.where(fresh, index, 0))
        name[active[order]] = c + first - np.maximum.accumulate(np.where(fresh_c, index, 0))
        alone = fresh & np.append(fresh[1:], True)
        r += 1
        rest = active[order[~alone]]
        active = np.sort(rest[length[rest] > r])
    return name


def order_of_names(s: np.ndarray, spool: Spool, limit: int) -> np.ndarray:
    """Positions of a string of names in the order of their suffixes."""
    if len(np.unique(s)) == len(s):
        return np.argsort(s)
    n, up = len(s), ascending(s)
    stars = order_of_stars(s, up, spool, limit)
    # Packed arrays: eight bytes a name, and one for its type.
    text, rises = array("q", s.astype(np.int64).tobytes()), up.tobytes()
    order, last = array("q", stars.astype(np.int64).tobytes()), len(stars)
    queue, falls, k = NameQueue(spool, limit), array("q"), 0
    queue.push(text[n - 1], n - 1)
    while True:
        least = queue.least()
        if least is not None and (k == last or least >> 2 * PLACE <= text[order[k]]):
            queue.pop()
            at = least & _LOW
            falls.append(at)
        elif k < last:
            at = order[k]
            k += 1
        else:
            break
        if at and not rises[at - 1]:
            queue.push(text[at - 1], at - 1)
    queue, out, k = NameQueue(spool, limit), array("q"), len(falls) - 1
    while True:
        least = queue.least()
        if least is not None and (k < 0 or -(least >> 2 * PLACE) >= text[falls[k]]):
            queue.pop()
            at = least & _LOW
        elif k >= 0:
            at = falls[k]
            k -= 1
        else:
            break
        out.append(at)
        if at and rises[at - 1]:
            queue.push(-text[at - 1], at - 1)
    return np.frombuffer(out, np.int64)[::-1].copy()


def order_of_stars(s: np.ndarray, up: np.ndarray, spool: Spool, limit: int) -> np.ndarray:
    """S* positions in the order of their suffixes."""
    stars = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    if not len(stars):
        return stars
    name = names_between(s, up, stars)
    dense = np.unique(name, return_inverse=True)[1]
    return stars[order_of_names(dense, spool, limit)]


def common_prefixes(padded: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each position of ``order`` with the one before it, up to CAP."""
    out = np.zeros(len(order), np.uint8)
    for lo in range(1, len(order), BLOCK):
        a, b = order[lo - 1 : lo + BLOCK - 1], order[lo : lo + BLOCK]
        a = a[: len(b)]
        left, depth = np.arange(len(b)), 0
        while len(left) and depth < CAP:
            steps = np.arange(depth, min(depth + 16, CAP))
            differ = padded[a[left, None] + steps] != padded[b[left, None] + steps]
            hit = differ.any(axis=1)
            out[lo + left] = depth + np.where(hit, differ.argmax(axis=1), len(steps))
            left, depth = left[~hit], depth + 16
    return out


class _Minima:
    """Minima of the common prefixes since the last arrival in each stream."""

    def __init__(self):
        self.since = np.full(256, CAP, np.uint8)
        self.begun = np.zeros(256, bool)

    def arrivals(self, lcp: np.ndarray, sent: np.ndarray, byte: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(byte, indices, common prefixes) of the tuples ``sent`` (indices of a block) by stream."""
        table = [lcp]
        while (1 << len(table)) <= len(lcp):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))

        def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Minimum of lcp[a:b], CAP where empty."""
            size = b - a
            level = np.log2(np.maximum(size, 1)).astype(int)
            out = np.full(len(a), CAP, np.uint8)
            for k in np.unique(level[size > 0]):
                at = (level == k) & (size > 0)
                out[at] = np.minimum(table[k][a[at]], table[k][b[at] - (1 << k)])
            return out

        if not len(sent):
            self.since = np.minimum(self.since, lcp.min(initial=CAP))
            return
        order = np.argsort(byte, kind="stable")
        sent, byte = sent[order], byte[order]
        fresh = np.append(True, byte[1:] != byte[:-1])
        heads = np.flatnonzero(fresh)
        ends = np.append(heads[1:], len(sent))
        low = least(np.where(fresh, 0, np.append(0, sent[:-1] + 1)), sent + 1)
        low[heads] = np.minimum(low[heads], self.since[byte[heads]])
        value = np.minimum(low.astype(np.int64) + 1, CAP).astype(np.uint8)
        value[heads[~self.begun[byte[heads]]]] = 0
        self.since = np.minimum(self.since, lcp.min())
        tails = sent[ends - 1] + 1
        self.since[byte[heads]] = least(tails, np.full(len(tails), len(lcp)))
        self.begun[byte[heads]] = True
        for a, b in zip(heads.tolist(), ends.tolist(), strict=True):
            yield int(byte[a]), sent[a:b], value[a:b]


def _run_length(text: np.ndarray, at: int) -> int:
    part = text[at : at + CAP]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def sorted_suffixes(text: np.ndarray, limit: int = IN_MEMORY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes in order, by first byte from the greatest: (positions, common prefixes).

    Each position comes with its common prefix (up to CAP) with the one before
    it; 0 at the first of a byte. Prefixes that reach over the end of the text
    are not exact.
    """
    n, spool = len(text), Spool()
    if not n:
        return
    try:
        if n > limit:
            name = spool.name()
            np.concatenate([text, np.zeros(CAP + 16, np.uint8)]).tofile(name)
            padded = np.memmap(name, np.uint8, "r")
        else:
            padded = np.concatenate([text, np.zeros(CAP + 16, np.uint8)])
        text = padded[:n]
        up = ascending(text)
        stars = order_of_stars(text, up, spool, limit)
        star_lcp = common_prefixes(padded, stars)
        cuts = np.searchsorted(text[stars], np.arange(257)) if len(stars) else np.zeros(257, int)
        kept = ByteQueue(spool, limit)  # L suffixes in order, as one stream per byte

        def scan(queue: ByteQueue, minima: _Minima, at: np.ndarray, lcp: np.ndarray, rising: bool) -> None:
            sent = np.flatnonzero((at > 0) & (up[at - 1] == rising))
            before = at[sent] - 1
            for byte, index, value in minima.arrivals(lcp, sent, text[before]):
                queue.push(byte, at[index] - 1, value)

        queue, minima = ByteQueue(spool, limit), _Minima()
        queue.push(int(text[n - 1]), np.array([n - 1]), np.zeros(1, np.uint8))
        minima.begun[text[n - 1]] = True
        minima.since[:] = 0
        for byte in range(256):
            last = None
            while queue.any(byte):
                for at, lcp in queue.take(byte):
                    kept.push(byte, at, lcp)
                    scan(queue, minima, at, lcp, False)
                    last = int(at[-1])
            for a in range(cuts[byte], cuts[byte + 1], BLOCK):
                at, lcp = stars[a : min(a + BLOCK, cuts[byte + 1])], star_lcp[a : min(a + BLOCK, cuts[byte + 1])].copy()
                if a == cuts[byte]:
                    lcp[0] = 0 if last is None else min(_run_length(text, last), _run_length(text, int(at[0])))
                scan(queue, minima, at, lcp, False)
        del stars, star_lcp
        queue, minima = ByteQueue(spool, limit), _Minima()
        for byte in range(255, -1, -1):
            rises: list[tuple[np.ndarray, np.ndarray]] = []
            while queue.any(byte):
                for at, lcp in queue.take(byte):
                    rises.append((at, lcp))
                    scan(queue, minima, at, lcp, True)
            fall = list(kept.take(byte))
            at, lcp = (np.concatenate([x[i] for x in fall]) if fall else np.zeros(0, (np.int64, np.uint8)[i]) for i in (0, 1))
            up_at, up_lcp = (np.concatenate([x[i] for x in rises]) if rises else np.zeros(0, (np.int64, np.uint8)[i]) for i in (0, 1))
            border = min(_run_length(text, int(at[-1])), _run_length(text, int(up_at[-1]))) if len(at) and len(up_at) else 0
            back, back_lcp = at[::-1], np.append(border, lcp[:0:-1]).astype(np.uint8)[: len(at)]
            for a in range(0, len(back), BLOCK):
                scan(queue, minima, back[a : a + BLOCK], back_lcp[a : a + BLOCK], True)
            if len(at) + len(up_at):
                rising = np.append(border, up_lcp[:0:-1]).astype(np.uint8)[: len(up_at)]
                yield np.concatenate([at, up_at[::-1]]), np.concatenate([lcp, rising])
    finally:
        spool.close()
