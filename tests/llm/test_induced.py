import numpy as np
import pytest

from orthoskein.llm import induced


def check(raw, limit=induced.IN_MEMORY):
    text = np.frombuffer(raw, np.uint8)
    parts = list(induced.sorted_suffixes(text, limit))[::-1]
    got = [int(p) for at, _ in parts for p in at]
    assert got == sorted(range(len(raw)), key=lambda i: raw[i:])
    for at, lcp in parts:
        for k in range(1, len(at)):
            a, b = raw[at[k - 1] :], raw[at[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            # Beyond the end of the text the prefix is only bounded from below.
            if n < min(len(a), len(b)):
                assert lcp[k] == min(n, induced.CAP), (at[k - 1], at[k], n, lcp[k])
            else:
                assert lcp[k] >= min(n, induced.CAP)


@pytest.mark.parametrize("raw", [b"a", b"banana", b"mississippi" * 9, b"a" * 400, b"ab" * 300, b"abcabcabd" * 60, bytes(range(256)) * 3, b"\0\0a\0\0a\0", b"zyxw" * 50, b"abcd" * 50])
def test_known_strings(raw):
    check(raw)


def test_random_strings():
    rng = np.random.default_rng(4)
    for n in (2, 5, 30, 300, 1500):
        for letters in (2, 3, 26):
            for _ in range(4):
                check(rng.integers(97, 97 + letters, n).astype(np.uint8).tobytes())


def test_repeats_with_disk(monkeypatch):
    monkeypatch.setattr(induced, "BLOCK", 64)
    rng = np.random.default_rng(5)
    words = [rng.integers(97, 101, 150).astype(np.uint8).tobytes() for _ in range(4)]
    check(b"\0".join(words[i] for i in rng.integers(0, 4, 12)), limit=50)
