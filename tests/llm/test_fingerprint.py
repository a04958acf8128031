import hashlib

import pytest

from orthoskein.llm import fingerprint as fp

SCHEMA = "doc_id long, text string, bucket int"


def edited(a, b):
    n = len(a) // 4
    return a[: len(a) - n] + b[:n]


def plain_codes(text):
    """Chunk codes of one text, cut alone and from its start."""
    raw = text.encode()
    (ends,) = fp.cut([raw], [0])
    return set(fp.chunk_set(raw, 0, ends))


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        e = edited(t, nxt)
        a, b, c = plain_codes(t), plain_codes(e), plain_codes(nxt)

        def share(x, y):
            if not x:
                return float(not y)
            w = lambda s: sum((v & 255) + 1 for v in s)
            return w(x & y) / w(x)

        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), pytest.approx(share(a, b)), pytest.approx(share(a, c))))
    return out


TEXTS = [
    (7, "the quick brown fox jumps over the lazy dog " * 30),
    (3, None),
    (5, ""),
    (9, "é" * 700 + "z"),
    (11, " ".join(str(i * i) for i in range(4000))),
    (12, " ".join(str(i * i) for i in range(1, 4000))),
    (40, "short"),
    (41, "a" * 5000),
]


@pytest.mark.parametrize("rows", [TEXTS, TEXTS[:1], [], TEXTS + [(None, "no id at all"), (41, "a" * 5000)], [(None, "only")]])
def test_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], SCHEMA).repartition(3)
    got = sorted(
        ((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in fp.fingerprint(df).collect()),
        key=lambda r: (r[0] is None, r[0] or 0),
    )
    assert got == brute(rows)


def test_equal_texts_share_a_fingerprint_and_shifts_keep_most(spark):
    text = " ".join(str(i * 7919) for i in range(3000))
    out = fp.fingerprint(spark.createDataFrame([(1, text, 0), (2, text, 0), (3, "some words first. " + text, 0)], SCHEMA)).orderBy("doc_id").collect()
    assert out[0].fingerprint == out[1].fingerprint
    assert out[0].near_next == 1.0
    assert out[1].near_next > 0.95
    codes = fp.unpack(out[0].fingerprint)
    assert fp.pack(codes) == out[0].fingerprint


def test_window_forgets_older_bytes():
    a, b = b"x" * 40 + b"common tail of more than thirty-two bytes", b"yy" + b"common tail of more than thirty-two bytes"
    import numpy as np

    ha, hb = (fp.gear_hashes(np.frombuffer(t, np.uint8)) for t in (a, b))
    assert ha[-1] == hb[-1]
