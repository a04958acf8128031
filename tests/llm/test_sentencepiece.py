import random

import pytest

from orthoskein.llm import sentencepiece as sp


@pytest.fixture(scope="module")
def model():
    return sp.load()


def best_score(model, word):
    """Greatest summed score over all segmentations, by trying every piece end."""
    best = [0.0] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - 40), end):
            if word[start:end] in model.scores and best[start] is not None:
                total = best[start] + model.scores[word[start:end]][1]
                best[end] = total if best[end] is None else max(best[end], total)
        if best[end] is None:
            best[end] = best[end - 1] + len(word[end - 1].encode()) * model.byte_score
    return best[-1]


def test_score_is_the_best(model):
    rng = random.Random(3)
    score_of = {i: s for i, s in model.scores.values()}
    for _ in range(400):
        word = "▁" + "".join(rng.choice("abcdehinorstth. é日😀▁") for _ in range(rng.randint(0, 25))).replace(" ", "▁")
        ids = sp.viterbi(model, word)
        assert sum(score_of.get(i, model.byte_score) for i in ids) == pytest.approx(best_score(model, word), rel=1e-12)
        assert b"".join(model.text_of[i] for i in ids).decode() == word.replace("▁", " ")


TEXTS = [None, "", "a", " a  b ", "▁x▁", "x▁▁ y", "日本語😀\u0000z\n\t", "word " * 30_000, "x" * 20_000, "été à la plage\r\n"]


def test_round_trip(spark):
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)] * 2, "doc_id long, text string, tokens int")
    out = sp.encode(df, ["doc_id", "text"])
    rows = sp.decode(out, ["text", "tokens", "exact"]).collect()
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        assert r.decoded == r.text and r.exact and (r.tokens is None) == (r.text is None)
        assert r.text != "" or r.tokens == []
    assert sp.encode(df.limit(0), ["doc_id"]).collect() == []


def test_memory_of_words_does_not_matter(model, monkeypatch):
    monkeypatch.setattr(sp, "REMEMBERED", 3)
    text = "one two three four five six one two three "
    assert sp.Encoder(model).encode(text) == [i for w in ("▁" + text.replace(" ", "▁"),) for i in sp.viterbi(model, w)]


def test_kept_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, "some text", 5, "a", 2, 3), (1, "some text", 5, "a", 2, 3)], "doc_id long, text string, tokens int, exact string, row int, none int")
    out = sp.encode(df, df.columns)
    assert out.columns == ["doc_id", "text", "row", "none", "tokens", "exact"]
    back = sp.decode(out.withColumn("decoded", out.row), ["doc_id", "decoded", "row"])
    assert [tuple(r) for r in back.collect()] == [(1, 2, "some text")] * 2
