"""Language identification: family first, then linear SVMs between close languages.

Texts become frequencies of hashed byte n-grams (orders 1 to 4, letters only,
ASCII lower-cased). Families are told apart by one-versus-one linear support
vector machines, and so are the languages within a family. All machines are
linear, so a text's score is a mean of weights over its n-grams: the whole
text is read once and never held as a vector.

Every language of the labels is learned. Languages that the table of families
does not have are families of their own while they are few; many of them form
families of like n-gram frequencies, so that machines stay far fewer than pairs
of languages.

Training takes a bounded sample: per language about PER_LANGUAGE documents, or
fewer (LEAST at least) where that makes more than SAMPLE in all, chosen by a
hash of id and text, equal rows once. Learned only from text and non-null
``lang`` of documents whose crc32(doc_id) mod 3 is not 1; prediction sees
nothing but the text.

Defined results: ``und`` with score 0 for null texts and texts without a
letter, and for all texts if nothing could be learned; rows without doc_id are
predicted, not learned from, and not held out; other columns are kept, of any
name, but for those named lang_pred or score, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .carry import Carry
from .textkernel import U, mix, parts, slices

#: Languages of one family share a name; others are a family of their own.
FAMILY = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic",
}
BUCKETS = 1 << 11
ORDERS = (1, 2, 3, 4)
PAD = max(ORDERS)
ORDER_CODE = mix(np.array(ORDERS, np.uint64))
PER_LANGUAGE = 500
#: Documents of all languages together; each takes BUCKETS * orders floats of the driver.
SAMPLE = 2000
LEAST = 40
#: Languages outside the table of families that are families of their own.
ALONE = 12
UNDETERMINED = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)


def ngrams(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, buckets per order, starts of texts) of slices of ``texts``.

    Runs of non-letters fold to single spaces. Four spaces stand between texts and
    a text's grams start after three of them, so neighbours never matter.
    """
    for a, b in slices(texts, 1 << 19):
        gap = b"\n" * PAD
        data = _FOLD[np.frombuffer(gap + gap.join(texts[a:b]) + gap, np.uint8)]
        edges = np.cumsum([0] + [len(t) + PAD for t in texts[a:b]])
        keep = np.ones(len(data), bool)
        keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
        for i in range(PAD):
            keep[edges + i] = True
        starts = np.cumsum(keep)[edges[:-1]] - 1 + PAD - 1
        wide = data[keep][:-1].astype(np.uint64)
        found = np.empty((len(ORDERS), len(wide)), np.int32)
        code = np.zeros(len(wide), np.uint64)
        for row, order in enumerate(ORDERS):
            shifted = np.concatenate([np.full(order - 1, 32, np.uint64), wide[: len(wide) - order + 1]])
            code = code | shifted << U(8 * (order - 1))
            found[row] = (mix(code + ORDER_CODE[row]) >> U(64 - BUCKETS.bit_length() + 1)).astype(np.int32)
        yield a, b, found, starts


@dataclass
class Machines:
    """Pairwise machines: ``weights[:, k]`` and ``bias[k]`` are positive for ``pairs[k][0]``."""

    languages: list[str]
    families: list[str]
    pairs: list[tuple[int, int]]
    of_family: list[bool]
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray

    def predict(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores from margins (texts x machines)."""
        n, names = len(margins), sorted(set(self.families))
        prob = 1 / (1 + np.exp(-np.clip(margins * self.slope, -30, 30)))

        def pick(members: list[int], family: bool) -> np.ndarray:
            """Share of each member: product of its pairwise probabilities, normalised."""
            log = np.zeros((n, len(members)))
            for k, (i, j) in enumerate(self.pairs):
                if self.of_family[k] == family and i in members and j in members:
                    log[:, members.index(i)] += np.log(prob[:, k] + 1e-12)
                    log[:, members.index(j)] += np.log(1 - prob[:, k] + 1e-12)
            log -= log.max(axis=1, keepdims=True)
            return np.exp(log) / np.exp(log).sum(axis=1, keepdims=True)

        outer = pick(list(range(len(names))), True)
        best, score = outer.argmax(axis=1), np.zeros(n)
        chosen = np.zeros(n, np.int64)
        for f, name in enumerate(names):
            members, rows = [i for i, x in enumerate(self.families) if x == name], best == f
            inner = pick(members, False)
            local = inner.argmax(axis=1)
            chosen[rows] = np.array(members)[local[rows]]
            score[rows] = outer[rows, f] * inner[rows, local[rows]]
        return [self.languages[i] for i in chosen], np.clip(score, 0, 1)


def _svm(x: np.ndarray, y: np.ndarray, rounds: int = 120, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by accelerated gradient; classes weigh alike."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, v, b, vb = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32), 0.0, 0.0
    step = 1.0 / (2 * float(share @ np.einsum("ij,ij->i", x, x)) + 2 + ridge)
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v + vb))
        pull = (share * slack * y).astype(np.float32)
        w2, b2 = v + step * (2 * (pull @ x) - ridge * v), vb + step * 2 * float(pull.sum())
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, b


def _slope(margin: np.ndarray, y: np.ndarray) -> float:
    """Scale of margins at which they are log-odds: least log loss over a grid."""
    grid = np.geomspace(0.5, 32, 25)
    return float(grid[np.argmin([np.logaddexp(0, -y * margin * s).mean() for s in grid])])


def families_of(languages: list[str], means: np.ndarray) -> list[str]:
    """Family of each language: from the table, itself, or the nearest of about sqrt(n) far-apart ones."""
    found = [FAMILY.get(n, n) for n in languages]
    free = [i for i, n in enumerate(languages) if n not in FAMILY]
    if len(free) <= ALONE:
        return found
    points = means[free]
    heads = [0]
    far = ((points - points[0]) ** 2).sum(axis=1)
    nearest = np.zeros(len(free), int)
    while len(heads) < len(free) ** 0.5 and far.max() > 0:
        heads.append(int(far.argmax()))
        d = ((points - points[heads[-1]]) ** 2).sum(axis=1)
        nearest, far = np.where(d < far, len(heads) - 1, nearest), np.minimum(far, d)
    for i, k in zip(free, nearest.tolist(), strict=True):
        found[i] = f"like {languages[free[heads[k]]]}"
    return found


def train(x: np.ndarray, labels: list[str]) -> Machines:
    """Machines from frequencies ``x`` (texts x BUCKETS * orders, scaled in place) and their languages."""
    languages = sorted(set(labels))
    place = {n: i for i, n in enumerate(languages)}
    lang = np.array([place[n] for n in labels])
    scale = np.float32(1) / np.sqrt(x.mean(axis=0) + np.float32(1e-5))
    x *= scale
    families = families_of(languages, np.stack([x[lang == i].mean(axis=0) for i in range(len(languages))]))
    names = sorted(set(families))
    fam = np.array([names.index(families[i]) for i in lang])
    pairs, outer, columns, bias, slopes = [], [], [], [], []
    jobs = [(i, j, True) for i, j in combinations(range(len(names)), 2)]
    jobs += [(i, j, False) for i, j in combinations(range(len(languages)), 2) if families[i] == families[j]]
    for i, j, is_family in jobs:
        of = fam if is_family else lang
        # Only the rows of the two sides: rows of others would weigh nothing.
        rows = np.flatnonzero((of == i) | (of == j))
        part, y = (x if len(rows) == len(x) else x[rows]), np.where(of[rows] == i, 1.0, -1.0)
        w, b = _svm(part, y)
        pairs.append((i, j))
        outer.append(is_family)
        columns.append(w * scale)
        bias.append(b)
        slopes.append(_slope(part @ w + b, y))
    weights = np.array(columns, np.float32).T if columns else np.zeros((x.shape[1], 0), np.float32)
    return Machines(languages, families, pairs, outer, np.ascontiguousarray(weights), np.array(bias), np.array(slopes))


def frequencies(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), BUCKETS * len(ORDERS)), np.float32)
    for a, _, found, starts in ngrams(texts):
        ends = [*starts[1:].tolist(), found.shape[1]]
        for i, (s, e) in enumerate(zip(starts.tolist(), ends, strict=True)):
            for row in range(len(ORDERS)):
                out[a + i, row * BUCKETS : (row + 1) * BUCKETS] = np.bincount(found[row, s:e], minlength=BUCKETS) / (e - s)
    return out


def margins(machines: Machines, texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), len(machines.pairs)))
    for a, b, found, starts in ngrams(texts):
        size = np.diff(np.append(starts, found.shape[1]))
        for k in range(len(machines.pairs)):
            column = machines.weights[:, k]
            total = column[found[0]]
            for row in range(1, len(ORDERS)):
                total += column[row * BUCKETS : (row + 1) * BUCKETS][found[row]]
            out[a:b, k] = np.add.reduceat(total, starts, dtype=np.float64) / size + machines.bias[k]
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 64):
            part = batch.slice(a, 64)
            x = frequencies(part.column("text").cast(pa.binary()).to_pylist())
            at = [np.flatnonzero(r) for r in x]
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array([i.astype(np.int32).tobytes() for i in at], pa.binary()), pa.array([r[i].tobytes() for r, i in zip(x, at, strict=True)], pa.binary())],
                names=["lang", "at", "share"],
            )


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Machines | None:
    """Train on a bounded sample of the labelled documents that are not held out.

    The driver holds a count for each language and the drawn documents' n-gram
    shares: at most about half as many more than ``per_language`` asks.
    """
    labelled = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = labelled.groupBy("lang").count().collect()
    if not counts:
        return None
    each = min(per_language, max(LEAST, SAMPLE // len(counts)))
    share = F.try_element_at(F.create_map(*[F.lit(v) for r in counts for v in (r[0], each / r[1])]), F.col("lang"))
    drawn = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = labelled.where((drawn < share) & F.col("text").rlike(r"\p{L}")).select("text", "lang", F.xxhash64("lang", "doc_id", "text").alias("h"))
    # Repeated rows count once; the limit holds whatever the ids are.
    rows = rows.dropDuplicates(["lang", "h"]).orderBy("h").limit(each * len(counts) * 3 // 2 + 100).select("text", "lang")
    rows = rows.mapInArrow(_sparse, "lang string, at binary, share binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r[0], bytes(r[1]), bytes(r[2])))
    x = np.zeros((len(rows), BUCKETS * len(ORDERS)), np.float32)
    for row, (_, at, part) in zip(x, rows, strict=True):
        row[np.frombuffer(at, np.int32)] = np.frombuffer(part, np.float32)
    return train(x, [r[0] for r in rows])


def _predict(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = sent.value
        for batch in batches:
            for part, texts in parts(batch):
                names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                rows = [i for i, ok in enumerate(part.column("lettered").to_pylist()) if ok]
                if machines and rows:
                    found, sure = machines.predict(margins(machines, [texts[i] for i in rows]))
                    for i, name, s in zip(rows, found, sure.tolist(), strict=True):
                        names[i], scores[i] = name, s
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["row", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, machines: Machines | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with lang_pred and score of each whole text."""
    carry = Carry(docs, keep, "lang_pred string, score double")
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    # A kept text travels once, as a field of the row.
    asked = docs.select(carry.column.alias("row"), *[c for c in ("text",) if c not in carry.names], lettered)
    return carry.run(asked, _predict(docs.sparkSession.sparkContext.broadcast(machines)))
