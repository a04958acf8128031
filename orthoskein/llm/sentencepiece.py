"""SentencePiece encoding and decoding.

The pieces and scores of a model file drive an Aho-Corasick automaton. One pass
over a text lists, at each position, the pieces that end there (the longest and,
by output links, its suffixes); each relaxes the best score of its end. The best
path is the segmentation of greatest summed score. Characters that no piece
covers become their UTF-8 byte pieces.

White space marks only begin pieces (checked when the model is read), so
segmentations of words are independent: words are encoded one by one and
remembered. Ties go to the path whose last piece is longer.

Literal white-space marks in a text are encoded as bytes, so that decoding gives
every text back exactly. The model is read once by the driver, from a path that
is a parameter, and sent to the tasks (half a megabyte).

Defined results: a null text has null tokens; an empty text has none; an empty
table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .carry import Carry

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Words remembered per task; beyond, the memory starts anew.
REMEMBERED = 200_000
LONGEST_REMEMBERED = 64
UNREACHED = float("-inf")


@dataclass
class Model:
    """Pieces with scores, and the byte pieces for what they don't cover."""

    scores: dict[str, tuple[int, float]]
    text_of: list[bytes]
    byte_ids: list[int]
    byte_score: float
    _automaton: object = field(default=None, repr=False)
    _letters: frozenset | None = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None, "_letters": None}

    @property
    def letters(self) -> frozenset:
        """Characters that are pieces."""
        if self._letters is None:
            self._letters = frozenset(p for p in self.scores if len(p) == 1)
        return self._letters

    @property
    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for piece, (i, score) in self.scores.items():
                self._automaton.add_word(piece, (len(piece), i, score))
            self._automaton.make_automaton()
        return self._automaton


def load(path: str = MODEL) -> Model:
    """Read a model file; control and unknown pieces take no part."""
    with open(path, "rb") as f:
        sp = sentencepiece.SentencePieceProcessor(model_proto=f.read())
    scores, text_of, byte_ids = {}, [], [-1] * 256
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte = int(piece[3:5], 16)
            byte_ids[byte] = i
            text_of.append(bytes([byte]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            text_of.append(b"")
        else:
            scores[piece] = (i, sp.get_score(i))
            text_of.append(piece.replace(SPACE, " ").encode())
    if min(byte_ids) < 0:
        raise ValueError("the model has no byte pieces, so not every text has an encoding")
    if any(SPACE in p.lstrip(SPACE) for p in scores):
        raise ValueError("a piece has a white-space mark behind other characters")
    low = min(s for _, s in scores.values())
    return Model(scores, text_of, byte_ids, low - 10.0)


def viterbi(model: Model, word: str) -> list[int]:
    """Ids of the best segmentation of ``word``, whose spaces are marks."""
    n = len(word)
    best, size_at, id_at = [0.0] + [UNREACHED] * n, [1] * (n + 1), [-1] * (n + 1)
    if model.letters.issuperset(word):
        # Every position has a piece that ends there, so all are reached in order.
        for end, (size, i, score) in model.automaton.iter(word):
            end += 1
            total = best[end - size] + score
            if total > best[end]:
                best[end], size_at[end], id_at[end] = total, size, i
    else:
        at = 0
        for end, (size, i, score) in [*model.automaton.iter(word), (n, (0, -1, 0.0))]:
            while at < min(end, n):
                # Where no piece ends, a character's bytes do.
                at += 1
                if best[at] == UNREACHED:
                    best[at] = best[at - 1] + len(word[at - 1].encode()) * model.byte_score
            if size:
                total = best[end + 1 - size] + score
                if total > best[end + 1]:
                    best[end + 1], size_at[end + 1], id_at[end + 1] = total, size, i
    ids: list[int] = []
    while n:
        if id_at[n] >= 0:
            ids.append(id_at[n])
        else:
            ids.extend(model.byte_ids[b] for b in reversed(word[n - 1].encode()))
        n -= size_at[n]
    ids.reverse()
    return ids


_WORDS = re.compile(" *[^ ]+| +")


class _Known(dict):
    """Encodings of words, as bytes of int32; misses are encoded and kept."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> bytes:
        found = np.array(viterbi(self.model, word.replace(" ", SPACE)), np.int32).tobytes()
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


class Encoder:
    def __init__(self, model: Model):
        self.model = model
        self.known = _Known(model)
        self.mark = np.array([model.byte_ids[b] for b in SPACE.encode()], np.int32).tobytes()
        self.pieces = np.frombuffer(b"".join(model.text_of), np.uint8)
        self.size = np.array([len(t) for t in model.text_of])
        self.begin = np.cumsum(self.size) - self.size

    def encode_bytes(self, text: str) -> bytes:
        """Token ids as bytes of int32; like the library's, with a space put in front."""
        if not text:
            return b""
        # The first part gets the space; literal marks stand between the parts.
        parts = (" " + text).split(SPACE)
        return self.mark.join([b"".join(map(self.known.__getitem__, _WORDS.findall(part))) for part in parts])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        size = self.size[ids]
        total = np.cumsum(size)
        if not len(ids):
            return ""
        at = np.repeat(self.begin[ids] - total + size, size) + np.arange(total[-1])
        return self.pieces[at].tobytes()[1:].decode("utf-8", "replace")


def _encode(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = part.column("text").to_pylist()
                found = [b"" if t is None else encoder.encode_bytes(t) for t in texts]
                same = [t is None or encoder.decode(np.frombuffer(x, np.int32)) == t for x, t in zip(found, texts, strict=True)]
                ends = np.cumsum([0] + [len(x) // 4 for x in found]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(found), np.int32))
                tokens = pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([part.column("row"), tokens, pa.array(same)], names=["row", "tokens", "exact"])

    return run


def _decode(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [None if t is None else encoder.decode(t) for t in part.column("tokens").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], names=["row", "decoded"])

    return run


def encode(docs: DataFrame, keep: list[str], model: Model | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs``, ``tokens`` of the whole text, and ``exact``: they decode to it.

    Kept columns may have any name; those named tokens or exact are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model or load())
    carry = Carry(docs, keep, "tokens array<int>, exact boolean")
    return carry.run(docs.select(carry.column.alias("row"), docs["text"].alias("text")), _encode(sent))


def decode(encoded: DataFrame, keep: list[str], model: Model | None = None) -> DataFrame:
    """Columns ``keep`` of ``encoded`` (but for one named so) and ``decoded``, the text of its ``tokens``."""
    sent = encoded.sparkSession.sparkContext.broadcast(model or load())
    carry = Carry(encoded, keep, "decoded string")
    return carry.run(encoded.select(carry.column.alias("row"), encoded["tokens"].alias("tokens")), _decode(sent))
