"""SentencePiece encoding by one Viterbi pass over an Aho-Corasick automaton, and decoding."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: below the least piece score, as in the library
CACHE, LONG = 150_000, 48  # segments per generation of a task's cache; longer ones are not kept
ROWS = 500  # rows per result batch
_NONE = None


class Vocabulary:
    """The pieces of a model file, with an automaton over those that text can match."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalise = sp.normalize
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.unknown = sp.unk_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)
                   for i in range(len(pieces))]
        scores = [sp.get_score(i) for i in range(len(pieces))]
        plain = [i for i in range(len(pieces)) if not special[i]]
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(pieces[i], (len(pieces[i]), i, scores[i]))
        self.automaton.make_automaton()
        self.gap = (1, -1, 0.0)
        self.unknown_score = min((scores[i] for i in plain), default=0.0) - UNKNOWN_PENALTY
        self.bytes = {int(pieces[i][3:5], 16): i for i in range(len(pieces)) if sp.is_byte(i)}
        self.as_bytes = [
            bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i)
            else " ⁇ ".encode() if i == self.unknown else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)]
        self.prefix = self.normalise("a")[:1] == SPACE
        # no piece goes on over these places, so that texts fall into parts scored one by one
        at_space = not any(re.search(f"[^{SPACE}]{SPACE}", pieces[i]) for i in plain)
        at_line = not any("\n" in pieces[i] and len(pieces[i]) > 1 for i in plain)
        line = "\n" if at_line else ""
        self.segments = re.compile(
            (f"{SPACE}+[^{SPACE}{line}]*|[^{SPACE}{line}]+" if at_space else f"[^{line}]+")
            + ("|\n" if at_line else "") if at_space or at_line else r".+", re.S).findall
        self.young: dict[str, tuple[bytes, float]] = {}
        self.old: dict[str, tuple[bytes, float]] = {}

    def viterbi(self, text: str) -> tuple[list[int], float]:
        """The ids of the segmentation with the largest sum of scores, and that sum.

        The automaton reports at each position all pieces that end there, the longest first (its
        output links); each is an edge from where it starts, whose best score is final by then.
        A character that no piece ends at is unknown.  Of equal sums the longer last piece wins.
        """
        n = len(text)
        best, back = [_NONE] * (n + 1), [self.gap] * (n + 1)
        best[0], done = 0.0, 0
        for end, edge in self.automaton.iter(text):
            if end != done:
                if best[end] is _NONE or end != done + 1:
                    self._fill(best, done, end)
                done = end
            to = end + 1
            total = best[to - edge[0]] + edge[2]
            if best[to] is _NONE or total > best[to]:
                best[to], back[to] = total, edge
        self._fill(best, done, n)
        ids, at = [], n
        while at:
            length, piece, _ = back[at]
            if piece >= 0:
                ids.append(piece)
            elif self.bytes:
                ids += [self.bytes[b] for b in reversed(text[at - 1].encode())]
            else:
                ids.append(self.unknown)
            at -= length
        return ids[::-1], best[n]

    def _fill(self, best: list, start: int, to: int) -> None:
        """Scores of positions after ``start``, up to ``to``, that no piece ends at."""
        for k in range(start + 1, to + 1):
            if best[k] is _NONE:
                best[k] = best[k - 1] + self.unknown_score

    def _segment(self, s: str) -> tuple[bytes, float]:
        found = self.old.get(s)
        if found is None:
            ids, score = self.viterbi(s)
            found = array("i", ids).tobytes(), score
        if len(s) <= LONG:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[s] = found
        return found

    def encode(self, text: str) -> tuple[np.ndarray, float]:
        """Ids and score of the whole text, part by part; parts seen lately come from a cache."""
        get, segment = self.young.get, self._segment
        parts = []
        for s in self.segments(self.normalise(text)):
            found = get(s)
            if found is None:
                found = segment(s)
                get = self.young.get
            parts.append(found)
        return (np.frombuffer(b"".join([p[0] for p in parts]), np.int32),
                float(sum([p[1] for p in parts])))

    def decode(self, ids) -> str:
        table = self.as_bytes
        text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


class Coder:
    """Codes texts one by one; one that comes again at once, as the copies of a document that a mix
    takes more than once do, has the result of the one before."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.text, self.coded = None, None

    def code(self, text: str) -> tuple[np.ndarray, float, str]:
        """Ids and score of the whole text, and the text that the ids give back."""
        if text != self.text:
            ids, score = self.vocabulary.encode(text)
            self.text, self.coded = text, (ids, score, self.vocabulary.decode(ids.tolist()))
        return self.coded


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(model: bytes) -> Vocabulary:
    key = hash(model)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(model)
    return _LOADED[key]


def read_model(path: str = MODEL) -> bytes:
    """The model file, read at the driver and sent along with the tasks (its size is fixed)."""
    with open(path, "rb") as f:
        return f.read()


def encode_decode(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", model: str = MODEL,
) -> DataFrame:
    """(doc_id, n_pieces, score, ids, decoded, exact) for every row of ``docs``.

    ``ids`` is the segmentation of the whole normalised text with the largest sum of piece
    scores, characters without a piece as bytes; ``decoded`` is the text those ids give back, and
    ``exact`` tells whether it is the original (a text with U+2581 in it cannot be).  A null text
    counts as empty: no ids, score 0.  Ids may be null or repeat; other columns do not matter.
    """
    blob = read_model(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Coder(_vocabulary(blob))
        for whole_batch in it:
            for start in range(0, whole_batch.num_rows, ROWS):
                batch = whole_batch.slice(start, ROWS)
                texts = batch.column(1).to_pylist()
                coded = [v.code(t) for t in texts]
                sizes = np.array([len(c[0]) for c in coded], np.int64)
                offsets = np.zeros(len(coded) + 1, np.int32)
                np.cumsum(sizes, out=offsets[1:])
                flat = np.concatenate([c[0] for c in coded]) if coded else np.empty(0, np.int32)
                decoded = [c[2] for c in coded]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(sizes), pa.array([c[1] for c in coded], pa.float64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array(decoded, pa.string()),
                    pa.array([a == b for a, b in zip(texts, decoded)], pa.bool_()),
                ], names=["doc_id", "n_pieces", "score", "ids", "decoded", "exact"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), whole(text).alias("text")).mapInArrow(
        batches, f"doc_id {kind}, n_pieces long, score double, ids array<int>, decoded string, "
                 "exact boolean")


def decode_ids(coded: DataFrame, *, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``coded`` with a column ``decoded`` for the texts of its id lists; null stays null."""
    blob = read_model(model)

    @F.pandas_udf("string")
    def decoded(lists):
        v = _vocabulary(blob)
        return lists.map(lambda x: None if x is None else v.decode(x))

    return coded.withColumn("decoded", decoded(F.col(ids)))
