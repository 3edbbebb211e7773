"""Log-likelihood of whole documents by a gated recurrent model trained on the corpus."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import crc_mod, whole
from .recurrent import Network, Shape

END = " "  # no word has a space
HEAD, TAILS = 1024, 16  # tokens with a place of their own in the softmax; classes of all others
DICTIONARY = 200_000  # most frequent words that tasks know by heart; the rest goes through a join
ROUNDS, BLOCK, CHUNK = 3, 1024, 1_500_000
RATE = 0.01  # falls in a straight line to a tenth over the rounds
FLUSH = 300_000  # distinct words after which a task hands on its counts


def _tokens(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes.split() parts at exactly space and U+0009 to U+000D."""
    return text.encode("utf-8", "replace").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the column ``text``, with one END per row, added up per task first."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode() for w in counts], pa.string())
            out = pa.RecordBatch.from_arrays(
                [words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in it:
            counts[END.encode()] += batch.num_rows
            for text in batch.column(0):
                counts.update(_tokens(text.as_py()))
                if len(counts) > FLUSH:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(batches, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).where("n > 0")


def _tail_class(word: Column) -> Column:
    """The class of a word outside the head: its last two bytes, hashed."""
    return (F.crc32(F.substring(word.cast("binary"), -2, 2)) % TAILS).cast("int")


class Lexicon:
    """What tasks know: the most frequent words, their counts, and the shares in tail classes.

    Words of a tail class share its probability: unseen words together get the share that
    words seen once have (Good and Turing's estimate), seen ones the rest by their counts.
    """

    def __init__(self, words: list[str], counts: list[int], tails: dict[int, tuple[int, int]],
                 total: int, distinct: int):
        self.words = [w.encode() for w in words]
        self.n_head = min(HEAD, len(words))
        self.shape = Shape(self.n_head, TAILS)
        self.counts = np.array(counts, np.int64)
        self.total, self.distinct = total, distinct
        sums = np.array([tails.get(k, (0, 0))[0] for k in range(TAILS)], float)
        once = np.array([tails.get(k, (0, 0))[1] for k in range(TAILS)], float)
        self.unseen = (once + 1) / (sums + 2)
        with np.errstate(divide="ignore"):
            self.seen = np.where(sums > 0, (1 - self.unseen) / np.maximum(sums, 1), 0.0)
        classes = np.array([zlib.crc32(w[-2:]) % TAILS for w in self.words], np.int64)
        self.token = np.where(np.arange(len(words)) < self.n_head, np.arange(len(words)),
                              self.shape.first_tail + classes).astype(np.int16)
        inner = np.log10(np.maximum(self.seen[classes] * self.counts, 1e-300))
        self.inner = np.where(np.arange(len(words)) < self.n_head, 0.0, inner)
        self.plus = np.log10(self.counts + 1.0)
        self.start_counts = np.concatenate([self.counts[:self.n_head], sums])
        self._index: dict[bytes, int] | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_index"}

    def __setstate__(self, state):
        self.__dict__.update(state, _index=None)

    def index(self) -> dict[bytes, int]:
        if self._index is None:
            self._index = {w: i for i, w in enumerate(self.words)}
        return self._index


def lexicon(counts: DataFrame) -> Lexicon:
    """Collects the bounded dictionary and a few sums; the full counts stay where they are."""
    # steps of an eighth of a doubling; as many of the highest ones as the dictionary has room for
    step = F.floor(8 * F.log2("n")).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, room = 1_000, DICTIONARY
    for r in sorted(sizes, key=lambda r: -r["step"]):
        room -= r["n"]
        if room < 0:
            break
        least = r["step"]
    top = counts.where((F.col("word") != END) & (step >= least)).collect()
    top.sort(key=lambda r: (-r["n"], r["word"]))
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"),
                      F.sum(F.when(F.col("word") == END, F.col("n"))).alias("ends")).first()
    words = [END] + [r["word"] for r in top]
    tail = counts.where(~F.col("word").isin(words[:HEAD])).groupBy(
        _tail_class(F.col("word")).alias("k")).agg(
        F.sum("n").alias("n"), F.sum((F.col("n") == 1).cast("long")).alias("once"))
    return Lexicon(words, [sums["ends"] or 0] + [r["n"] for r in top],
                   {r["k"]: (r["n"], r["once"]) for r in tail.collect()},
                   sums["n"] or 0, sums["v"])


_CODED = ("row long, doc_id {kind}, held_out boolean, ids binary, known long, plus double, "
          "inner double, rare array<string>, times array<int>")


def coded(rows: DataFrame, lex, kind: str) -> DataFrame:
    """Network tokens of each whole text, its sums over dictionary words, and its other words."""
    schema = _CODED.format(kind=kind)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = lex.value
        find, missing = x.index().get, repeat(-1)
        first_tail = x.shape.first_tail
        for big in it:
            for start in range(0, big.num_rows, 1000):
                batch = big.slice(start, 1000)
                ids, known, plus, inner, rare, times = [], [], [], [], [], []
                for text in batch.column(3):
                    words = _tokens(text.as_py())
                    found = np.fromiter(map(find, words, missing), np.int64, len(words))
                    found = np.append(found, 0)
                    own = x.token[found]
                    at = np.flatnonzero(found < 0)
                    missed = [words[i] for i in at.tolist()]
                    ends = (zlib.crc32(w[-2:]) for w in missed)
                    own[at] = first_tail + np.fromiter(ends, np.int64, len(missed)) % TAILS
                    other = Counter(missed)
                    hit = found[found >= 0]
                    ids.append(own.tobytes())
                    known.append(len(hit))
                    plus.append(float(x.plus[hit].sum()))
                    inner.append(float(x.inner[hit].sum()))
                    rare.append(b" ".join(other).decode().split(" ") if other else [])
                    times.append(list(other.values()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1), batch.column(2),
                    pa.array(ids, pa.binary()), pa.array(known, pa.int64()), pa.array(plus, pa.float64()),
                    pa.array(inner, pa.float64()), pa.array(rare, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int32())),
                ], names=["row", "doc_id", "held_out", "ids", "known", "plus", "inner", "rare",
                          "times"])

    return rows.select("row", "doc_id", "held_out", "text").mapInArrow(batches, schema)


def _texts(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The column ``ids``: 16-bit tokens of whole texts, as bytes."""
    column = batch.column(batch.schema.get_field_index("ids"))
    return [np.frombuffer(b, np.int16).astype(np.int32) for b in column.to_pylist()]


def train(
    texts: DataFrame, lex, start: np.ndarray, shape: Shape, rates: tuple[float, float],
) -> np.ndarray:
    """Weights after one pass over ``texts`` (ids): each task trains on its own texts from the
    same start, and the results are averaged by tokens, block by block on the executors."""
    def local(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, state = Network(lex.value.shape, start.copy()), {}
        chunk, size, total = [], 0, 0
        for batch in it:
            for ids in _texts(batch):
                chunk.append(ids)
                size += len(ids)
                if size >= CHUNK:
                    net.train(chunk, state, rates)
                    total, chunk, size = total + size, [], 0
        if chunk:
            net.train(chunk, state, rates)
            total += size
        if total:
            flat = np.pad(net.flat, (0, -len(net.flat) % BLOCK)).reshape(-1, BLOCK)
            yield pa.RecordBatch.from_arrays([
                pa.array(range(len(flat)), pa.int32()),
                pa.array([float(total)] * len(flat), pa.float64()),
                pa.array(list(flat.astype(np.float64)), pa.list_(pa.float64()))],
                names=["block", "tokens", "v"])

    parts = texts.select("ids").mapInArrow(local, "block int, tokens double, v array<double>")
    mean = parts.groupBy("block").agg(
        Summarizer.mean(array_to_vector("v"), F.col("tokens")).alias("v"))
    out = np.zeros((-(-shape.size // BLOCK), BLOCK), np.float32)
    rows = mean.select("block", vector_to_array("v").alias("v")).collect()
    for r in rows:
        out[r["block"]] = r["v"]
    return out.ravel()[:shape.size] if rows else start


def score_texts(rows: DataFrame, lex, weights: np.ndarray, kind: str) -> DataFrame:
    """(row, doc_id, held_out, n_tokens, known, plus, part): log10 of all but the rare words."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(lex.value.shape, weights)
        held: list[tuple[pa.RecordBatch, list[np.ndarray]]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            texts = [ids for _, own in held for ids in own]
            parts = net.score(texts) / math.log(10)
            at = 0
            for b, ids in held:
                own = parts[at:at + b.num_rows] + b.column(5).to_numpy()
                sizes = np.array([len(i) for i in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.array(sizes), b.column(3),
                     b.column(4), pa.array(own)],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "plus", "part"])
                at += b.num_rows

        for batch in it:
            held.append((batch, _texts(batch)))
            size += sum(map(len, held[-1][1]))
            if size >= CHUNK:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return rows.select("row", "doc_id", "held_out", "known", "plus", "inner", "ids").mapInArrow(
        batches, f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, "
                 "plus double, part double")


def score_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", folds: int = 7, out: int = 2,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Words are counted and the network is trained on all rows but those whose crc32 of the id mod
    ``folds`` is ``out`` (``held_out``).  The softmax has classes of the HEAD most frequent
    tokens and TAILS classes of all other words, which share their class's probability by their
    counts; all is one distribution over the training words and unseen words.  Training goes
    once over all training texts, in ROUNDS disjoint parts by a hash of the id (of a row without
    one, its place): in each, tasks train on their own texts and the weights are averaged, so
    weights differ a little where files are laid out otherwise.  Scoring carries the state through each whole text.

    Words beyond the DICTIONARY most frequent are looked up by a join of (row, word, times).  A
    null text is an empty one (its end token alone); rows with a null id are training rows; equal
    rows are rows of their own; no rows give no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        (crc_mod(id_col, folds) == out).alias("held_out"), whole(text).alias("text"))
    counts = settle(word_counts(rows.where("NOT held_out")), "counts")
    lex = lexicon(counts)
    sent = spark.sparkContext.broadcast(lex)
    texts = settle(coded(rows, sent, kind), "coded")

    weights = lex.shape.initial(lex.start_counts)
    own_id = F.coalesce(F.col("doc_id").cast("string"), F.col("row").cast("string"))
    part = F.pmod(F.xxhash64(own_id), F.lit(ROUNDS))
    for r in range(ROUNDS):
        rates = RATE * (1 - 0.9 * r / ROUNDS), RATE * (1 - 0.9 * (r + 1) / ROUNDS)
        own = texts.where(~F.col("held_out") & (part == r))
        weights = train(own, sent, weights, lex.shape, rates)
    scored = score_texts(texts, sent, weights, kind)

    other = texts.where(F.size("rare") > 0).select(
        "row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    k = _tail_class(F.col("word"))
    unseen, seen = (F.get(F.array(*[F.lit(float(v)) for v in a]), k)
                    for a in (lex.unseen, lex.seen))
    n = F.coalesce("n", F.lit(0))
    share = F.when(n > 0, seen * n).otherwise(unseen)
    rare = other.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(n + F.lit(1.0))).alias("rare_plus"),
        F.sum(F.col("times") * F.log10(share)).alias("rare_part"))
    size = math.log10(lex.total + lex.distinct + 1)
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("rare_known", "rare_plus", "rare_part")}
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + zero["rare_known"]).cast("long").alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("plus") + zero["rare_plus"] - F.col("n_tokens") * size).alias("base_score"),
        (F.col("part") + zero["rare_part"]).alias("score"))
