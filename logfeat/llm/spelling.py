"""Spelling variants: words one edit apart, found by walking a trie that is a table of its edges."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import whole

AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
DEEPEST = 24  # the trie holds words of at most so many code points, _far() sees to the rest


def count_words(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
    min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int | None = None,
) -> DataFrame:
    """(word, n): the runs of letters that occur often enough, A-Z lower-cased.

    Letters are A-Z, a-z and U+00C0 to U+00FF.  With ``slip``, a run whose h = crc32 of
    ``<id>:<run>`` is a multiple of ``slip`` loses its code point h % length before it is counted
    (errors as of a typist, but the same ones every time); a null id counts as an empty one.
    Null and empty texts have no words; repeated rows count again; no rows give no words.
    """
    runs = F.regexp_extract_all(whole(text), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(runs).alias("run"))
    word = F.translate("run", AZ, AZ.lower())
    if slip:
        rows = rows.select("id", word.alias("run"))
        h, at = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")), F.col("h") % F.length("run")
        cut = F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))
        rows = rows.select("run", h.alias("h")).withColumn("at", at.cast("int"))
        word = F.when(F.col("h") % slip == 0, cut).otherwise(F.col("run"))
    found = rows.select(word.alias("word")).where(F.length("word") >= min_length)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# -- the trie

def _spelled(words: DataFrame) -> DataFrame:
    """(word, s, size, low) per direction: the word read forwards and backwards.

    ``s`` starts with a mark of its direction, so both tries are one.  An edit in the second half
    of a word is looked for forwards, one in the first half backwards; in either case the walk
    branches only from ``low`` on, past the crowded top of the trie.
    """
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    both = F.array(
        F.struct(F.concat(F.lit(">"), "word").alias("s"), (half + 1).alias("low")),
        F.struct(F.concat(F.lit("<"), F.reverse("word")).alias("s"), (size - half + 1).alias("low")))
    return words.select("word", (size + 1).alias("size"), F.explode(both).alias("b")).select(
        "word", "size", "b.*")


def _nodes(spelled: DataFrame) -> DataFrame:
    """(depth, node, next, ends): the letters that follow a prefix, and whether it is a word."""
    depth = F.explode(F.expr("sequence(least(low, size), size)")).alias("depth")
    rows = spelled.select("s", "size", depth)
    return rows.select(
        "depth", F.expr("left(s, depth)").alias("node"),
        F.when(F.col("depth") < F.col("size"), F.expr("substring(s, depth + 1, 1)")).alias("c"),
    ).groupBy("depth", "node").agg(
        F.array_sort(F.collect_set("c")).alias("next"), F.bool_or(F.col("c").isNull()).alias("ends"))


def _letter(s: Column | str, at: Column) -> Column:
    """The letter at ``at`` (from 0), empty past the end."""
    return F.substring(s, at + 1, F.lit(1))


def _step(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """One level down: (word, s, at, node, done) of the states that have an edge to go on by.

    A state without an edit (``edits`` 0) stands on the word's own path.  It may put a later
    letter in place of its next one, or leave that out; the states that come of it have their one
    edit and can only follow the rest of the word.  A word lacks no neighbour for this: what an
    earlier letter or an insertion would give is found from the other word.
    """
    size, at = F.length("s"), F.col("at")
    here, after = _letter("s", at), _letter("s", at + 1)

    def move(c: Column, to: Column, done: Column = F.lit(False)) -> Column:
        return F.struct(c.alias("c"), to.cast("int").alias("to"), done.alias("done"))

    none = F.array().cast("array<struct<c:string,to:int,done:boolean>>")
    exact = F.when(at == size, F.when(F.col("ends"), F.array(move(F.lit(""), at, F.lit(True))))
                   ).when(F.array_contains("next", here), F.array(move(here, at + 1)))
    other = F.transform(F.filter("next", lambda c: c > here), lambda c: move(c, at + 1))
    # of a run of equal letters the last one is left out
    left_out = F.when(here == after, none).when(
        at + 1 == size, F.when(F.col("ends"), F.array(move(F.lit(""), at, F.lit(True))))
    ).when(F.array_contains("next", after), F.array(move(after, at + 2)))
    edit = F.when(at < size, F.concat(other, F.coalesce(left_out, none)))
    moves = F.when(F.col("edits") == 0, edit).otherwise(exact)
    return states.join(nodes, "node").select("word", "s", "node", F.explode(moves).alias("m")).select(
        "word", "s", F.col("m.to").alias("at"), F.concat("node", "m.c").alias("node"), "m.done")


def _walk(words: DataFrame) -> DataFrame:
    """(word, near): pairs of words of at most DEEPEST letters, each found from one side."""
    spelled = settle(_spelled(words), "spelled")
    nodes = settle(_nodes(spelled), "nodes")
    deepest = spelled.agg(F.max("size")).first()[0] or 0
    lowest = spelled.agg(F.min("low")).first()[0] or 0
    edited, levels = None, []
    for depth in range(lowest, deepest + 1):
        states = spelled.where(f"low <= {depth} AND {depth} <= size").select(
            "word", "s", F.lit(depth).alias("at"), F.expr(f"left(s, {depth})").alias("node"),
            F.lit(0).alias("edits"))
        if edited is not None:
            states = states.unionByName(edited.withColumn("edits", F.lit(1)))
        level = nodes.where(F.col("depth") == depth).select("node", "next", "ends")
        stored = settle(_step(states, level), "level")
        levels.append(stored.where("done"))
        edited = stored.where("NOT done").drop("done")
    if not levels:
        return words.select("word", F.col("word").alias("near")).limit(0)
    ends = reduce(DataFrame.unionByName, levels)
    way = F.substring("node", 2, DEEPEST + 1)
    return ends.select("word", F.when(F.expr("left(node, 1) = '>'"), way).otherwise(
        F.reverse(way)).alias("near"))


# -- words beyond the trie

def _gapped(words: DataFrame) -> DataFrame:
    """(word, at, rest): 64-bit hashes of a word without its letter ``at``; -1 leaves none out.

    With sums of letter * B^position modulo 2^64 every gap takes one step: what lies after it
    moves down by one position.
    """
    base = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
    inverse = pow(base, -1, 1 << 64)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for word in batch.column(0):
                codes = np.frombuffer(word.as_py().encode("utf-32-le"), np.uint32).astype(np.uint64)
                with np.errstate(over="ignore"):
                    powers = np.full(len(codes), base, np.uint64)
                    powers[0] = 1
                    terms = np.cumsum((codes + np.uint64(1)) * np.cumprod(powers))
                    before = np.concatenate([np.zeros(1, np.uint64), terms[:-1]])
                    gaps = before + (terms[-1] - terms) * np.uint64(inverse)
                rest = np.concatenate([terms[-1:], gaps]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(word, len(rest)), pa.array(np.arange(-1, len(codes)), pa.int32()),
                     pa.array(rest)], names=["word", "at", "rest"])

    return words.select("word").mapInArrow(batches, "word string, at int, rest long")


def _far(words: DataFrame) -> DataFrame:
    """(word, near) of words beyond DEEPEST: equal but for one place, or one without a letter of
    the other.  Rows that meet are true neighbours but for collisions, which are checked; so no
    group has more members than there are letters."""
    ids = settle(words.select("word", F.xxhash64("word").alias("id")), "long")
    gaps = settle(_gapped(ids).select(F.xxhash64("word").alias("id"), "at", "rest"), "gaps")
    a, b = gaps.alias("a"), gaps.alias("b")
    swapped = a.join(b, (F.col("a.rest") == F.col("b.rest")) & (F.col("a.at") == F.col("b.at"))
                     & (F.col("a.at") >= 0) & (F.col("a.id") < F.col("b.id")))
    shorter = a.join(b, (F.col("a.rest") == F.col("b.rest")) & (F.col("a.at") >= 0)
                     & (F.col("b.at") == -1))
    ends = [met.select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))
            for met in (swapped, shorter)]
    ends = ends[0].union(ends[1]).distinct()
    pairs = ends.join(ids.select(F.col("id").alias("x"), "word"), "x").join(
        ids.select(F.col("id").alias("y"), F.col("word").alias("near")), "y")
    return pairs.where(F.levenshtein("word", "near", 1) == 1).select("word", "near")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near) both ways round: distinct words that differ by one inserted, deleted or
    replaced code point.  ``words`` has distinct non-null words of two code points or more."""
    found = _walk(words.where(F.length("word") <= DEEPEST))
    long = settle(words.where(F.length("word") >= DEEPEST).select("word"), "long")
    if not long.where(F.length("word") > DEEPEST).isEmpty():
        found = found.unionByName(_far(long))
    both = F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"),
                                                      F.col("word").alias("near")))
    return found.select(F.explode(both).alias("p")).select("p.*").distinct()


def variants(counts: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``counts`` (distinct words, n).

    A word's form is its most frequent near word (ties: the smallest in code-point order) if that
    is at least ``ratio`` (above 1) times as frequent; ``root`` is where forms lead to in the end.
    Frequencies grow along that way, so it ends after a logarithm of the largest.  No words give
    no rows.
    """
    counts = settle(counts.select("word", "n"), "counts")
    pairs = near_words(counts)
    best = pairs.join(counts.select(F.col("word").alias("near"), "n"), "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), "near")).alias("b"))
    rows = counts.join(best, "word", "left")
    is_form = -F.col("b.m") >= ratio * F.col("n")
    rows = settle(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("b.near")).alias("form"), F.when(is_form, -F.col("b.m")).alias("form_n")),
        "forms")
    roots = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the way
        stored = settle(roots, "roots")
        jump = stored.select(F.col("word").alias("root"), F.col("root").alias("on"))
        further = stored.join(jump, "root", "left")
        if further.where("on IS NOT NULL").isEmpty():
            break
        roots = further.select("word", F.coalesce("on", "root").alias("root"))
    return rows.join(stored, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, *, ratio: int = RATIO, **options) -> DataFrame:
    """variants() of the words of whole texts; ``options`` are those of count_words()."""
    return variants(count_words(docs, **options), ratio=ratio)
