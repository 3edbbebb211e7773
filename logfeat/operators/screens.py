"""Bitmaps asked row by row before a shuffle: what they pass over surely does not match."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle, settle_and_see
from .matrix import doc_freq, keep_features

WORD = 64
MOST_BITS = 1 << 26  # of a bitmap that travels: 8 MB
KEY_BITS = 12  # bits a key: with three places a key about one foreign row in fifty passes
PLACES = 3
LANE = 8  # counters of a sketch that travel in one row


def _places(cols: Sequence[str], bits: int, places: int = PLACES) -> list[Column]:
    """Positions of a key in a bitmap of ``bits`` bits: independent hashes of the key."""
    return [F.pmod(F.xxhash64(F.lit(i), *cols), F.lit(bits)) for i in range(places)]


def bitmap(positions: DataFrame, bits: int) -> DataFrame:
    """One row with an array of bits / 64 words; the bits of column ``pos`` are set.

    Words are combined by bit_or before the shuffle, so it moves bits / 64 rows a task at most.
    """
    rows = positions.selectExpr(
        f"pos div {WORD} AS word", f"shiftleft(1L, CAST(pos % {WORD} AS INT)) AS bits")
    empty = positions.sparkSession.range(bits // WORD).selectExpr("id AS word", "0L AS bits")
    words = rows.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return words.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w")).selectExpr(
        "transform(w, x -> x.bits) AS words")


def all_set(words: Column, positions: Sequence[Column]) -> Column:
    """Whether the bitmap has all of these positions."""
    return reduce(lambda a, b: a & b, [
        F.get(words, (p / WORD).cast("int")).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("long"), (p % WORD).cast("int"))) != 0
        for p in positions])


def _stored(listed: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame | None, int]:
    """(distinct keys without nulls, their stored bitmap, its bits); too many keys give no bitmap."""
    keys, seen = settle_and_see(
        listed.select(*on).dropna().distinct(), "keys", n=F.count(F.lit(1)))
    bits = WORD
    while bits < seen["n"] * KEY_BITS:
        bits *= 2
    if bits > MOST_BITS:
        return keys, None, bits
    at = keys.select(F.explode(F.array(*_places(on, bits))).alias("pos"))
    return keys, settle(bitmap(at, bits), "bitmap"), bits


def screened_known(df: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """keep_known(), where rows that surely match nothing leave before they are shuffled.

    Worth its pass over ``known`` where that is too large to be broadcast itself and most
    rows match nothing.  Beyond MOST_BITS / KEY_BITS keys the join alone decides.
    """
    on = list(on)
    keys, words, bits = _stored(known, on)
    if words is not None:
        df = df.where(all_set(words.scalar(), _places(on, bits)))
    return df.join(keys, on, "left_semi")


def screened_exclude(df: DataFrame, listed: DataFrame, on: Sequence[str]) -> DataFrame:
    """exclude(), where rows that surely match nothing stay without being shuffled.

    ``df`` is read twice, so give it stored.  Rows with a null in their key stay.
    """
    on = list(on)
    keys, words, bits = _stored(listed, on)
    if words is None:
        return df.join(keys, on, "left_anti")
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    perhaps = whole & all_set(words.scalar(), _places(on, bits))
    return df.where(~perhaps).unionByName(df.where(perhaps).join(keys, on, "left_anti"))


def screened_doc_freq(coo: DataFrame, t: int, bits: int = 1 << 22, places: int = 2) -> DataFrame:
    """min_doc_freq(): a count-min sketch first, then exact counts of what is left.

    Each feature adds to one counter a row of the sketch; a counter never undercounts, so a feature
    with a counter of t or less occurs in t entities at most and its cells leave before the
    shuffle.  Counters are combined in the tasks, ``bits`` of them a row of the sketch and LANE
    neighbours a row of a task; with many more features than that fewer cells leave, and the
    result is the same.
    """
    coo = settle(coo, "cells")
    at = [F.pmod(F.xxhash64(F.lit(i), "feature"), F.lit(bits)) for i in range(places)]
    lanes = coo.select(F.explode(F.array(*[
        p + F.lit(i * bits) for i, p in enumerate(at)])).alias("pos")).groupBy(
        F.expr(f"pos div {LANE}").alias("lane")).agg(*[
            F.count_if(F.expr(f"pos % {LANE} = {j}")).alias(f"n{j}") for j in range(LANE)])
    counters = lanes.select(F.explode(F.array(*[
        F.struct((F.col("lane") * LANE + j).alias("pos"), F.col(f"n{j}").alias("n"))
        for j in range(LANE)])).alias("c")).select("c.*")
    words = settle(bitmap(counters.where(F.col("n") > t).select("pos"), bits * places), "sketch")
    perhaps = coo.where(all_set(words.scalar(), [p + F.lit(i * bits) for i, p in enumerate(at)]))
    return keep_features(perhaps, settle(doc_freq(perhaps).where(F.col("df") > t), "kept"))
