"""Values at given ranks by radix selection: no sort, no window and no gathered groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle

BITS = 6  # leading bits a level tells apart; 64-bit keys need eleven levels at most
FIELDS, FULL = 7, 127  # counters of eight bits in a bigint of a packed histogram, rows they count
SPAN = FIELDS << BITS  # cells of a histogram of as many bigints as a level's


def order_key(x: str) -> str:
    """SQL for a bigint that orders as the double ``x`` does: its exponent, then its fraction.

    Zeros are equal and NaN is above infinity, as in Spark's own order.  Powers of two are
    exact, so the exponent that log2() rounds is put right by comparing with them.
    """
    a = f"abs({x})"
    near = f"CAST(greatest(-1022D, least(1023D, coalesce(floor(log2({a})), -1022))) AS INT)"
    exact = (f"transform(array({near}), e -> e + CASE WHEN {a} >= pow(2D, e + 1) THEN 1 "
             f"WHEN e > -1022 AND {a} < pow(2D, e) THEN -1 ELSE 0 END)")
    size = (f"CASE WHEN isnan({x}) THEN 9218868437227405313 "
            f"WHEN {a} = double('inf') THEN 9218868437227405312 "
            f"WHEN {a} < pow(2D, -1022) THEN CAST({a} / pow(2D, -1022) * pow(2D, 52) AS BIGINT) "
            f"ELSE transform({exact}, e -> (e + 1023) * 4503599627370496 + "
            f"CAST(({a} / pow(2D, e) - 1) * 4503599627370496D AS BIGINT))[0] END")
    return f"({size}) * CASE WHEN {x} < 0 THEN -1 ELSE 1 END"


def _shift(low: str, high: str) -> str:
    """SQL for the shift after which at most 2^BITS neighbours of common leading bits are left."""
    return (f"CASE WHEN ({low} < 0) != ({high} < 0) THEN {64 - BITS} "
            f"ELSE greatest(0, length(bin({low} ^ {high})) - {BITS}) END")


def select_ranks(cells: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., r, key): the key at each wanted rank (from 0) of a group's keys in ascending order.

    ``cells`` has one row (by..., key, n) per group and distinct bigint key, n rows each; ``wanted``
    has rows (by..., r) with 0 <= r < the group's sum of n.  Repeated wishes give one row.

    A level counts the next leading bits below the smallest and largest key still in question.
    Counts combine before the shuffle, a histogram has 64 cells, and only the cells that hold
    a wanted rank go on, stored, so the second level already reads a small part.  A cell
    with one key ends the search.  Groups may have any size; adaptive execution splits a
    hot group's cells in the join with its one row of bounds.
    """
    by = list(by)
    ends = cells.groupBy(*by).agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    open_ = settle(wanted.select(*by, "r").distinct().join(ends, by).selectExpr(
        *by, "r", "lo", "hi", "CAST(0 AS BIGINT) AS below"), "open")
    found: list[DataFrame] = []
    while True:
        found.append(open_.where("lo = hi").select(*by, "r", F.col("lo").alias("key")))
        left = open_.where("lo < hi")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, found)
        spans = left.select(*by, "lo", "hi").distinct().selectExpr(
            "*", f"{_shift('lo', 'hi')} AS shift")
        cells = settle(cells.join(spans.select(*by, "lo", "hi", "shift"), by).where(
            "key BETWEEN lo AND hi").selectExpr(
            *by, "key", "n", "lo", "shiftright(key, shift) - shiftright(lo, shift) AS b"), "cells")
        hist = settle(cells.groupBy(*by, "lo", "b").agg(
            F.sum("n").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")), "hist")
        counts = hist.groupBy(*by, "lo").agg(F.expr("array({})".format(", ".join(
            f"sum(CASE WHEN b = {j} THEN n ELSE 0 END)" for j in range(1 << BITS)))).alias("h"))
        # the cell whose running count passes r, and what lies below it
        place = ("aggregate(h, named_struct('b', CAST(-1 AS BIGINT), 'i', CAST(0 AS BIGINT), "
                 "'run', below, 'below', below), (a, x) -> named_struct("
                 "'b', CASE WHEN a.b < 0 AND r < a.run + x THEN a.i ELSE a.b END, 'i', a.i + 1, "
                 "'run', a.run + x, 'below', CASE WHEN a.b < 0 AND r < a.run + x THEN a.run "
                 "ELSE a.below END))")
        placed = left.join(counts, [*by, "lo"]).selectExpr(*by, "lo", "r", f"{place} AS p")
        open_ = settle(placed.selectExpr(*by, "lo", "r", "p.b AS b", "p.below AS below").join(
            hist.select(*by, "lo", "b", "low", "high"), [*by, "lo", "b"]).selectExpr(
            *by, "r", "low AS lo", "high AS hi", "below"), "open")
        cells = cells.select(*by, "key", "n")


def packed_counts(col: str, low: int, high: int) -> list[str]:
    """SQL aggregates: the counts of each whole number from ``low`` to ``high`` in at most FULL rows.

    The number's last bits at once, as a level that ends the search; nulls are not counted.
    """
    at = f"(CAST({col} AS BIGINT) - ({low}L))"
    return [f"coalesce(sum(CASE WHEN {at} DIV {FIELDS} = {j} THEN shiftleft(1L, CAST("
            f"8 * ({at} % {FIELDS}) AS INT)) END), 0L)" for j in range((high - low) // FIELDS + 1)]


def running_counts(words: str) -> str:
    """SQL for an array of packed counts with each counter, from the word's first one, summed up.

    The sums stay within eight bits, so none reaches the next one; the last byte is the total.
    """
    return reduce(lambda x, n: f"transform({x}, w -> w + shiftleft(w, {n}))", (8, 16, 32), words)


def packed_place(running: str, rank: str) -> str:
    """SQL for the cell of a packed histogram, from its running counts, that has the row at ``rank``.

    Words whose rows all lie before are passed over; in the next one every counter that exceeds
    what is left keeps its byte's first bit in the subtraction, and the others are counted.
    """
    ones = sum(1 << 8 * k for k in range(FIELDS))
    tops, bytes_ = ones << 7, (1 << 8 * FIELDS) - 1
    return (f"aggregate({running}, named_struct('left', {rank}, 'at', 0L), (a, w) -> CASE "
            f"WHEN a.left < 0 THEN a WHEN a.left >= shiftright(w, {8 * FIELDS}) THEN named_struct("
            f"'left', a.left - shiftright(w, {8 * FIELDS}), 'at', a.at + {FIELDS}L) "
            f"ELSE named_struct('left', -1L, 'at', a.at + {FIELDS}L - CAST(bit_count((((w & {bytes_}L) "
            f"| {tops}L) - (a.left + 1L) * {ones}L) & {tops}L) AS BIGINT)) END, a -> a.at)")


def point_ranks(last: Column, points: Sequence[float]) -> Column:
    """All ranks that interpolated percentiles of last + 1 values look at."""
    at = [last * F.lit(p) for p in points]
    return F.array_distinct(F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)]))


def radix_points(df: DataFrame, by: str, cols: Sequence[str], points: Sequence[float]) -> DataFrame:
    """Exact interpolated percentiles ``__<col>_<i>`` of non-null values, by select_ranks().

    All columns are searched at once.  Equal values are counted before the shuffle; which
    value a key stands for is kept beside its cell and joined to the few keys found.
    """
    pairs = ", ".join(f"{i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    # 0D: a negative zero becomes the other one
    counted = df.selectExpr(f"`{by}`", f"stack({len(cols)}, {pairs}) AS (c, v)").where(
        "v IS NOT NULL").selectExpr(f"`{by}`", "c", "v + 0D AS v").groupBy(by, "c", "v").agg(
        F.count(F.lit(1)).alias("n"))
    cells = settle(counted.selectExpr("*", f"{order_key('v')} AS key"), "keys")
    lasts = settle(cells.groupBy(by, "c").agg((F.sum("n") - 1).alias("last")), "lasts")
    wanted = lasts.select(by, "c", F.explode(point_ranks(F.col("last"), points)).alias("r"))
    keys = select_ranks(cells.select(by, "c", "key", "n"), wanted, [by, "c"])
    found = keys.join(cells.select(by, "c", "key", "v"), [by, "c", "key"]).join(lasts, [by, "c"])
    aggs = []
    for j, c in enumerate(cols):
        for i, p in enumerate(points):
            at, mine = F.col("last") * F.lit(p), F.col("c") == j
            low, high = (F.max(F.when(mine & (F.col("r") == f(at)), F.col("v")))
                         for f in (F.floor, F.ceil))
            share = F.max(F.when(mine, at))
            aggs.append(F.when(F.floor(share) == F.ceil(share), low).otherwise(
                (F.ceil(share) - share) * low + (share - F.floor(share)) * high
            ).alias(f"__{c}_{i}"))
    return found.groupBy(by).agg(*aggs)
