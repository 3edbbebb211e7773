"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import settle
from .common import n_words, whole

SLICES = 4096


def text_quality(text: Column) -> Column:
    """Share of letters and white space among the characters, 0.1 at least; 1 for no text."""
    odd = F.length(F.regexp_replace(text, r"[\p{L} \x09-\x0D]+", ""))
    share = 1 - odd / F.greatest(F.length(text), F.lit(1))
    return F.greatest(share, F.lit(0.1))


def source_targets(
    sizes: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
    limit: float = 2.0,
) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, take the ``weights`` in turn.  All targets together
    are ``share`` times all sizes; none is above ``limit`` times its source's size, and what
    that leaves over goes to the others by weight (filling by rising limit over weight: a source
    is limited as long as its limit is below its part of what is left).  One row per source is
    all that the two windows see.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.select("source", "source_size", place.alias("place")).select(
        "*", F.get(cycle, F.col("place") % len(weights)).cast("double").alias("weight"),
        (F.lit(float(limit)) * F.col("source_size")).alias("most"))
    rows = rows.withColumn("ratio", F.col("most") / F.col("weight"))
    order = W.orderBy("ratio", "place")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.orderBy("ratio", "place").rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing)
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("most").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    limited = F.col("ratio") < F.col("level")
    free = F.max(F.when(~limited, F.col("level"))).over(everything)
    return rows.select(
        "source", "source_size",
        F.when(limited, F.col("most")).otherwise(free * F.col("weight")).alias("target"))


def _keys(docs: DataFrame, id_col: str, text: str, source: str, quality: Column | None):
    """(doc_id, source, size, tie, key, slice): exponential keys with the quality as their rate."""
    body = whole(text)
    uniform = (F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))),
                                  1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    rate = text_quality(body) if quality is None else quality
    key = -F.log(uniform) / rate
    return {
        "_mix_id": F.col(id_col), "_mix_source": F.col(source), "_mix_size": n_words(body),
        "_mix_tie": F.crc32(body.cast("binary")), "_mix_key": key,
        "_mix_slice": F.floor(SLICES * key / (1 + key)).cast("int")}


def cuts(rows: DataFrame, **options) -> DataFrame:
    """Per source: its target, the number of whole epochs, and where the fractional one ends.

    ``rows`` is a stored narrow table.  Sizes are first summed by slices of the key range; only
    the slice in which the budget ends is sorted row by row, so a hot source is never sorted
    whole in one task.
    """
    by_slice = rows.groupBy("_mix_source", "_mix_slice").agg(F.sum("_mix_size").alias("size"))
    by_slice = settle(by_slice, "slices")
    totals = by_slice.groupBy(F.col("_mix_source").alias("source")).agg(
        F.sum("size").alias("source_size"))
    plan = source_targets(totals, **options)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    plan = plan.withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("long")).withColumn(
        "budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = settle(plan, "plan")
    order = W.partitionBy("_mix_source").orderBy("_mix_slice")
    running = by_slice.withColumn("through", F.sum("size").over(order))
    ends = running.join(plan, F.col("_mix_source").eqNullSafe(F.col("source"))).where(
        (F.col("through") > F.col("budget")) & (F.col("through") - F.col("size")
                                               <= F.col("budget")))
    ends = ends.groupBy("source").agg(
        F.min(F.struct(F.col("_mix_slice").alias("slice"),
                       (F.col("through") - F.col("size")).alias("before"))).alias("end"))
    ends = settle(plan.alias("p").join(
        ends.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
        .select("p.*", "end"), "ends")
    last = rows.join(ends, F.col("_mix_source").eqNullSafe(F.col("source"))
                     & (F.col("_mix_slice") == F.col("end.slice")))
    place = ["_mix_key", "_mix_id", "_mix_tie"]
    upto = W.partitionBy("source").orderBy(*place).rangeBetween(
        W.unboundedPreceding, W.currentRow)
    last = last.withColumn("through", F.col("end.before") + F.sum("_mix_size").over(upto)).withColumn(
        "peers", F.sum("_mix_size").over(W.partitionBy("source", *place)))
    last = last.where(F.col("through") - F.col("peers") / 2 <= F.col("budget")).groupBy(
        "source").agg(F.max(F.struct(*place)).alias("cut"))
    return settle(ends.alias("p").join(
        last.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
        .select("p.*", "cut"), "cuts")


def _epochs(row_slice: Column, place: Column) -> Column:
    """How often a row is taken, given its source's cut."""
    end = F.col("end.slice")
    first = F.when(end.isNull(), F.col("budget") > 0).when(row_slice < end, True).when(
        row_slice > end, False).otherwise(F.coalesce(place <= F.col("cut"), F.lit(False)))
    return F.col("epochs") + first.cast("long")


def mix(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source",
    quality: Column | None = None, **options,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs``.

    Efraimidis-Spirakis sampling: the key of a document is an exponential variate with the
    document's quality as its rate, taken from a hash of the id, so reruns agree.  Of a target,
    whole epochs of the source come first; the rest goes to the documents with the smallest
    keys, up to the sum of sizes nearest to the budget.

    A null text has size 0, a null source is a source of its own, a null id has a key like any
    other.  Rows that agree in id and text are taken or left together.  An empty table gives no
    rows.  Other columns do not matter.
    """
    rows = settle(docs.select(*[v.alias(k) for k, v in _keys(
        docs, id_col, text, source, quality).items()]), "keys")
    place = F.struct("_mix_key", "_mix_id", "_mix_tie")
    out = rows.join(cuts(rows, **options), F.col("_mix_source").eqNullSafe(F.col("source")))
    copies = _epochs(F.col("_mix_slice"), place)
    return out.select(
        F.col("_mix_id").alias("doc_id"), "source", F.col("_mix_size").alias("size"),
        "source_size", "target", copies.alias("copies"),
        (copies * F.col("_mix_size")).alias("taken"))


def draw(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source",
    quality: Column | None = None, **options,
) -> DataFrame:
    """The mixed documents themselves: each row of ``docs`` as often as ``mix`` takes it.

    The texts are not shuffled by key: one row per source holds all that decides.
    """
    keys = _keys(docs, id_col, text, source, quality)
    rows = settle(docs.select(*[v.alias(k) for k, v in keys.items()]), "keys")
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_mix_row"),
                       *[keys[k].alias(k) for k in (
                           "_mix_id", "_mix_source", "_mix_tie", "_mix_key", "_mix_slice")])
    place = F.struct("_mix_key", "_mix_id", "_mix_tie")
    taken = held.join(cuts(rows, **options), F.col("_mix_source").eqNullSafe(F.col("source")))
    copies = _epochs(F.col("_mix_slice"), place).cast("int")
    taken = taken.select("_mix_row", copies.alias("copies")).where("copies > 0")
    return taken.select("_mix_row", F.explode(F.sequence(F.lit(1), "copies"))).select("_mix_row.*")
