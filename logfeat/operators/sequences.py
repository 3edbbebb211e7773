"""Ordered lists per entity and the inputs of sequence models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import count_char, count_digits, integer_div, pad_sequence
from ..session import settle
from .gaps import group_gap
from .keys import attach, attach_by_fold, code_table
from .ordered import over_ordered
from .rollup import rollup_stats
from .target_stats import target_stats

CHUNK_ROWS = 100_000


def collect_sequence(
    log: DataFrame, cols: Sequence[str], entity: str = "entity",
    order: Sequence[str] = ("us", "rid"), *, chunk_rows: int = CHUNK_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """(entity, chunk, one array per column), in log order and with nulls kept.

    A list of more than ``chunk_rows`` elements continues in the next chunk, so a
    hot entity is neither cut off nor gathered in one row.
    """
    used = list(dict.fromkeys([entity, *order, *cols]))
    placed = over_ordered(log.select(*used), [entity], order, index="__at", slices=slices)
    item = F.struct("__at", *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    lists = (
        placed.where(F.col(entity).isNotNull())
        .withColumn("chunk", integer_div(F.col("__at"), chunk_rows))
        .groupBy(entity, "chunk")
        .agg(F.array_sort(F.collect_list(item)).alias("__items"))
    )
    return lists.select(
        entity, "chunk",
        *[F.col("__items")[f"v{i}"].alias(c) for i, c in enumerate(cols)],
    )


def last_rows(
    log: DataFrame, n: int, entity: str = "entity", order: Sequence[str] = ("us", "rid"),
    rows: int | None = None, slices: int | None = None,
) -> DataFrame:
    """The last n rows of every entity, with ``back`` counting from 1 at the very last.

    Positions and sizes come from slices, so a hot entity's rows stay in many tasks.
    """
    placed = over_ordered(log, [entity], order, index="__at", size="__n", rows=rows, slices=slices)
    return (
        placed.withColumn("back", F.col("__n") - F.col("__at"))
        .where(F.col("back") <= n).drop("__at", "__n")
    )


def padded_sequences(
    log: DataFrame, cols: Sequence[str], n: int = 500, entity: str = "entity",
    order: Sequence[str] = ("us", "rid"), slices: int | None = None,
) -> DataFrame:
    """One row per entity: arrays of exactly n integers, zeros first, the last n kept."""
    tail = last_rows(log.where(F.col(entity).isNotNull()), n, entity, order, slices=slices)
    return _pad(tail, cols, n, entity)


def _pad(tail: DataFrame, cols: Sequence[str], n: int, entity: str) -> DataFrame:
    item = F.struct((-F.col("back")).alias("at"), *[F.col(c).cast("int").alias(c) for c in cols])
    lists = tail.groupBy(entity).agg(F.array_sort(F.collect_list(item)).alias("__items"))
    return lists.select(entity, *[pad_sequence(F.col("__items")[c], n).alias(c) for c in cols])


def sequence_inputs(
    log: DataFrame, n: int = 500, entity: str = "entity", actor: str = "actor",
    product: str = "product", us: str = "us", tie: Sequence[str] = ("rid",),
    slices: int | None = None,
) -> DataFrame:
    """Padded code sequences of actor, product and actor gap, with the 13 scalar inputs.

    The log carries ``target`` and ``fold``: four of the scalars are the mean and deviation over
    the entity's rows of the actor's leave-fold-out mean and deviation.  The log is cut to the last n rows per entity before codes are joined to it.
    """
    shared = dict(us=us, tie=tie, rows=log.count(), slices=slices)
    gaps = group_gap(log, actor, "gap_actor", null_group=True, **shared)
    gaps = settle(gaps.fillna(-1.0, subset=["gap_actor"]), "gaps")
    tail = last_rows(gaps.where(F.col(entity).isNotNull()), n, entity, (us, *tie),
                     shared["rows"], slices)
    for c in (actor, product, "gap_actor"):
        codes = code_table(gaps if c == "gap_actor" else log, c, slices)
        tail = attach(tail, codes.withColumnRenamed("code", f"{c}_code"), c).withColumn(
            f"{c}_code", F.coalesce(f"{c}_code", F.lit(-1)))
    coded = [f"{c}_code" for c in (actor, product, "gap_actor")]
    counts = log.where(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count_distinct(actor) + F.max(F.col(actor).isNull().cast("int"))).alias("n_actors"),
        F.count_distinct(product).alias("n_products"),
    )
    encoded = attach_by_fold(
        log.select(entity, actor, "fold"), target_stats(log, actor, prefix="actor"), actor)
    stats = rollup_stats(encoded, entity, ["actor_mean", "actor_std"], ["mean", "std"], fill=-1.0)
    return _pad(tail, coded, n, entity).join(counts, entity).join(stats, entity).select(
        "*", *char_counts(entity))


def char_counts(entity: str = "entity") -> list:
    """Digits and the letters a-e in the entity's name."""
    return [count_digits(entity).alias("n_digits")] + [
        count_char(entity, ch).alias(f"n_{ch}") for ch in "abcde"]


def vocab_sizes(
    log: DataFrame, entity: str = "entity", actor: str = "actor", product: str = "product",
    us: str = "us", tie: Sequence[str] = ("rid",), slices: int | None = None,
) -> DataFrame:
    """One row with the index range a sequence model needs for each kind of input.

    Codes run from 0 without holes, so the largest code + 1 is a distinct count.
    Null actors count as one actor when gaps are taken, because they are coded first.
    """
    shared = dict(us=us, tie=tie, rows=log.count(), slices=slices)
    gaps = group_gap(log, None, "gap", **shared)
    gaps = group_gap(gaps, actor, "gap_actor", null_group=True, **shared)
    gaps = gaps.fillna(-1.0, subset=["gap", "gap_actor"])
    codes = gaps.agg(
        F.count_distinct(actor).alias("actor_size"),
        F.count_distinct(product).alias("product_size"),
        (F.greatest(F.count_distinct("gap"), F.count_distinct("gap_actor")) + 1).alias("gap_size"),
    )
    per_entity = log.where(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.count(F.lit(1)).alias("n"))
    # an entity has at least as many rows as distinct actors or products
    counts = per_entity.select("n", F.greatest(*char_counts(entity)).alias("most")).agg(
        (F.max("n") + 2).alias("count_size"), (F.max("most") + 1).cast("long").alias("char_size"))
    return codes.select("*", *[
        counts.select(c).scalar().alias(c) for c in ("count_size", "char_size")])
