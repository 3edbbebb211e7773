"""Row selection, key joins, dense codes and folds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import integer_div
from ..session import settle, settle_and_see
from .ordered import over_ordered


def _on(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def keep_known(df: DataFrame, known: DataFrame, on: str | Sequence[str] = "entity") -> DataFrame:
    """Rows whose key occurs in ``known``; repeats there do not multiply rows."""
    on = _on(on)
    return df.join(known.select(*on), on, "left_semi")


def exclude(df: DataFrame, listed: DataFrame, on: str | Sequence[str] = "entity") -> DataFrame:
    """Rows whose key does not occur in ``listed``; a null in the list excludes nothing."""
    on = _on(on)
    return df.join(listed.select(*on), on, "left_anti")


def attach(df: DataFrame, features: DataFrame, on: str | Sequence[str] = "entity") -> DataFrame:
    """Left join a table that is unique per key; rows without a match keep nulls.

    No broadcast hint: Spark compares the measured size of ``features`` with its
    own threshold, and splits a hot key of ``df`` at run time otherwise.
    """
    return df.join(features, _on(on), "left")


def attach_by_fold(df: DataFrame, stats: DataFrame, key: str, fold: str = "fold") -> DataFrame:
    """Left join on (key, fold) where a null fold matches a null fold."""
    left, right = df.alias("l"), stats.alias("r")
    on = (F.col(f"l.{key}") == F.col(f"r.{key}")) & F.col(f"l.{fold}").eqNullSafe(
        F.col(f"r.{fold}"))
    extra = [F.col(f"r.{c}") for c in stats.columns if c not in (key, fold)]
    return left.join(right, on, "left").select(*[F.col(f"l.{c}") for c in df.columns], *extra)


def join_features(tables: Sequence[DataFrame], on: str = "entity") -> DataFrame:
    """Equi-join tables that are unique per key, instead of lining rows up by position."""
    return reduce(lambda a, b: a.join(b, on), tables)


def with_global(df: DataFrame, *, store: bool = False, **aggs) -> DataFrame:
    """Add whole-table aggregates as constant columns; one row passes through the driver.

    ``store=True`` writes ``df`` and takes them on the way, so it is computed once.
    """
    if store:
        df, row = settle_and_see(df, "seen", **aggs)
    else:
        row = df.agg(*[agg.alias(name) for name, agg in aggs.items()]).first()
    return df.withColumns({name: F.lit(row[name]) for name in aggs})


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Union all by column name; a column absent from one table is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def suffix(df: DataFrame, text: str, keep: Sequence[str] = ("entity",)) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(c + text) for c in df.columns])


def split_labelled(df: DataFrame, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(rows with a fold, rows without one)"""
    return df.where(F.col(fold).isNotNull()), df.where(F.col(fold).isNull())


def fold_split(df: DataFrame, f: int, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(training rows, held-out rows) of one fold; rows without a fold are in neither."""
    return df.where((F.col(fold) != f) & F.col(fold).isNotNull()), df.where(F.col(fold) == f)


def fold_parts(df: DataFrame, n_folds: int, fold: str = "fold") -> DataFrame:
    """Every row once per fold f, as its ``part``: train, valid or unlabelled; one pass."""
    rows = df.withColumn("__f", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))))
    part = F.when(F.col(fold).isNull(), "unlabelled").when(
        F.col(fold) == F.col("__f"), "valid").otherwise("train")
    return rows.withColumn("part", part).withColumn(fold, F.col("__f")).drop("__f")


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in the given order, for a look at a table."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)


def order_log(log: DataFrame, ts: str = "us", tie: Sequence[str] = ("rid",)) -> DataFrame:
    """Global sort for a sink; operators take their order as an argument instead."""
    return log.orderBy(F.col(ts).asc_nulls_first(), *tie)


def code_table(df: DataFrame, column: str, slices: int | None = None) -> DataFrame:
    """(column, code): the distinct non-null values numbered from 0 in ascending order."""
    values = settle(df.select(column).where(F.col(column).isNotNull()).distinct(), "codes")
    return over_ordered(values, [], [column], index="code", slices=slices)


def label_codes(
    df: DataFrame, column: str, out: str | None = None, slices: int | None = None
) -> DataFrame:
    """Replace nothing, add ``out``: the value's rank among distinct values, -1 for null."""
    out = out or f"{column}_code"
    codes = code_table(df, column, slices).withColumnRenamed("code", out)
    return attach(df, codes, column).withColumn(out, F.coalesce(out, F.lit(-1)))


def stratified_folds(
    entities: DataFrame,
    k: int = 10,
    *,
    target: str = "target",
    order: Sequence[str] = ("entity",),
    slices: int | None = None,
) -> DataFrame:
    """Add ``fold``: within each class consecutive blocks, the first n mod k one larger.

    ``order`` must be unique.  Unlabelled rows get no fold.
    """
    ranked = over_ordered(entities, [target], list(order), index="__r", size="__n", slices=slices)
    r, q, m = F.col("__r"), integer_div(F.col("__n"), k), F.col("__n") % k
    large = m * (q + 1)  # rows in the blocks of size q + 1
    fold = F.when(r < large, integer_div(r, q + 1)).otherwise(
        m + integer_div(r - large, F.greatest(q, F.lit(1))))
    return ranked.withColumn(
        "fold", F.when(F.col(target).isNotNull(), fold).cast("int")
    ).drop("__r", "__n")
