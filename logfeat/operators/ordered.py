"""Ordered operations that never put a whole group, or the whole table, in one task.

A window over one hot group, or over no group at all, runs in a single task.
Here the rows are first dealt out by ranges of the composite key *(group, order)* into slices of
about equal size, and stored with their slice number.  A group's rows are then consecutive
slices, so

* inside a slice an ordinary window partitioned by *(slice, group)* does the work, and
* what a slice needs from the slices before it is a summary of one row per
  (group, slice) - and only for groups that go over a slice's end.

A slice has one first and one last group, so that summary has at most two rows per slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

ROWS_PER_SLICE = 1_000_000
SMALL_SLICE = 1_000

SLICE = "__slice"
_PLACE = "__place_in_slice"


def slice_count(df: DataFrame, rows: int) -> int:
    """Slices of about ROWS_PER_SLICE rows; of fewer where that leaves cores idle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-rows // ROWS_PER_SLICE), min(cores, rows // SMALL_SLICE))


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group, nulls being a group; 0 without rows."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def in_slices(df: DataFrame, keys: Sequence[str], slices: int) -> DataFrame:
    """``df`` stored in ``slices`` ranges of ``keys`` (nulls first), each row with its number.

    Spark's range exchange picks the bounds from a sample; any bounds give the same results, they
    only balance the slices.
    """
    ranged = df.repartitionByRange(slices, *[F.col(k).asc_nulls_first() for k in keys])
    return settle(ranged.withColumn(SLICE, F.spark_partition_id()), "sliced")


def over_ordered(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    *,
    prev: Mapping[str, str] | None = None,
    index: str | None = None,
    size: str | None = None,
    before: Mapping[str, str] | None = None,
    rows: int | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add ordered columns per group; ``group`` may be empty (the whole table).

    prev    {new column: source}  value in the previous row, null in the first
    index   new column            position in the group, from 0
    size    new column            rows in the group
    before  {new column: source}  sum over all earlier rows of the group, 0 in the first

    ``order`` ascends with nulls first and should end in a unique column.  A null
    group key is a group like any other.  ``rows``, if known, saves counting ``df``.
    """
    prev, before = dict(prev or {}), dict(before or {})
    group, order = list(group), list(order)
    keys = group + [k for k in order if k not in group]
    taken = {SLICE, _PLACE, index, size, *prev, *before} & set(df.columns)
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    if slices is None:
        slices = slice_count(df, df.count() if rows is None else rows)
    cut = slices > 1
    stored = in_slices(df, keys, slices) if cut else df
    parts = ([SLICE] if cut else []) + group
    ordered = Window.partitionBy(*parts).orderBy(*[F.col(k).asc_nulls_first() for k in order])
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)

    position = _PLACE if index is None else index
    local: dict[str, Column] = {position: F.row_number().over(ordered).cast("long") - 1}
    if size:
        local[size] = F.count(F.lit(1)).over(Window.partitionBy(*parts))
    for out, src in prev.items():
        local[out] = F.lag(src).over(ordered)
    for out, src in before.items():
        local[out] = F.coalesce(F.sum(src).over(earlier), F.lit(0))
    result = stored.withColumns(local)
    wanted = [*df.columns, *(c for c in local if c != _PLACE)]
    if not cut:
        return result.select(*wanted)

    r, c = result.alias("r"), _carry(stored, group, order, prev, before).alias("c")
    same = _same(["r", "c"], [SLICE, *group])
    first = F.col(f"r.{position}") == 0
    fixed = {}
    if index:
        fixed[index] = F.col(f"r.{index}") + F.coalesce(F.col("c.__rows"), F.lit(0))
    if size:
        fixed[size] = F.coalesce(F.col("c.__size"), F.col(f"r.{size}"))
    for out in prev:
        fixed[out] = F.when(first, F.col(f"c.__prev_{out}")).otherwise(F.col(f"r.{out}"))
    for out in before:
        fixed[out] = F.col(f"r.{out}") + F.coalesce(F.col(f"c.__sum_{out}"), F.lit(0))
    return r.join(c, same, "left").select(
        *[fixed[w].alias(w) if w in fixed else F.col(f"r.{w}") for w in wanted]
    )


def _same(sides: Sequence[str], keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{sides[0]}.{k}").eqNullSafe(F.col(f"{sides[1]}.{k}"))
    return on


def _carry(stored, group, order, prev, before) -> DataFrame:
    """What each slice of a cut group takes over from the group's earlier slices.

    Only the first and the last group of a slice can be cut; rows of others leave first.  Both
    tables are stored: their file sizes tell Spark whether they can be broadcast.
    """
    rows = stored
    if group:
        key = F.struct(*group)
        ends = stored.groupBy(SLICE).agg(F.min(key).alias("a"), F.max(key).alias("z"))
        ends = ends.select(F.explode(F.array("a", "z")).alias("g")).groupBy("g").agg(
            F.count(F.lit(1)).alias("n")).where("n > 1").select("g.*")
        rows = stored.alias("s").join(
            settle(ends, "ends").alias("h"), _same(["s", "h"], group), "left_semi")
    aggs = [F.count(F.lit(1)).alias("rows")]
    for out, src in prev.items():
        # the last row holds the largest first sort key, and max() is the cheaper aggregate
        last = F.max(src) if src == order[0] else F.max_by(
            F.struct(src), F.struct(*order))[src]
        aggs.append(last.alias(f"last_{out}"))
    for out, src in before.items():
        aggs.append(F.sum(src).alias(f"sum_{out}"))
    summary = rows.groupBy(*group, SLICE).agg(*aggs)
    w = Window.partitionBy(*group).orderBy(SLICE)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    return settle(summary.select(
        *group,
        SLICE,
        F.sum("rows").over(earlier).alias("__rows"),
        F.sum("rows").over(Window.partitionBy(*group)).alias("__size"),
        *[F.lag(f"last_{out}").over(w).alias(f"__prev_{out}") for out in prev],
        *[F.sum(f"sum_{out}").over(earlier).alias(f"__sum_{out}") for out in before],
    ), "carry")
