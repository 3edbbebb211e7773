"""Seconds since the previous row: in the whole log, or within a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import seconds_between
from ..session import settle_and_see
from .ordered import ROWS_PER_SLICE, largest_group, over_ordered


def global_gap(
    log: DataFrame, out: str = "gap", us: str = "us", tie: Sequence[str] = ("rid",),
    rows: int | None = None, slices: int | None = None,
) -> DataFrame:
    """Gap to the previous row of the whole log; null in the first row."""
    return group_gap(log, None, out, us, tie, rows=rows, slices=slices)


def group_gap(
    log: DataFrame, key: str | None, out: str | None = None, us: str = "us",
    tie: Sequence[str] = ("rid",), *, null_group: bool = False,
    index: str | None = None, size: str | None = None, rows: int | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Gap to the previous row with the same key; null in the key's first row.

    A null key has null gaps, unless ``null_group`` makes the null rows a group.
    ``index`` and ``size`` come from the same pass; ``rows`` is that of over_ordered().
    """
    out = out or f"gap_{key}"
    group = [key] if key else []
    found = over_ordered(log, group, [us, *tie], prev={"__before": us},
                         index=index, size=size, rows=rows, slices=slices)
    gap = seconds_between(us, "__before")
    if key and not null_group:
        gap = F.when(F.col(key).isNotNull(), gap)
    return found.withColumn(out, gap).drop("__before")


def all_gaps(
    log: DataFrame, entity: str = "entity", actor: str = "actor", product: str = "product",
    us: str = "us", tie: Sequence[str] = ("rid",), slices: int | None = None,
) -> DataFrame:
    """The four gap columns, plus the row's position ``at`` of ``n`` within its entity.

    The log is placed once per column, in slices of that column's groups.
    """
    return chained_gaps(
        log, {"gap": None, "gap_actor": actor, "gap_product": product, "gap_entity": entity},
        us=us, tie=tie, slices=slices, index="at", size="n")


def chained_gaps(
    log: DataFrame, keys: Mapping[str, str | None], us: str = "us", tie: Sequence[str] = ("rid",),
    slices: int | None = None, index: str | None = None, size: str | None = None,
) -> DataFrame:
    """The gap columns ``keys`` (name: key, None for the whole log), one placement after the other.

    ``index`` and ``size`` are those of the last key.

    Keys whose groups all fit a slice need none: their windows run on whole groups, which are
    shuffled once.  The step before one that is cut into slices is stored, for the latter's range
    exchange reads its input twice (a sample for the bounds, then the rows) and would else run the
    step's windows twice.
    """
    found, rows = log, None
    for i, (out, key) in enumerate(keys.items()):
        cut = slices
        if key and slices is None and largest_group(log, [key]) <= ROWS_PER_SLICE:
            cut = 1
        if i and cut != 1:
            found, seen = settle_and_see(found, "gaps", n=F.count(F.lit(1)))
            rows = seen["n"]
        last = i == len(keys) - 1
        found = group_gap(found, key, out, us, tie, index=index if last else None,
                          size=size if last else None, rows=rows, slices=cut)
    return found
