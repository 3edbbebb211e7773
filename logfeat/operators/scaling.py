"""Column profiles, pruning and scaling; each needs one aggregation over the table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle_and_see
from .keys import with_global


def column_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: sample std and null count."""
    x = ", ".join(f"'{c}', std{i}, nulls{i}" for i, c in enumerate(cols))
    return df.selectExpr(*[
        part for i, c in enumerate(cols) for part in (
            f"stddev_samp(CAST(`{c}` AS DOUBLE)) AS std{i}",
            f"count_if(`{c}` IS NULL) AS nulls{i}")
    ]).selectExpr(f"stack({len(cols)}, {x}) AS (column, std, nulls)")


def drop_degenerate(
    df: DataFrame, cols: Sequence[str], *, constant: bool = True, nulls: bool = False
) -> DataFrame:
    """Drop columns without spread (std null or not above 0) and, on request, any with a null."""
    profile = column_profile(df, cols).collect()  # one row per column
    gone = [p["column"] for p in profile
            if (constant and (p["std"] is None or p["std"] <= 0)) or (nulls and p["nulls"] > 0)]
    return df.drop(*gone)


def scale_columns(
    df: DataFrame, cols: Sequence[str], *, nulls: str = "fill", fill: float = -1.0,
    store: bool = False,
) -> DataFrame:
    """(x - mean) / (std + mean + 1) with the population std.

    ``nulls='fill'`` fills before the statistics are taken, ``'skip'`` leaves
    nulls out of them and fills afterwards.  Where the denominator is 0 the
    result is null (and stays null; drop_degenerate() removes such columns).

    ``store=True`` writes ``df`` to the scratch folder and takes the statistics on the way, so
    a table that is costly to compute is computed once.
    """
    if nulls not in ("fill", "skip"):
        raise ValueError(nulls)
    number = {c: f"CAST(`{c}` AS DOUBLE)" for c in cols}
    if nulls == "fill":
        number = {c: f"coalesce({x}, {float(fill)}D)" for c, x in number.items()}
    aggs = {k: f"{f}({number[c]})" for i, c in enumerate(cols)
            for k, f in ((f"m{i}", "avg"), (f"s{i}", "stddev_pop"))}
    if store:
        df, row = settle_and_see(df, "unscaled", **{k: F.expr(a) for k, a in aggs.items()})
    else:
        row = df.selectExpr(*[f"{a} AS {k}" for k, a in aggs.items()]).first()
    scaled = {}
    for i, c in enumerate(cols):
        mean, std = row[f"m{i}"], row[f"s{i}"]
        if mean is None or not math.isfinite(std + mean) or std + mean + 1 == 0:
            scaled[c] = "CAST(NULL AS DOUBLE)"
            continue
        x = f"({number[c]} - {mean!r}D) / {std + mean + 1!r}D"
        scaled[c] = f"coalesce({x}, {float(fill)}D)" if nulls == "skip" else x
    return df.selectExpr(*[
        f"{scaled[c]} AS `{c}`" if c in scaled else f"`{c}`" for c in df.columns])


def minmax(
    df: DataFrame, column: str, out: str | None = None, *, store: bool = False
) -> DataFrame:
    """Stretch a column to [0, 1]; null where all values are equal; ``store`` as in scale_columns()."""
    both = with_global(df, store=store, __low=F.min(column), __high=F.max(column))
    span = F.nullif(F.col("__high") - F.col("__low"), F.lit(0))
    return both.withColumn(out or column, (F.col(column) - F.col("__low")) / span).drop(
        "__low", "__high")
