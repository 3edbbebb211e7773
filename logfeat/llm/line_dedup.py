"""Dropping lines that too large a share of a site's pages have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import WHITE, has_word, whole

# A template shows on a large share of a site's pages, and large sites have several: a tenth.
RATIO, MIN_PAGES = 0.1, 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(WHITE))))


def common_lines(
    pages: DataFrame, *, text: str = "text", host: str = "source", ratio: float = RATIO,
    min_pages: int = MIN_PAGES, page: Column | None = None,
) -> DataFrame:
    """(host, lines): digests of the lines on more than ``ratio`` of the host's pages.

    Rows of a host with the same ``page`` (by default: the same text) are one page, in a line's
    count and in the host's total.  At most (mean lines per page) / ``ratio`` lines of a host can
    be that common, so the lists are short whatever the host's size.
    """
    page = F.unhex(F.md5(whole(text))) if page is None else page
    seen = F.array_distinct(F.transform(F.filter(_lines(whole(text)), has_word), _digest))
    rows = pages.select(F.col(host).alias("host"), page.alias("page"), F.explode(F.array_append(
        seen, F.lit(None).cast("binary"))).alias("line")).distinct()
    # the null line stands once for every page: its count is the host's total
    counts = settle(rows.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")), "lines")
    totals = counts.where("line IS NULL").select(F.col("host").alias("_host"),
                                                 F.col("n").alias("total"))
    common = counts.where(f"line IS NOT NULL AND n >= {int(min_pages)}").join(
        totals, F.col("host").eqNullSafe(F.col("_host")))
    common = common.where(F.col("n") > ratio * F.col("total"))
    return common.groupBy("host").agg(F.collect_list("line").alias("lines"))


def strip_lines(
    pages: DataFrame, *, text: str = "text", host: str = "source", ratio: float = RATIO,
    min_pages: int = MIN_PAGES, common: DataFrame | None = None,
) -> DataFrame:
    """``pages`` with the common lines taken out of the text.  All rows and columns stay.

    Lines end at ``\\n`` and are compared without white space at their ends; lines without a
    word are never dropped.  A null text stays null, an empty one empty, and a text whose lines
    all go becomes empty.  A null host is a host of its own.  Repeated rows and copies of a text
    are one page, so that copies do not make a text boilerplate; ``common``, a common_lines() of
    the caller, may take near copies for one page too.  A line must be on ``min_pages`` pages, so
    that tiny hosts keep theirs.  Very long texts are handled whole; no rows give no rows.
    """
    if common is None:
        common = common_lines(pages, text=text, host=host, ratio=ratio, min_pages=min_pages)
    common = settle(common, "common")
    held = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("_row"))
    joined = held.join(common.select(F.col("host").alias("_host"), F.col("lines").alias("_lines")),
                       F.col(f"_row.{host}").eqNullSafe(F.col("_host")), "left")
    body = F.col(f"_row.{text}")
    kept = F.array_join(F.filter(_lines(body), lambda x: ~F.array_contains(
        F.col("_lines"), _digest(x)) | ~has_word(x)), "\n")
    new = F.when(F.col("_lines").isNull() | body.isNull(), body).otherwise(kept)
    return joined.select(*[
        (new if c == text else F.col(f"_row.{c}")).alias(c) for c in pages.columns])


def count_lines(text: Column) -> Column:
    return F.size(F.filter(_lines(whole(text)), has_word)).cast("long")
