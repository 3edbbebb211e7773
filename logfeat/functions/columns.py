"""Null, time and arithmetic helpers on single columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_PARTS = ("month", "day", "hour", "minute", "second", "week", "weekday", "yearday")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_null(c: Column | str, sentinel: float = 0.5) -> Column:
    """The value that stands for "unknown" becomes null."""
    return F.nullif(_c(c), F.lit(sentinel))


def nan_to_null(c: Column | str) -> Column:
    """NaN becomes null, so that it neither sorts as a huge number nor counts as a value."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def str_key(c: Column | str) -> Column:
    """Cast to string; a null becomes the text 'nan' and so a group of its own."""
    return F.coalesce(_c(c).cast("string"), F.lit("nan"))


def from_epoch(c: Column | str) -> Column:
    return F.timestamp_seconds(_c(c))


def parse_ts(c: Column | str) -> Column:
    return F.to_timestamp(_c(c), "yyyy-MM-dd HH:mm:ss")


def micros(c: Column | str) -> Column:
    """Microseconds since the epoch, from either timestamp type."""
    return F.unix_micros(_c(c).cast("timestamp"))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Difference of two microsecond columns in seconds, with the fraction kept."""
    return (_c(later) - _c(earlier)) / F.lit(1e6)


def integer_div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def date_parts(ts: Column | str, prefix: str = "") -> list[Column]:
    """The eight calendar columns; weekday counts from Monday = 0, week is the ISO week."""
    ts = _c(ts)
    parts = (
        F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts),
        F.second(ts), F.weekofyear(ts), F.weekday(ts), F.dayofyear(ts),
    )
    return [p.alias(prefix + name) for p, name in zip(parts, DATE_PARTS)]
