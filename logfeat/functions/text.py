"""Helpers on strings and on one row's array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import _c


def count_digits(c: Column | str) -> Column:
    """Number of ASCII digits."""
    return F.length(F.regexp_replace(_c(c), "[^0-9]", ""))


def count_char(c: Column | str, ch: str) -> Column:
    """Occurrences of one character, case-sensitive."""
    c = _c(c)
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def list_to_text(arr: Column | str) -> Column:
    """Space-separated text of an array; a null element reads 'nan'."""
    return F.array_join(_c(arr).cast("array<string>"), " ", "nan")


def with_ngrams(arr: Column | str, n_max: int) -> Column:
    """The tokens followed by their 2-grams … n_max-grams, joined without a separator."""
    arr = _c(arr)

    def grams(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(arr) - (n - 1))
        found = F.transform(starts, lambda i: F.array_join(F.slice(arr, i, n), ""))
        return F.when(F.size(arr) >= n, found).otherwise(F.array().cast("array<string>"))

    return F.concat(arr, *[grams(n) for n in range(2, n_max + 1)])


def pad_sequence(arr: Column | str, n: int, fill: int = 0) -> Column:
    """Exactly n elements: the last n, or all of them after filling from the left."""
    arr = _c(arr)
    return F.when(F.size(arr) >= n, F.slice(arr, -n, n)).otherwise(
        F.concat(F.array_repeat(F.lit(fill), n - F.size(arr)), arr)
    )
