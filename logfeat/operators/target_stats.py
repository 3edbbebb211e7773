"""Leave-fold-out target statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keys import stack


def target_sums(
    log: DataFrame, key: str, *, target: str = "target", fold: str = "fold", centre: float = 0.0,
) -> DataFrame:
    """(key, fold, n, s, ss): sums that stats_from_sums() needs and add_sums() can add up.

    They are combined before the shuffle, so a hot key costs one row per task and fold.
    """
    x = F.col(target).cast("double") - F.lit(float(centre))
    return log.where(F.col(key).isNotNull()).groupBy(key, fold).agg(
        F.count(target).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("ss"))


def add_sums(parts: Sequence[DataFrame], key: str, fold: str = "fold") -> DataFrame:
    """The target_sums() of a log from those of its parts (of one ``centre``)."""
    return stack(parts).groupBy(key, fold).agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")])


def grow_sums(
    log_part: DataFrame, key: str, out: str, before: str | None = None, **options
) -> DataFrame:
    """Write the sums of all log parts so far to the folder ``out``: those at ``before`` (null at
    the first part) and ``log_part``'s.  Each version has a folder of its own, so a failed run
    leaves the last one as it was, and only the new part of the log is read."""
    spark, sums = log_part.sparkSession, target_sums(log_part, key, **options)
    if before is not None:
        sums = add_sums([spark.read.parquet(before), sums], key, options.get("fold", "fold"))
    sums.write.parquet(out)
    return spark.read.parquet(out)


def target_stats(
    log: DataFrame,
    key: str,
    *,
    target: str = "target",
    fold: str = "fold",
    prefix: str | None = None,
    centre: float = 0.0,
) -> DataFrame:
    """Per (key, fold) the mean, std and sum of the target over the *other* folds.

    Rows without a fold get the statistics over all folds.  A (key, fold) pair
    appears only if the log has it, and only if other folds have rows for the key.

    The log is read once.  ``centre`` is subtracted inside the sums of squares;
    give the overall mean when the target is not 0/1.
    """
    own = target_sums(log, key, target=target, fold=fold, centre=centre)
    return stats_from_sums(own, key, fold=fold, prefix=prefix, centre=centre)


def stats_from_sums(
    own: DataFrame, key: str, *, fold: str = "fold", prefix: str | None = None, centre: float = 0.0,
) -> DataFrame:
    """target_stats() from target_sums(); the window sees at most one row per key and fold."""
    prefix = key if prefix is None else prefix
    labelled = F.col(fold).isNotNull()
    whole = Window.partitionBy(key)

    def others(c: str):
        own_part = F.when(labelled, F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0))
        return F.sum(own_part).over(whole) - own_part

    rest = own.select(
        key, fold, others("n").alias("n"), others("s").alias("s"), others("ss").alias("ss")
    ).where(F.col("n") > 0)
    n, s, ss = F.col("n"), F.col("s"), F.col("ss")
    variance = F.greatest(ss - s * s / n, F.lit(0.0)) / (n - 1)
    return rest.select(
        key,
        fold,
        (s / n + F.lit(float(centre))).alias(f"{prefix}_mean"),
        F.when(n > 1, F.sqrt(variance)).alias(f"{prefix}_std"),
        (s + n * F.lit(float(centre))).alias(f"{prefix}_sum"),
    )
