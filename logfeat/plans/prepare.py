"""Raw files to the prepared log and entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nan_to_null, sentinel_to_null
from ..operators.keys import attach, exclude, stack, stratified_folds
from ..sources import read_exceptions, read_labels, read_log, read_table


def with_folds(log: DataFrame, entities: DataFrame) -> DataFrame:
    """The log with each entity's target and fold."""
    return attach(log, entities.select("entity", "target", "fold"))


def prepare(
    spark: SparkSession, *, train: str, test: str, train_exceptions: str, test_exceptions: str,
    log: str, out: str, n_folds: int = 10, slices: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Write ``out``/entities and ``out``/log, and return both as tables.

    Listed exceptions leave both; the unknown-target sentinel becomes null; only
    training entities get folds.  The written log carries ``rid``, a row number
    that is unique and, once stored, fixed: it is the tie-breaker of every
    ordered operator.
    """
    known = stack([
        exclude(read_labels(spark, train), read_exceptions(spark, train_exceptions)).withColumn(
            "train", F.lit(True)),
        exclude(read_labels(spark, test), read_exceptions(spark, test_exceptions)).withColumn(
            "train", F.lit(False)),
    ]).withColumn("target", sentinel_to_null(nan_to_null("target")))
    known.write.parquet(f"{out}/known")
    known = read_table(spark, f"{out}/known")
    # a test row stays without a fold whatever its target says
    train_rows = stratified_folds(known.where("train"), n_folds, slices=slices)
    entities = stack([train_rows, known.where("NOT train")]).select("entity", "target", "fold")
    entities.write.parquet(f"{out}/entities")
    entities = read_table(spark, f"{out}/entities")

    rows = with_folds(read_log(spark, log, entities), entities)
    rows.withColumn("rid", F.monotonically_increasing_id()).write.parquet(f"{out}/log")
    return read_table(spark, f"{out}/log"), entities
