"""CSV at the edges, Parquet in between; schemas are given, never inferred."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import from_epoch, micros, nan_to_null, str_key
from ..operators.keys import keep_known
from ..operators.matrix import Matrix
from ..session import settle

LABELS = "entity string, target double"
EXCEPTIONS = "entity string"
LOG = "entity string, actor string, epoch bigint, product string"
STRICT = "FAILFAST"  # a line that does not fit the schema ends the job; PERMISSIVE makes nulls
MAX_BROKEN = 0.001  # most lines that may be set aside, as a share
_BROKEN = "__broken"


def read_lines(
    spark: SparkSession, path: str | Sequence[str], schema: str, *, sep: str = ",",
    mode: str = STRICT, errors: str | None = None, max_share: float = MAX_BROKEN,
) -> DataFrame:
    """Header-less CSV in the given schema; with ``errors``, broken lines are set aside.

    Lines that do not fit the schema (a value of the wrong type, too few or too many values) then
    go to a Parquet table (line, file) at the path ``errors``, and the others are the result.  The
    text is parsed once and stored; where more than ``max_share`` of the lines are broken, the
    table of errors is written and the read ends with a ValueError.  Without ``errors`` the first
    broken line ends the job.
    """
    if errors is None:
        return spark.read.schema(schema).csv(path, sep=sep, mode=mode)
    parsed = spark.read.schema(f"{schema}, {_BROKEN} string").csv(
        path, sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN)
    stored = settle(parsed.withColumn("__file", F.col("_metadata.file_path")), "parsed")
    broken = stored.where(F.col(_BROKEN).isNotNull())
    broken.select(F.col(_BROKEN).alias("line"), F.col("__file").alias("file")).write.parquet(errors)
    n, bad = stored.agg(F.count(F.lit(1)), F.count(_BROKEN)).first()
    if bad > max_share * n:
        raise ValueError(f"{bad} of {n} lines are broken; see {errors}")
    return stored.where(F.col(_BROKEN).isNull()).drop(_BROKEN, "__file")


def read_labels(spark: SparkSession, path: str, mode: str = STRICT, **errors) -> DataFrame:
    """Header-less CSV of (entity, target); a target that is not a number becomes null.

    ``errors`` are those of read_lines(), here and below.
    """
    rows = read_lines(spark, path, LABELS, mode=mode, **errors)
    return rows.withColumn("target", nan_to_null("target"))


def read_exceptions(spark: SparkSession, path: str, mode: str = STRICT, **errors) -> DataFrame:
    """Header-less tab-separated file of one column."""
    return read_lines(spark, path, EXCEPTIONS, sep="\t", mode=mode, **errors)


def read_log(
    spark: SparkSession, path: str | Sequence[str], known: DataFrame | None = None,
    mode: str = STRICT, **errors,
) -> DataFrame:
    """Every header-less log CSV under a path or glob, as one scan.

    Rows of entities that are not in ``known`` are left out.  ``us`` is the time in
    microseconds; a missing product becomes the text 'nan', a missing actor stays null.
    """
    log = read_lines(spark, path, LOG, mode=mode, **errors)
    if known is not None:
        log = keep_known(log, known)
    ts = from_epoch("epoch")
    return log.select("entity", "actor", str_key("product").alias("product"),
                      ts.alias("ts"), micros(ts).alias("us"))


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Parquet, or CSV with a header if a schema is given; only the named columns are read."""
    df = spark.read.schema(schema).csv(path, header=True) if schema else spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    writer.csv(path, header=True) if fmt == "csv" else writer.format(fmt).save(path)


def write_matrix(matrix: Matrix, path: str, mode: str = "errorifexists") -> None:
    """Cells and width as two Parquet folders under ``path``."""
    matrix.coo.write.mode(mode).parquet(f"{path}/cells")
    shape = matrix.coo.sparkSession.range(1).select(F.lit(matrix.width).cast("long").alias("width"))
    shape.write.mode(mode).parquet(f"{path}/shape")


def read_matrix(spark: SparkSession, path: str) -> Matrix:
    width = spark.read.parquet(f"{path}/shape").first()["width"]
    return Matrix(spark.read.parquet(f"{path}/cells"), width)


def run_label(prefix: str, n: int | None = None, date: datetime.date | None = None) -> str:
    """Name of a result: prefix, number of models, month and day."""
    day = (date or datetime.date.today()).strftime("%m%d")
    return f"{prefix}_{day}" if n is None else f"{prefix}_{n}bag_{day}"
