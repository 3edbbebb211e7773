"""Words, lines and small expression helpers shared by the text operators."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WHITE = " \t\n\x0b\f\r"
_GAP = r"[ \x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The runs of characters other than space and U+0009 to U+000D."""
    inner = F.btrim(text, F.lit(WHITE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _GAP))


def n_words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(WHITE))
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, _GAP))).cast("long")


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE)) != ""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; -1 for a null id."""
    text = F.col(id_col).cast("string").cast("binary")
    return F.coalesce(F.crc32(text) % n, F.lit(-1))


def partitions(rows: int, per_part: int) -> int:
    return max(1, -(-rows // per_part))


BROADCAST_ROWS = 1_000_000


def narrow(stored: DataFrame) -> DataFrame:
    """``stored``, a stored table of an id or two per row, marked for broadcasting if it has at
    most BROADCAST_ROWS rows (some ten MB); a larger one is left to a shuffled join."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    The archive lies in the shared scratch folder.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    path = f"{scratch_path(spark, 'package')}/{name}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(archive.getvalue())
    out.close()
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
