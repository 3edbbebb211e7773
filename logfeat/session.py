"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", app: str = "logfeat") -> SparkSession:
    """A session for tests and benches; on a cluster use the one it hands out."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("LOGFEAT_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Everything lies under one folder per application; ``clear_scratch`` removes it.  Only a
    local master may fall back to a temporary folder of its own (one per application, kept
    here, as that setting is fixed once the session runs): on a cluster the executors would
    not see it.
    """
    root, app = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="logfeat-")
        root = _LOCAL_ROOTS[app]
    return f"{root.rstrip('/')}/logfeat-{app}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what ``settle`` has left in this application; for the end of a job."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.dirname(scratch_path(spark, "x")))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """Removes at its end what ``settle`` has stored inside it, but for the last table: for a step
    whose result, stored last, no longer needs its parts.  Not for steps that run side by side."""
    _STORED.append([])
    try:
        yield _STORED[-1]
    finally:
        for name in _STORED.pop()[:-1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_STORED: list[list[str]] = []


def cut_lineage(spark: SparkSession) -> None:
    """Let iterative ML fits checkpoint: gives the context a folder in the shared one, unless it
    has one.  Without it a fit's lineage, and with it each round's cost, grows with the rounds."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "fits"))


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of repeating the
    query) and lets several later passes prune columns from one stored copy.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    for stored in _STORED:
        stored.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deal_out(df: DataFrame) -> DataFrame:
    """``df`` in equal parts for every core, unless its rows lie about so already.

    For narrow rows that long work makes many of; a file of one row group is one task else.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    held = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    if not held or max(held) <= 2 * -(-sum(held) // cores):
        return df
    return df.repartition(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def co_locate(
    df: DataFrame, on: str, buckets: int, name: str = "features", lies: bool = False
) -> DataFrame:
    """settle() into ``buckets`` files by the hash of ``on``, sorted in each, as a table of its own.

    Tables with the same number of buckets join and aggregate by ``on`` without being shuffled
    again.  Choose some hundred MB a bucket of the largest one.  The files lie in the scratch
    folder; on a catalog that outlives the application, drop the table at the end of a job.
    ``lies``: ``df`` comes of such a table with as many buckets by aggregation by ``on``, so it
    is written as it lies.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df if lies else df.repartition(buckets, on)
    dealt.write.bucketBy(buckets, on).sortBy(on).option("path", path).format(
        "parquet").saveAsTable(table)
    for stored in _STORED:
        stored.append(path)
    return spark.table(table)


def settle_and_see(
    df: DataFrame, name: str = "table", **aggs: Column
) -> tuple[DataFrame, dict[str, object]]:
    """settle(), and aggregates over all rows that are taken while they are written.

    The table is not read again for them.  They sit in the writing stage itself, whose tasks
    Spark counts once each however often they are run.  No rows give what an aggregate
    without rows gives (null for a maximum).
    """
    seen = Observation()
    stored = settle(df.observe(seen, *[agg.alias(k) for k, agg in aggs.items()]), name)
    return stored, seen.get
