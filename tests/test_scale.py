"""Plans: no single-task window over everything, hot keys split, filters and columns pushed down."""

import pytest
from pyspark.sql import functions as F

from logfeat.operators import gaps, keys, rollup, sequences
from logfeat.sources import read_table
from logfeat.session import scratch_path, settle


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    old = {}

    def put(**values):
        for k, v in values.items():
            k = k.replace("__", ".")
            old.setdefault(k, spark.conf.get(k))
            spark.conf.set(k, v)

    yield put
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def log(spark):
    # a third of the rows belong to one entity, actor and product
    rows = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("rid"), (F.col("id") * 997 % 60_013).alias("us"),
        *[F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % m).cast("string")).alias(c)
          for c, m in (("entity", 2_000), ("actor", 50), ("product", 4))])
    return settle(rows)


def test_hot_key_of_a_join_is_split(spark, log, conf):
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1",
            "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
            "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
            "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB"})
    entities = log.select("entity").distinct().withColumn("fold", F.lit(1))
    joined = keys.attach(log, settle(entities))
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan(joined)


def test_windows_are_partitioned_by_slice(log):
    text = plan(gaps.global_gap(log, slices=6))
    windows = [line for line in text.splitlines() if "row_number()" in line]
    assert windows and all("windowspecdefinition(__slice" in w for w in windows)


def test_hot_entity_is_ranked_in_slices(log):
    exact = {r["entity"]: r for r in rollup.rollup_stats(log, "entity", ["us"]).collect()}
    split = {r["entity"]: r for r in rollup.rollup_stats(
        log, "entity", ["us"], group_rows=1_000, slices=6).collect()}
    assert exact.keys() == split.keys()
    for c in ("us_median", "us_10per", "us_90per", "us_std"):
        assert exact["hot"][c] == pytest.approx(split["hot"][c])


def test_last_rows_of_a_hot_entity_come_from_slices(log):
    windows = [line for line in plan(sequences.last_rows(log, 100, slices=6)).splitlines()
               if "row_number()" in line]
    assert windows and all("windowspecdefinition(__slice" in w for w in windows)


def test_columns_and_filters_reach_the_scan(spark, log):
    path = scratch_path(spark, "pushdown")
    log.write.parquet(path)
    text = plan(read_table(spark, path, ["entity", "us"]).where("us > 100"))
    assert "GreaterThan(us,100)" in text
    assert "ReadSchema: struct<us:bigint,entity:string>" in text
