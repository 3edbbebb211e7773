"""Bitmaps before shuffles, aggregates taken on the way, tables that lie together."""

import random

import pytest
from pyspark.sql import functions as F

from logfeat.operators import keys, matrix, scaling, screens
from logfeat.session import co_locate, settle, settle_and_see


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def log(spark):
    return settle(spark.range(20_000).select(
        F.nullif((F.col("id") % 3001).cast("string"), F.lit("7")).alias("a"),
        F.nullif(F.col("id") % 5, F.lit(3)).alias("b"), "id"))


def test_bitmap_has_the_bits_that_were_set(spark):
    rng = random.Random(1)
    want = {rng.randrange(4096) for _ in range(300)} | {0, 63, 64, 4095}
    at = spark.createDataFrame([(p,) for p in [*want, *want]], "pos long")
    words = screens.bitmap(at, 4096).first()["words"]
    assert len(words) == 64
    assert {64 * i + j for i, w in enumerate(words) for j in range(64) if w >> j & 1} == want
    asked = spark.range(4096).where(screens.all_set(
        screens.bitmap(at, 4096).scalar(), [F.col("id")]))
    assert {r["id"] for r in asked.collect()} == want


@pytest.mark.parametrize("on", [["a"], ["a", "b"]])
@pytest.mark.parametrize("most", [screens.MOST_BITS, 64])
def test_screened_joins_equal_plain_ones(log, on, most, monkeypatch):
    monkeypatch.setattr(screens, "MOST_BITS", most)  # 64: too many keys for a bitmap
    listed = log.where("id % 17 = 0")  # repeated keys and nulls
    assert rows(screens.screened_known(log, listed, on)) == rows(keys.keep_known(log, listed, on))
    assert rows(screens.screened_exclude(log, listed, on)) == rows(keys.exclude(log, listed, on))
    none = log.where("id < 0")
    assert screens.screened_known(log, none, on).count() == 0
    assert screens.screened_exclude(log, none, on).count() == log.count()


def test_few_foreign_rows_pass_the_bitmap(log):
    listed = log.where("a < '2'")
    found, words, bits = screens._stored(listed, ["a"])
    foreign = log.join(found, "a", "left_anti").where("a IS NOT NULL")
    passed = foreign.where(screens.all_set(words.scalar(), screens._places(["a"], bits)))
    assert passed.select("a").distinct().count() < 0.05 * foreign.select("a").distinct().count()


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_sketch_keeps_exactly_the_frequent_features(spark, bits):
    cells = spark.range(30_000).select(
        F.col("id").cast("string").alias("entity"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 4000 + F.col("id") % 7 * 10_000).alias(
            "feature"), F.lit(1.0).alias("value"))
    for t in (0, 1, 2, 10**6):
        got = screens.screened_doc_freq(cells, t, bits=bits)
        assert rows(got) == rows(matrix.min_doc_freq(cells, t))


def test_a_table_is_computed_once_for_its_statistics(spark):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        runs.add(1)
        return float(x)

    slow = spark.range(200).select("id", counted.asNondeterministic()("id").alias("x"))
    for f in (lambda **o: scaling.scale_columns(slow, ["x"], **o), lambda **o: scaling.minmax(slow, "x", **o)):
        before = runs.value
        once = rows(f(store=True))
        assert runs.value == before + 200
        assert rows(f()) == once and runs.value == before + 600  # statistics, then rows


def test_seen_without_rows(spark):
    table, seen = settle_and_see(spark.range(0), most=F.max("id"), n=F.count(F.lit(1)))
    assert seen == {"most": None, "n": 0} and table.count() == 0


def test_tables_that_lie_together_join_without_a_shuffle(spark, log):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = [log.where("a IS NOT NULL").groupBy("a").agg(F.sum(F.col("id") * i).alias(f"s{i}")) for i in range(4)]
        near = keys.join_features([co_locate(p, "a", 4) for p in parts], "a")
        far = keys.join_features([settle(p) for p in parts], "a")
        assert "Exchange" not in plan(near) and "Exchange" in plan(far)
        assert rows(near) == rows(far)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
