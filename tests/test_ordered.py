"""Sliced windows against plain windows and brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from logfeat.operators.ordered import SLICE, in_slices, over_ordered, slice_count


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    # one hot key, a null key, nulls and ties in the order column
    data = [(rng.choice(["a", "a", "a", "b", "c", None]),
             rng.choice([None, 1, 1, 2, 3, 4, 5]), i, rng.randint(0, 9)) for i in range(400)]
    return spark.createDataFrame(data, "g string, t bigint, rid bigint, v bigint").cache()


def plain(df, group, order):
    w = Window.partitionBy(*group).orderBy(*order)
    return df.select(
        "*",
        F.lag("t").over(w).alias("p"), F.lag("v").over(w).alias("pv"),
        (F.row_number().over(w) - 1).cast("long").alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy(*group)).alias("n"),
        F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("b"))


@pytest.mark.parametrize("group", [[], ["g"]])
@pytest.mark.parametrize("slices", [1, 2, 7, 50])
def test_same_as_one_window(rows, group, slices):
    got = over_ordered(rows, group, ["t", "rid"], prev={"p": "t", "pv": "v"}, index="i", size="n",
                       before={"b": "v"}, slices=slices)
    want = plain(rows, group, ["t", "rid"]).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_slices_are_balanced_even_for_one_key(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("g"), "id")
    sizes = in_slices(df, ["g", "id"], 8).groupBy(SLICE).count().collect()
    assert len(sizes) == 8
    assert max(r["count"] for r in sizes) < 2 * 20_000 / 8


def test_slices_have_no_ceiling(spark):
    """As many slices as are asked for, about a million rows each whatever their number."""
    assert slice_count(spark.range(1), 20_000 * 1_000_000) == 20_000
    assert slice_count(spark.range(1), 10 ** 12) == 1_000_000
    stored = in_slices(spark.range(60_000), ["id"], 3_000)
    assert stored.select(SLICE).distinct().count() > 2_400


def test_many_small_slices(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("g"), "id")
    got = over_ordered(df, ["g"], ["id"], index="i", size="n", prev={"p": "id"}, slices=250)
    for r in got.collect():
        assert (r["i"], r["n"], r["p"]) == (r["id"] // 3, 100, r["id"] - 3 if r["id"] > 2 else None)


def test_strings_and_doubles_as_keys(spark):
    data = [(float("nan"), "é'\\"), (1.5, "a"), (None, None), (-0.5, "z"), (2.0, '"q"')] * 5
    df = spark.createDataFrame([(x, y, i) for i, (x, y) in enumerate(data)],
                               "x double, y string, rid bigint")
    got = over_ordered(df, [], ["y", "x", "rid"], index="i", slices=6)
    w = Window.orderBy("y", "x", "rid")
    want = df.withColumn("i", (F.row_number().over(w) - 1).cast("long"))
    pairs = lambda d: {r["rid"]: r["i"] for r in d.collect()}
    assert pairs(got) == pairs(want)


def test_existing_columns_are_not_overwritten(rows):
    with pytest.raises(ValueError):
        over_ordered(rows, [], ["rid"], index="v")


def test_times_as_keys(spark):
    df = spark.range(30).select("id", F.timestamp_seconds(100 - F.col("id")).alias("t"))
    got = over_ordered(df, [], ["t"], index="i", slices=4)
    assert all(r["i"] == 29 - r["id"] for r in got.collect())
