"""Radix selection against sorted lists, on awkward numbers and on groups of every size."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from logfeat.operators import rollup, selection
from logfeat.session import settle


def bits(x):
    return struct.unpack("q", struct.pack("d", x))[0]


def test_keys_order_as_doubles_do(spark):
    rng = random.Random(3)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, math.inf, -math.inf, math.nan, 8 - 2**-50]
    for _ in range(3000):
        x = struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0]
        power = 2.0 ** rng.randint(-1022, 1023)  # and its neighbours
        values += [x if x == x else 1.0, power, math.nextafter(power, 0), -math.nextafter(power, math.inf)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").selectExpr(
        "i", f"{selection.order_key('v')} AS k").collect()
    for r in rows:
        v = values[r["i"]]
        want = bits(math.inf) + 1 if v != v else bits(abs(v)) * (-1 if v < 0 else 1)
        assert r["k"] == want, v


@pytest.mark.parametrize("seed", range(3))
def test_ranks_of_all_groups(spark, seed):
    rng = random.Random(seed)
    keys = {"one": [5], "same": [7] * 40, "edge": [-2**63, 2**63 - 1, 0, -1, 1],
            "near": [rng.randint(-3, 3) for _ in range(50)],
            "wide": [rng.randint(-2**62, 2**62) for _ in range(300)],
            "skew": [2 ** rng.randint(0, 60) for _ in range(200)] + [10**6] * 500}
    rows = spark.createDataFrame([(g, k) for g, ks in keys.items() for k in ks], "g string, key long")
    cells = settle(rows.groupBy("g", "key").agg(F.count(F.lit(1)).alias("n")))
    asked = [(g, r) for g, ks in keys.items() for r in {0, len(ks) - 1, *(
        rng.randrange(len(ks)) for _ in range(6))}]
    wanted = spark.createDataFrame(asked + asked[:3], "g string, r long")  # repeated wishes
    got = selection.select_ranks(cells, wanted, ["g"]).collect()
    assert len(got) == len(asked)
    for row in got:
        assert row["key"] == sorted(keys[row["g"]])[row["r"]]
    assert selection.select_ranks(cells.limit(0), wanted.limit(0), ["g"]).count() == 0


def test_statistics_equal_those_of_lists(spark):
    rows = settle(spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 97).cast("string")).alias("g"),
        F.when(F.col("id") % 11 != 0, F.sin("id") * F.pow(10.0, F.col("id") % 9)).alias("x"),
        (F.col("id") % 7).cast("int").alias("y"),
        F.when(F.col("id") % 97 != 5, F.lit(2.5)).alias("z")))  # null for all of one group
    one, two = (rollup.rollup_stats(rows, "g", ["x", "y", "z"], radix=r, fill=-1.0, extra=[
        F.sum("y").alias("total")]).orderBy("g").collect() for r in (False, True))
    assert one == two and len(one) == 98


def test_whole_numbers_of_small_groups_are_counted_in_one_level(spark, monkeypatch):
    stored, settle_ = [], selection.settle
    monkeypatch.setattr(selection, "settle", lambda df, name="table": stored.append(name) or settle_(df, name))
    rng = random.Random(7)
    sizes = {"none": 0, "one": 1, "two": 2, "full": 127, **{f"g{i}": rng.randint(1, 60) for i in range(40)}}
    wide = 2**53 + 1

    def row(g):
        some = lambda x, share=0.2: None if rng.random() < share else x
        return (g, rng.randint(-3, 444), some(rng.randint(0, 6)), 5, some(wide + rng.randint(0, 9)),
                some(rng.choice([-5, 60000])), rng.random(), None)

    kinds = "g string, days int, some byte, same smallint, far long, wide int, x double, never int"
    rows = [row(g) for g, n in sizes.items() for _ in range(n)] + [row(None)] * 3
    small = settle(spark.createDataFrame(rows, kinds))
    large = settle(spark.createDataFrame(rows + [row(g) for g in ("hot", "full") for _ in range(200)], kinds))
    narrow = ["days", "some", "same", "far"]
    for df, cols in ((small, narrow), (large, [*narrow, "wide", "x", "never"])):
        stored.clear()
        one, two = (rollup.rollup_stats(df, "g", cols, radix=r, extra=[F.sum("days").alias("total")])
                    .orderBy("g").collect() for r in (False, True))
        assert len(one) == len(two) > 40
        for a, b in zip(one, two):  # sums of another order may differ in their last bits
            for c in a.asDict():
                if not c.endswith(("_mean", "_std")):
                    assert a[c] == b[c], (a["g"], c)
                elif not c.startswith("far") and a[c] != b[c]:
                    assert a[c] == pytest.approx(b[c], rel=1e-9, nan_ok=True), (a["g"], c)
        assert ("hist" in stored) == (df is large)
    assert rollup.rollup_stats(small.limit(0), "g", narrow, radix=True).count() == 0


def test_packed_counts_hold_all_ranks(spark):
    rng = random.Random(8)
    groups = {g: sorted(rng.choices(range(-9, 439), k=rng.choice([1, 3, 50, 126, 127]))) for g in range(30)}
    groups[30], groups[31] = [438] * 127, [-9] * 127
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g int, v int")
    counts = selection.packed_counts("v", -9, 438)
    assert len(counts) == 64
    place = selection.packed_place("w", "r")
    got = df.groupBy("g").agg(F.expr(f"array({', '.join(counts)})").alias("w")).selectExpr(
        "g", f"{selection.running_counts('w')} AS w").join(df.groupBy("g").count(), "g").selectExpr(
        "g", f"transform(sequence(0L, count - 1), r -> {place} - 9) AS all")
    assert {r["g"]: r["all"] for r in got.collect()} == groups


def test_recency_with_ties_and_nulls(spark):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.nullif(
            (F.col("id") % 31).cast("string"), F.lit("4"))).alias("entity"),
        F.when(F.col("id") % 13 != 0, F.col("id") * 7 % 501).alias("us"), F.col("id").alias("rid"))
    rows = rows.unionByName(spark.createDataFrame([("none", None, 9)], rows.schema))
    one, two = (rollup.recency(rows, radix=r).orderBy("entity").collect() for r in (False, True))
    assert one == two and len(one) > 15


def test_plan_has_no_lists_and_no_window(spark):
    rows = spark.range(500).select((F.col("id") % 5).alias("g"), F.sqrt("id").alias("x"))
    for df in (rollup.rollup_stats(rows, "g", ["x"], radix=True),
               rollup.recency(rows.selectExpr("g AS entity", "CAST(x AS BIGINT) AS us", "g AS rid"), radix=True)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in text and "Window" not in text
