"""Logs that come in parts, and logs with broken lines."""

import pytest
from pyspark.sql import functions as F

from logfeat import sources
from logfeat.operators import rollup
from logfeat.operators.target_stats import grow_sums, stats_from_sums, target_stats
from logfeat.session import scratch_path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_broken_lines_are_set_aside(spark):
    path = scratch_path(spark, "lines")
    good = [f"e{i},a{i},{1_600_000_000 + i},p" for i in range(96)]
    broken = ["e,a,soon,p", "e,a", "e,a,1,p,more", ""]
    spark.createDataFrame([(x,) for x in good + broken], "line string").write.text(path)
    log = sources.read_log(spark, path, errors=f"{path}-errors", max_share=0.05)
    assert log.count() == 96 and {r["us"] for r in log.select("us").collect()} == {
        (1_600_000_000 + i) * 1_000_000 for i in range(96)}
    table = spark.read.parquet(f"{path}-errors")
    assert {r["line"] for r in table.collect()} == set(broken) - {""}  # empty lines are no lines
    assert all("lines" in r["file"] for r in table.collect())
    with pytest.raises(ValueError, match="3 of 99 lines are broken"):
        sources.read_log(spark, path, errors=f"{path}-errors2", max_share=0.01)
    assert spark.read.parquet(f"{path}-errors2").count() == 3  # to look at
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        sources.read_log(spark, path).collect()


def test_broken_labels(spark):
    path = scratch_path(spark, "labels")
    spark.createDataFrame([("a,1",), ("b,0",), ("c,x",), ("d",)], "line string").write.text(path)
    got = sources.read_labels(spark, path, errors=f"{path}-errors", max_share=0.5)
    assert rows(got) == [("a", 1.0), ("b", 0.0)]


def test_sums_grow_part_by_part(spark):
    log = spark.range(3000).select(
        F.nullif((F.col("id") * 7 % 13).cast("string"), F.lit("5")).alias("actor"),
        F.nullif((F.col("id") % 4).cast("int"), F.lit(3)).alias("fold"),
        F.nullif((F.col("id") * 31 % 5).cast("double"), F.lit(2.0)).alias("target"), "id")
    path, before = scratch_path(spark, "sums"), None
    for k in range(3):
        before, last = f"{path}/{k}", before
        sums = grow_sums(log.where(F.col("id") % 3 == k), "actor", before, last, centre=1.5)
    got, want = (df.select("actor", "fold", *[F.round(c, 9) for c in ("actor_mean", "actor_std", "actor_sum")])
                 for df in (stats_from_sums(sums, "actor", centre=1.5), target_stats(log, "actor", centre=1.5)))
    assert rows(got) == rows(want) and len(rows(got)) > 30


def test_united_sketches_equal_the_whole_and_keep_their_bound(spark):
    log = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("entity"),
        (F.col("id") * 17 % 9973).cast("string").alias("actor"),
        F.nullif((F.col("id") % 7).cast("string"), F.lit("3")).alias("product"), "id")
    parts = [rollup.entity_sketches(log.where(F.col("id") % 4 == k)) for k in range(4)]
    got = {r["entity"]: r for r in rollup.sketch_counts(rollup.unite_sketches(parts)).collect()}
    whole = {r["entity"]: r for r in rollup.sketch_counts(rollup.entity_sketches(log)).collect()}
    exact = {r["entity"]: r for r in rollup.entity_counts(log).collect()}
    assert set(got) == set(exact)
    for e, r in exact.items():
        assert got[e]["n_rows"] == r["n_rows"] and got[e]["n_products"] == r["n_products"]
        assert abs(got[e]["n_actors"] - r["n_actors"]) <= 0.05 * r["n_actors"]  # three deviations
        assert abs(got[e]["n_actors"] - whole[e]["n_actors"]) <= 0.02 * r["n_actors"]
