"""Steps that once shuffled every cell, or solved more than the data holds."""

import pytest
from pyspark.sql import functions as F

from logfeat.operators import factors, gaps, matrix, screens
from logfeat.session import co_locate, deal_out, settle


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def cells_of(df):
    return sorted((r["entity"], -1 if r["feature"] is None else r["feature"], round(r["value"], 12))
                  for r in df.collect())


@pytest.fixture(scope="module")
def lists(spark):
    return settle(spark.range(300).selectExpr(
        "CAST(id AS STRING) AS entity",
        "transform(sequence(1, 1 + id % 7), j -> CAST(id * j * j % 23 AS STRING)) AS words"))


def test_lists_of_single_rows_make_their_cells_unshuffled(lists):
    text = plan(matrix.hashed_list_ngrams(lists, "words"))
    assert "feature#" in text and "hashpartitioning(entity" not in text


def test_lists_in_rows_and_in_a_shuffle_give_the_same_cells(spark, lists):
    whole = cells_of(matrix.hashed_list_ngrams(lists, "words"))
    terms = matrix._list_terms(lists.withColumnRenamed("words", "__a"), (1.5, 1.0), "binary")
    assert whole == cells_of(matrix._bag(terms, 2**28, "binary", True, "xxhash64"))
    # an entity in two rows has the cells of both, and null, empty and entity-less lists have none
    odd = spark.createDataFrame(
        [("d", ["a", "b"]), ("d", ["b", "c"]), ("s", ["a", None]), ("n", None), ("z", []), (None, ["a"])],
        "entity string, words array<string>")
    got = matrix.hashed_list_ngrams(odd, "words", norm=False).groupBy("entity").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("s")).collect()
    assert {r["entity"]: (r["n"], r["s"]) for r in got} == {"d": (5, 6.5), "s": (3, 4.0)}


def test_few_buckets_keep_the_larger_weight(lists):
    for weights in ((1.5, 1.0), (1.0, 2.0)):
        terms = matrix._list_terms(lists.withColumnRenamed("words", "__a"), weights, "binary")
        assert cells_of(matrix.hashed_list_ngrams(lists, "words", weights=weights, buckets=5)) == cells_of(
            matrix._bag(terms, 5, "binary", True, "xxhash64"))


def test_tokens_gathered_and_sliced_give_the_same_cells(lists):
    tokens = lists.select("entity", F.posexplode("words").alias("at", "token"))
    want = cells_of(matrix.hashed_list_ngrams(lists, "words"))
    for list_rows in (50_000, 4, 0):
        assert cells_of(matrix.hashed_ngrams(tokens, "token", order=["at"], list_rows=list_rows)) == want


def test_only_cells_of_rare_features_are_shuffled(lists):
    coo = settle(matrix.hashed_list_ngrams(lists, "words", buckets=50))
    plain = coo.join(matrix.doc_freq(coo).where("df > 3").select("feature"), "feature", "left_semi")
    kept = settle(matrix.doc_freq(coo).where("df > 3"))
    want = cells_of(plain.select("entity", "feature", "value"))
    assert "hashpartitioning" not in plan(matrix.min_doc_freq(coo, 3))
    for most in (0, 10, 1_000):
        assert cells_of(matrix.keep_features(coo, kept, most)) == want
    assert cells_of(screens.screened_doc_freq(coo, 3, bits=64)) == want
    codes = {f: i for i, f in enumerate(sorted({r["feature"] for r in coo.collect()}))}
    want = sorted((e, codes[f], v) for e, f, v in cells_of(coo))
    for most in (0, 10, 1_000):
        m = matrix.reindex(coo, most=most)
        assert m.width == len(codes) and cells_of(m.coo) == want


def test_rows_of_one_partition_are_dealt_out(spark):
    assert deal_out(spark.range(0, 1000, 1, 1)).select(F.spark_partition_id()).distinct().count() > 1
    even = spark.range(0, 1000, 1, 8)
    assert deal_out(even) is even


def test_factors_are_solved_in_no_more_numbers_than_the_matrix_has_columns(spark, monkeypatch):
    ranks, als = [], factors.ALS
    monkeypatch.setattr(factors, "ALS", lambda **kw: ranks.append(kw["rank"]) or als(**kw))
    coo = spark.range(60).selectExpr("CAST(id AS STRING) AS entity", "explode(array(id % 5, id * 3 % 7)) AS feature",
                                     "1D AS value").distinct()
    rows, cols = factors.both_factors(coo, 20)
    assert ranks == [7]
    assert {r["n"] for r in rows.union(cols).select(F.size("factors").alias("n")).collect()} == {20}
    seen = factors.known_and_all(coo, rows, cols).collect()
    assert len(seen) == 60 and all(r["known"] > 0.5 and r["known"] > r["overall"] for r in seen)


def test_stretching_keeps_products(spark):
    a, b = [0.5, -2.0, 3.0], [1.0, 4.0, 0.25]
    for rank in (3, 4, 7, 9):
        r = spark.createDataFrame([(a, b)], "a array<float>, b array<float>").select(
            factors.stretched("a", 3, rank).alias("a"), factors.stretched("b", 3, rank).alias("b")).first()
        assert len(r["a"]) == rank
        assert sum(x * y for x, y in zip(r["a"], r["b"])) == pytest.approx(-6.75, rel=1e-5)


def test_gaps_of_groups_that_fit_a_slice_are_placed_once(spark):
    log = settle(spark.range(6_000).selectExpr(
        "id AS rid", "id * 997 % 6011 AS us", "CAST(nullif(id % 40, 7) AS STRING) AS actor"))
    whole = gaps.chained_gaps(log, {"gap": None, "gap_actor": "actor"}, slices=5)
    plain = gaps.chained_gaps(log, {"gap": None, "gap_actor": "actor"})
    assert "windowspecdefinition(actor" in plan(plain)
    assert sorted(map(str, plain.collect())) == sorted(map(str, whole.select(*plain.columns).collect()))


def test_tables_of_a_table_in_buckets_are_not_shuffled(spark):
    rows = spark.range(500).selectExpr("CAST(id % 50 AS STRING) AS entity", "id")
    log = co_locate(rows, "entity", 4, "log")
    sums = log.groupBy("entity").agg(F.sum("id").alias("s"))
    assert "Exchange" not in plan(sums)
    table = co_locate(sums, "entity", 4, lies=True)
    assert len(table.inputFiles()) <= 4 and sorted(map(str, table.collect())) == sorted(
        map(str, rows.groupBy("entity").agg(F.sum("id").alias("s")).collect()))
