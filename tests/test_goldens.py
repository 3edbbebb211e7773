"""Small hand-made cases for rules the driver tables do not show."""

import datetime
import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from logfeat import functions as fn
from logfeat import sources
from logfeat.operators import gaps, keys, matrix, rollup, scaling, scoring, sequences
from logfeat.operators.target_stats import target_stats
from logfeat.session import settle

LOG = "entity string, actor string, product string, us bigint, rid bigint"


def one(df):
    return df.collect()[0].asDict()


def table(df, key="entity"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_null_fold_takes_all_folds_and_joins(spark):
    log = spark.createDataFrame(
        [("k", 0, 1.0), ("k", 0, 0.0), ("k", 1, 1.0), ("k", None, None), ("solo", 0, 1.0),
         ("two", 0, 1.0), ("two", 1, 0.0), (None, 0, 1.0)],
        "actor string, fold int, target double")
    stats = target_stats(log, "actor")
    rows = {(r["actor"], r["fold"]): r for r in stats.collect()}
    assert rows["k", None]["actor_sum"] == 2.0
    assert rows["k", None]["actor_mean"] == pytest.approx(2 / 3)
    assert rows["k", 0]["actor_mean"] == 1.0 and rows["k", 0]["actor_std"] is None
    assert ("solo", 0) not in rows  # no other fold has it
    assert rows["two", 0]["actor_mean"] == 0.0 and rows["two", 1]["actor_mean"] == 1.0
    assert all(k is not None for k, _ in rows)
    joined = keys.attach_by_fold(log, stats, "actor")
    assert joined.count() == 8
    unlabelled = joined.where("actor = 'k' AND fold IS NULL").collect()
    assert unlabelled[0]["actor_sum"] == 2.0
    assert joined.where("actor IS NULL").collect()[0]["actor_mean"] is None


def test_target_stats_do_not_leak_the_own_fold(spark):
    rows = [("k", i % 3, float(i % 2)) for i in range(12)]
    flipped = [(k, f, 1.0 - t if f == 1 else t) for k, f, t in rows]
    schema = "actor string, fold int, target double"
    a, b = (target_stats(spark.createDataFrame(r, schema), "actor").where("fold = 1").collect()
            for r in (rows, flipped))
    assert a == b


def test_real_targets_with_a_centre(spark):
    rows = [("k", i % 2, 1e9 + i) for i in range(10)]
    df = spark.createDataFrame(rows, "actor string, fold int, target double")
    got = {r["fold"]: r for r in target_stats(df, "actor", centre=1e9).collect()}
    odd = [1e9 + i for i in range(1, 10, 2)]
    mean = sum(odd) / 5
    assert got[0]["actor_mean"] == pytest.approx(mean, abs=1e-6)
    assert got[0]["actor_std"] == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in odd) / 4))


@pytest.mark.parametrize("group_rows", [1_000_000, 1])
def test_percentiles_see_nulls_and_the_median_does_not(spark, group_rows):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", 3.0), ("b", 5.0), ("c", None), (None, 1.0)],
        "entity string, x double")
    got = table(rollup.rollup_stats(df, "entity", ["x"], group_rows=group_rows))
    assert set(got) == {"a", "b", "c"}
    assert got["a"]["x_median"] == 2.0 and got["a"]["x_mean"] == 2.0
    assert all(got["a"][f"x_{p}"] is None for p in ("10per", "25per", "75per", "90per"))
    assert got["b"]["x_std"] is None and got["b"]["x_90per"] == 5.0
    assert got["c"]["x_median"] is None and got["c"]["x_min"] is None
    filled = table(rollup.rollup_stats(df, "entity", ["x"], fill=-1.0, group_rows=group_rows))
    assert filled["b"]["x_std"] == -1.0


@pytest.mark.parametrize("limit", [5, 40, 10_000])
def test_hot_groups_get_the_same_statistics(spark, limit):
    df = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 20))
        .alias("entity"),
        (F.col("id") * 7919 % 101).cast("double").alias("x"),
        F.when(F.col("id") % 50 != 0, F.col("id") % 7).cast("double").alias("y"))
    extra = [F.count(F.lit(1)).alias("rows")]
    base = table(rollup.rollup_stats(df, "entity", ["x", "y"], extra=extra))
    got = table(rollup.rollup_stats(df, "entity", ["x", "y"], extra=extra, group_rows=limit,
                                    slices=5))
    assert base.keys() == got.keys()
    for e, row in base.items():
        for c, v in row.items():
            assert got[e][c] == (pytest.approx(v) if isinstance(v, float) else v), (e, c)


def test_index_percentile_is_the_tenth_of_twelve(spark):
    log = spark.createDataFrame([("e", None, "p", i * 1_000_000, i) for i in range(12)], LOG)
    got = one(rollup.recency(log))
    assert got["age_90per"] == 2.0  # the discrete percentile would give the 11th row
    assert got["age_min"] == 11.0 and got["age_max"] == 0.0 and got["age_range"] == 11.0


def test_single_row_entity(spark):
    log = spark.createDataFrame([("e", "a", "p", 5, 1)], LOG)
    rows = gaps.all_gaps(log)
    assert [rows.first()[c] for c in ("gap", "gap_entity", "gap_actor", "gap_product")] == [None] * 4
    stats = one(rollup.rollup_stats(rows.fillna(-1.0), "entity", ["gap"]))
    assert stats["gap_mean"] == -1.0 and stats["gap_std"] is None


def test_null_product_is_a_group_and_null_actor_is_not(spark):
    log = spark.createDataFrame(
        [("e", None, None, 1_000_000, 1), ("e", None, None, 3_000_000, 2),
         ("f", "a", "p", 4_000_000, 3)], LOG).withColumn("product", fn.str_key("product"))
    rows = table(gaps.all_gaps(log), "rid")
    assert rows[2]["gap_product"] == 2.0 and rows[2]["gap_actor"] is None
    assert rows[3]["gap"] == 1.0
    coded = table(gaps.group_gap(log, "actor", null_group=True), "rid")
    assert coded[2]["gap_actor"] == 2.0
    assert table(rollup.entity_counts(log))["e"]["n_products"] == 1
    assert table(rollup.entity_counts(log))["e"]["n_actors"] == 0


def test_ties_follow_the_tie_breaker(spark):
    log = spark.createDataFrame([("a", "x", "p", 7, 3), ("b", "x", "p", 7, 1),
                                 ("c", "x", "p", 7, 2)], LOG)
    lists = sequences.collect_sequence(log, ["entity"], entity="actor")
    assert one(lists)["entity"] == ["b", "c", "a"]


@pytest.mark.parametrize("chunk", [2, 100])
def test_lists_keep_nulls_in_place_and_continue_in_chunks(spark, chunk):
    log = spark.createDataFrame([("e", "a", "p", i * 1_000_000, i) for i in range(5)], LOG)
    lists = sequences.collect_sequence(
        gaps.global_gap(log), ["gap"], chunk_rows=chunk, slices=3).orderBy("chunk").collect()
    assert [x for r in lists for x in r["gap"]] == [None, 1.0, 1.0, 1.0, 1.0]
    assert all(len(r["gap"]) <= chunk for r in lists)


def test_sentinel_and_exceptions(spark):
    labels = spark.createDataFrame([("a", 1.0), ("b", 0.5), ("x", 0.0)], "entity string, target double")
    listed = spark.createDataFrame([("x",), (None,)], "entity string")
    kept = keys.exclude(labels, listed).withColumn("target", fn.sentinel_to_null("target"))
    assert {r["entity"]: r["target"] for r in kept.collect()} == {"a": 1.0, "b": None}
    twice = spark.createDataFrame([("a",), ("a",)], "entity string")
    assert keys.keep_known(labels, twice).count() == 1


@pytest.mark.parametrize("slices", [1, 4])
def test_fold_sizes(spark, slices):
    df = spark.createDataFrame([(f"e{i:02d}", 1.0) for i in range(23)] + [("u", None), ("z", 0.0)],
                               "entity string, target double")
    got = keys.stratified_folds(df, 10, slices=slices)
    sizes = [r["count"] for r in got.where("target = 1").groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [3, 3, 3, 2, 2, 2, 2, 2, 2, 2]
    rows = table(got)
    assert rows["e00"]["fold"] == 0 and rows["e22"]["fold"] == 9
    assert rows["u"]["fold"] is None and rows["z"]["fold"] == 0


@pytest.mark.parametrize("length", [0, 2, 500, 501])
def test_padding(spark, length):
    df = spark.createDataFrame([(list(range(1, length + 1)),)], "a array<int>")
    got = df.select(fn.pad_sequence("a", 500).alias("a")).first()["a"]
    assert got == ([0] * (500 - length) + list(range(1, length + 1)) if length <= 500
                   else list(range(2, 502)))


@pytest.mark.parametrize("n", [3, 2_000])
def test_last_rows(spark, n):
    log = spark.createDataFrame([("e" if i % 3 else "f", None, "p", i, i) for i in range(20)], LOG)
    got = sequences.padded_sequences(log, ["rid"], n)
    for e, row in table(got).items():
        tail = [i for i in range(20) if ("e" if i % 3 else "f") == e][-n:]
        assert row["rid"] == [0] * (n - len(tail)) + tail


def test_scaling_rules(spark):
    df = spark.createDataFrame([(1.0, -1.0, None), (3.0, -1.0, 4.0)], "a double, b double, c double")
    fill = scaling.scale_columns(df, ["a", "b", "c"]).collect()
    assert [r["a"] for r in fill] == [-0.25, 0.25]  # population std 1, mean 2
    assert [r["b"] for r in fill] == [None, None]  # std + mean + 1 = 0
    assert [r["c"] for r in fill] == [pytest.approx((-1 - 1.5) / 5), pytest.approx((4 - 1.5) / 5)]
    skip = scaling.scale_columns(df, ["c"], nulls="skip").collect()
    assert [r["c"] for r in skip] == [-1.0, 0.0]
    assert scaling.drop_degenerate(df, ["a", "b", "c"]).columns == ["a"]
    assert scaling.drop_degenerate(df, ["a", "c"], constant=False, nulls=True).columns == ["a", "b"]


def test_minmax_of_constant_is_null(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "p double")
    assert [r["p"] for r in scaling.minmax(df, "p").collect()] == [None, None]


@pytest.mark.parametrize("slices", [1, 3])
def test_auc_with_ties(spark, slices):
    df = spark.createDataFrame([(1, .5), (0, .5), (0, .2), (1, .9)], "target int, p double")
    assert one(scoring.auc(df, slices=slices))["auc"] == 0.875
    flipped = df.withColumn("p", -F.col("p"))
    assert one(scoring.auc(flipped, slices=slices))["auc"] == 0.125
    assert one(scoring.auc(df.where("target = 1")))["auc"] is None


def test_document_frequency_is_strict(spark):
    coo = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 1.0), ("a", "y", 1.0)],
                                "entity string, feature string, value double")
    assert {r["feature"] for r in matrix.min_doc_freq(coo, 1).collect()} == {"x"}
    assert matrix.min_doc_freq(coo, 2).count() == 0


def test_hstack_offsets_follow_declared_widths(spark):
    coo = spark.createDataFrame([("a", 0, 1.0)], "entity string, feature bigint, value double")
    both = matrix.hstack([matrix.Matrix(coo, 5), matrix.Matrix(coo, 3)])
    assert both.width == 8
    assert sorted(r["feature"] for r in both.coo.collect()) == [0, 5]


def test_dense_names_every_feature(spark):
    coo = spark.createDataFrame([("a", 6, 1.0)], "entity string, feature bigint, value double")
    with pytest.raises(ValueError):
        matrix.to_dense(matrix.Matrix(coo, 7), [f"f{i}" for i in range(5)])
    assert one(matrix.to_dense(matrix.Matrix(coo, 7), [f"f{i}" for i in range(7)]))["f6"] == 1.0


def test_both_hashes_give_the_same_cells(spark):
    """Tokens, counts, weights and lengths agree; only bucket numbers differ."""
    rows = [(f"e{i % 3}", f"t{i * 7 % 11}", i) for i in range(60)]
    df = spark.createDataFrame(rows, "entity string, token string, at bigint")
    for tf in ("binary", "count"):
        cells = {h: sorted((r["entity"], round(r["value"], 12)) for r in matrix.hashed_ngrams(
            df, "token", order=["at"], tf=tf, hashing=h).collect()) for h in ("md5", "xxhash64")}
        assert cells["md5"] == cells["xxhash64"]


def test_boosting_builds_many_trees_by_default(spark):
    rows = [(f"e{i}", float((i * 37 % 101 + 25 * (i * i * 13 % 7)) > 120), i % 3,
             1.0 + i * 37 % 101, 1.0 + i * i * 13 % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "entity string, target double, fold int, a double, b double")
    block = matrix.to_coo(df.select("entity", "a", "b"), ["a", "b"])
    table = keys.attach(df.select("entity", "target", "fold"), matrix.to_vectors(block))
    train = table.withColumn("weight", F.lit(1.0))

    def model(n):
        return scoring.gbt(3, rounds=n, depth=2, leaf_rows=1)  # the default step

    many = model(30).fit(train)
    assert len(many.trees) == 30
    aucs = [one(scoring.fold_auc(scoring.crossfit(
        table, lambda seed: model(n), n_folds=1, patience=None)))["auc"] for n in (1, 30)]
    assert aucs[1] > aucs[0]


def noisy_rows(spark, n=600):
    """Labels that follow one column loosely; the default leaf size leaves room for splits."""
    rows = [(f"e{i}", float((i * 7919 % 101) + 60 * (i * 31 % 7 - 3) / 3 > 50), i % 3,
             1.0 + i * 7919 % 101, 1.0 + i * 13 % 17) for i in range(n)]
    df = spark.createDataFrame(rows, "entity string, target double, fold int, a double, b double")
    return keys.attach(df.select("entity", "target", "fold"), matrix.to_vectors(
        matrix.to_coo(df.select("entity", "a", "b"), ["a", "b"])))


def test_boosting_stops_by_patience(spark):
    """A fit that grows step by step keeps the rounds that a fit of all rounds would keep."""
    table = settle(noisy_rows(spark))
    train = table.where("fold != 0").withColumn("weight", F.lit(1.0)).coalesce(1)
    held = table.where("fold = 0").withColumn("weight", F.lit(1.0))
    model = scoring.gbt(1, rounds=40, step=0.5)  # default depth and leaf size
    kept, aucs = scoring.fit_patiently(model, train, held, patience=6)
    every = model.fit(train)
    assert any(t.numNodes > 1 for t in kept.trees) and len(aucs) < 40
    all_aucs = scoring.round_aucs(every, held)
    assert all_aucs[:len(aucs)] == pytest.approx(aucs)
    best, stop = scoring.best_round(all_aucs, 6)
    assert stop and len(kept.trees) == best
    # the AUC of a round is that of the model cut there
    p = kept.transform(held).select("target", vector_to_array("probability")[1].alias("p"))
    assert one(scoring.auc(p))["auc"] == pytest.approx(aucs[best - 1])
    assert [t.toDebugString for t in kept.trees] == [t.toDebugString for t in every.trees[:best]] or all(
        a.toDebugString.split("\n")[1:] == b.toDebugString.split("\n")[1:]
        for a, b in zip(kept.trees, every.trees))


def test_auc_of_a_round_is_that_of_all_trees_so_far(spark):
    """Every round, not only the best one, has the AUC of the model cut there."""
    table = settle(noisy_rows(spark).withColumn("weight", F.lit(1.0))).coalesce(1)
    train, held = table.where("fold != 0"), settle(table.where("fold = 0"))
    model = scoring.gbt(1, rounds=6, step=0.3, depth=3, leaf_rows=10).fit(train)

    def cut(n):
        p = scoring.first_rounds(model, n).transform(held)
        return one(scoring.auc(p.select("target", vector_to_array("probability")[1].alias("p"))))["auc"]

    want = [cut(n) for n in range(1, 7)]
    assert len(set(want)) > 1
    assert scoring.round_aucs(model, held) == pytest.approx(want)
    assert scoring.round_aucs(model, held, 4) == pytest.approx(want[4:])


def test_a_fit_takes_its_share_of_the_cores(spark, monkeypatch):
    assert scoring.fit_parts(9_000, 5, 12, 1) == 1
    assert scoring.fit_parts(92_000, 5, 12, 10) == 1  # levels wait for each other, fits do not
    assert scoring.fit_parts(500_000, 5, 12, 1) == 12
    assert scoring.fit_parts(500_000, 5, 12, 10) == 2  # more than lie in memory in one
    assert scoring.fit_parts(10_000, 50_000, 12, 10) > 12

    class Caught(Exception):
        pass

    def catch(estimator, train, held, patience):
        raise Caught(train.rdd.getNumPartitions())

    monkeypatch.setattr(scoring, "FIT_ROWS", 10)
    monkeypatch.setattr(scoring, "fit_patiently", catch)
    monkeypatch.setattr(scoring, "settle", lambda df, name="table": df)
    with pytest.raises(Caught) as caught:
        scoring.crossfit(noisy_rows(spark).repartition(8), scoring.gbt, n_folds=3, parallel=8)
    assert caught.value.args == (1,)


def test_best_round():
    assert scoring.best_round([0.5, 0.7, 0.6, 0.7], 2) == (2, True)
    assert scoring.best_round([0.5, 0.7, 0.6, 0.8, 0.8], 2) == (4, False)
    assert scoring.best_round([0.9, 0.7, 0.6, 0.95], 2) == (1, True)  # what comes later is too late
    assert scoring.best_round([None, None], 1) == (2, False)


def test_fits_side_by_side_give_the_same_scores(spark):
    table = settle(noisy_rows(spark, 300))

    def scores(parallel):
        got = scoring.crossfit(table, lambda seed: scoring.gbt(seed, rounds=6), n_folds=3, n_bags=2,
                               patience=2, parallel=parallel)
        return sorted(map(tuple, got.collect()))

    assert scores(1) == scores(4) and len(scores(4)) == 600


def test_labels_of_three_values_are_refused(spark):
    table = noisy_rows(spark, 30).withColumn("target", (F.col("fold") + 0.0))
    with pytest.raises(ValueError, match="two values"):
        scoring.crossfit(table, scoring.gbt)


def test_sparse_vectors(spark):
    cells = [("a", 7, 0.1), ("a", 2, -3.5), ("b", 0, 1e-300)]
    coo = spark.createDataFrame(cells, "entity string, feature bigint, value double")
    got = table(matrix.to_vectors(matrix.Matrix(coo, 9)))
    assert got["a"]["features"].toArray().tolist() == [0, 0, -3.5, 0, 0, 0, 0, 0.1, 0]
    assert got["b"]["features"].size == 9 and got["b"]["features"][0] == 1e-300


def test_blend_needs_every_model(spark):
    preds = spark.createDataFrame(
        [("m", "a", 0.5), ("n", "a", 1.0), ("m", "b", 0.5), ("n", "b", None), ("o", "a", 9.0)],
        "model string, entity string, p double")
    got = scoring.blend(preds, {"m": 0.25, "n": 0.75}).collect()
    assert [(r["entity"], r["p"]) for r in got] == [("a", 0.875)]


def test_hashed_ngrams_by_hand(spark):
    log = spark.createDataFrame(
        [("e", t, "p", i, i) for i, t in enumerate(["x", None, "x", None])] + [("f", "x", "p", 9, 9)],
        LOG)

    def bucket(text):
        return spark.range(1).select(matrix.bucket_of(F.lit(text), 2**28)).first()[0]

    want = {bucket("x"): 1.5, bucket("nan"): 1.5, bucket("x nan"): 1.0, bucket("nan x"): 1.0}
    count = {bucket("x"): 3.0, bucket("nan"): 3.0, bucket("x nan"): 2.0, bucket("nan x"): 1.0}
    for tf, expected in (("binary", want), ("count", count)):
        got = matrix.hashed_ngrams(log, "actor", tf=tf, norm=False, slices=3)
        assert {r["feature"]: r["value"] for r in got.where("entity = 'e'").collect()} == expected
        lists = spark.createDataFrame([("e", ["x", None, "x", None]), ("g", [])],
                                      "entity string, t array<string>")
        got = matrix.hashed_list_ngrams(lists, "t", tf=tf, norm=False)
        assert {r["feature"]: r["value"] for r in got.collect()} == expected
    length = matrix.hashed_ngrams(log, "actor").groupBy("entity").agg(
        F.sum(F.col("value") * F.col("value")).alias("s"))
    assert all(r["s"] == pytest.approx(1.0) for r in length.collect())


def test_columns_and_text(spark):
    df = spark.createDataFrame([("a1b2aC", ["x", None, "z"], 1_700_000_000)],
                               "s string, a array<string>, e bigint")
    row = df.select(
        fn.count_digits("s").alias("d"), fn.count_char("s", "a").alias("a"),
        fn.list_to_text("a").alias("t"), fn.list_to_text(fn.with_ngrams(F.array(
            F.lit("x"), F.lit("y"), F.lit("z")), 3)).alias("g"),
        fn.list_to_text(fn.with_ngrams(F.array(F.lit("x")), 3)).alias("short"),
        F.date_format(fn.from_epoch("e"), "yyyy-MM-dd HH:mm:ss").alias("ts"),
        fn.micros(fn.parse_ts(F.lit("2024-01-01 00:00:01"))).alias("us"),
    ).first().asDict()
    assert row == {"d": 2, "a": 2, "t": "x nan z", "g": "x y z xy yz xyz", "short": "x",
                   "ts": "2023-11-14 22:13:20", "us": 1_704_067_201_000_000}
    monday = spark.range(1).select(*fn.date_parts(F.lit("2024-12-30").cast("timestamp"))).first()
    assert (monday["weekday"], monday["week"], monday["yearday"]) == (0, 1, 365)


def test_run_labels():
    day = datetime.date(2018, 3, 13)
    assert sources.run_label("GBT", 50, day) == "GBT_50bag_0313"
    assert sources.run_label("Blend", date=day) == "Blend_0313"


def test_codes(spark):
    df = spark.createDataFrame([("b", 10.0), ("a", 9.0), (None, None), ("b", 100.0)],
                               "s string, x double")
    rows = keys.label_codes(keys.label_codes(df, "s"), "x").collect()
    assert {(r["s"], r["x"]): (r["s_code"], r["x_code"]) for r in rows} == {
        ("b", 10.0): (1, 1), ("a", 9.0): (0, 0), (None, None): (-1, -1), ("b", 100.0): (1, 2)}


def test_class_weights(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,), (None,)], "target double")
    got = {r["target"]: r["weight"] for r in scoring.balanced_weight(df).collect()}
    assert got == {1.0: 2.0, 0.0: pytest.approx(4 / 6), None: None}
