"""Raw files to predictions, once, on a small made log."""

import os
import random

import pytest
from pyspark.sql import functions as F

from logfeat import plans, sources
from logfeat.operators import matrix, scoring
from logfeat.operators.factors import both_factors, known_and_all, latent_factors
from logfeat.plans.features import feature_columns


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    rng = random.Random(5)
    train = [(f"e{i:03d}", i % 2) for i in range(60)]
    test = [f"t{i:02d}" for i in range(15)]
    (root / "train.csv").write_text("".join(f"{e},{t}\n" for e, t in train))
    (root / "test.csv").write_text("".join(f"{e},0.5\n" for e in test))
    (root / "train_ex.txt").write_text("e000\n")
    (root / "test_ex.txt").write_text("t00\n")
    logs = root / "logs"
    logs.mkdir()
    for part in range(3):
        lines = []
        for e, t in [*train, *((e, rng.randint(0, 1)) for e in test), ("unknown", 0)]:
            for _ in range(4):
                actor = f"c{rng.randint(0, 5) + 4 * t}"
                lines.append(f"{e},{actor},{1_490_000_000 + rng.randint(0, 9999)},"
                             f"{rng.choice(['p1', 'p2', ''])}\n")
        (logs / f"{part}.csv").write_text("".join(lines))
    return plans.prepare(
        spark, train=str(root / "train.csv"), test=str(root / "test.csv"),
        train_exceptions=str(root / "train_ex.txt"), test_exceptions=str(root / "test_ex.txt"),
        log=f"{logs}/*.csv", out=str(root / "out"), n_folds=3)


def test_prepare(prepared):
    log, entities = prepared
    assert entities.count() == 59 + 14
    assert entities.where("fold IS NULL").count() == 14
    assert entities.where("fold IS NULL AND target IS NOT NULL").count() == 0
    sizes = [r["count"] for r in entities.where("target = 1").groupBy("fold").count().collect()]
    assert sorted(sizes) == [10, 10, 10]
    assert log.count() == 73 * 12 and log.select("rid").distinct().count() == 73 * 12
    assert log.where("entity IN ('unknown', 'e000', 't00')").count() == 0
    assert log.where("product = 'nan'").count() > 0 and log.where("product IS NULL").count() == 0


def test_targets_that_are_no_numbers_and_broken_lines(spark, tmp_path):
    (tmp_path / "labels.csv").write_text("a,1\nb,NaN\nc,0.5\n")
    rows = {r["entity"]: r["target"] for r in sources.read_labels(
        spark, str(tmp_path / "labels.csv")).collect()}
    assert rows == {"a": 1.0, "b": None, "c": 0.5}
    (tmp_path / "log.csv").write_text("a,x,100,p\na,x,not a time,p\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        sources.read_log(spark, str(tmp_path / "log.csv")).collect()
    loose = sources.read_log(spark, str(tmp_path / "log.csv"), mode="PERMISSIVE")
    assert loose.where("us IS NULL").count() == 1


def test_scratch_without_a_preset_folder(spark, monkeypatch):
    from logfeat import session

    class Conf:
        def get(self, key, default=None):
            return None if key == "spark.checkpoint.dir" else spark.conf.get(key, default)

    monkeypatch.setattr(type(spark), "conf", property(lambda self: Conf()))
    monkeypatch.setattr(session, "_LOCAL_ROOTS", {})
    folder = os.path.dirname(session.scratch_path(spark, "x"))
    assert folder == os.path.dirname(session.scratch_path(spark, "y"))
    assert session.settle(spark.range(3)).count() == 3 and os.listdir(folder)
    session.clear_scratch(spark)
    assert not os.path.exists(folder)


def test_feature_table_has_183_columns(prepared):
    log, entities = prepared
    table = plans.feature_table(log, entities)
    assert len(feature_columns(table)) == 183
    sliced = plans.feature_table(log, entities, slices=5, group_rows=6)
    a, b = ({r["entity"]: r for r in t.collect()} for t in (table, sliced))
    assert len(a) == 73 and a.keys() == b.keys()
    for e in a:
        for c in table.columns:
            x, y = a[e][c], b[e][c]
            assert x == y or x == pytest.approx(y, abs=1e-9), (e, c)


def test_factors_rank_seen_pairs_first(spark):
    cells = [(f"e{i}", f"c{j}", 1.0) for i in range(20) for j in range(20) if i % 2 == j % 2]
    coo = spark.createDataFrame(cells, "entity string, feature string, value double")
    vectors = {r["entity"]: r["factors"] for r in latent_factors(coo, 2).collect()}
    assert len(vectors) == 20

    def alike(a, b):
        return sum(x * y for x, y in zip(vectors[a], vectors[b]))

    assert alike("e0", "e2") > alike("e0", "e1")


def test_factors_rebuild_the_cells(spark):
    cells = [(f"e{i}", f"c{j}", 1.0) for i in range(20) for j in range(20) if i % 2 == j % 2]
    coo = spark.createDataFrame(cells, "entity string, feature string, value double")
    rows, cols = both_factors(coo, 2)
    u, v = ({r[0]: r["factors"] for r in t.collect()} for t in (rows, cols))
    got = {r["entity"]: r for r in known_and_all(coo, rows, cols).collect()}
    assert len(got) == 20
    for e, r in got.items():
        p = {c: sum(x * y for x, y in zip(u[e], v[c])) for c in v}
        own = [p[c] for a, c, _ in cells if a == e]
        assert r["cells"] == 10 and r["known"] == pytest.approx(sum(own) / 10, abs=1e-6)
        assert r["overall"] == pytest.approx(sum(p.values()) / 20, abs=1e-6)
        assert r["known"] > 0.5 > r["overall"] + 0.01
    # vectors that belong to other entities do not pass for a fit
    other = rows.withColumn("entity", F.concat(F.lit("e"), (
        F.substring("entity", 2, 9).cast("int") + 1) % 20))
    assert all(r["known"] < 0.5 for r in known_and_all(coo, other, cols).collect())


def test_blocks_of_stacked_matrices(spark):
    def cells(*rows):
        return spark.createDataFrame(rows, "entity string, feature long, value double")

    a = matrix.Matrix(cells(("x", 0, 3.0), ("x", 1, 4.0), ("y", 1, 1.0)), 2)
    b = matrix.Matrix(cells(("x", 0, 5.0)), 3)
    m = matrix.hstack([a, matrix.hstack([b, a])])
    assert (m.width, m.starts) == (7, (0, 2, 5))
    got = {(r["entity"], r["block"]): (r["cells"], r["total"], r["length"])
           for r in matrix.block_sums(m).collect()}
    assert got == {("x", 0): (2, 7.0, 5.0), ("y", 0): (1, 1.0, 1.0), ("x", 1): (1, 5.0, 5.0),
                   ("x", 2): (2, 7.0, 5.0), ("y", 2): (1, 1.0, 1.0)}


def test_matrix_and_scores(prepared):
    log, entities = prepared
    ranks = {"user": 3, "product": 2, "gap_entity": 2, "gap_actor": 2, "gap_product": 2}
    m = plans.feature_matrix(log, entities, ranks=ranks, iterations=2)
    assert m.width > 183 + 3 + 2 + 2 + 2 + 2
    top = m.coo.agg(F.max("feature"), F.min("feature")).first()
    assert top[0] < m.width and top[1] >= 0
    assert m.coo.groupBy("entity", "feature").count().where("count > 1").count() == 0
    preds, aucs = plans.score(
        m, entities, lambda seed: scoring.gbt(seed, rounds=4, depth=2, leaf_rows=1, bins=16,
                                              step=0.3), n_folds=3, n_bags=2)
    rows = preds.collect()
    assert len(rows) == 14 and {r["p"] for r in rows} >= {0.0, 1.0}
    aucs = aucs.collect()
    assert len(aucs) == 6 and all(r["auc"] > 0.6 for r in aucs)
