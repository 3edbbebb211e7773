"""Cross-fitted models, exact AUC and blending."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path, settle
from .keys import fold_split, stack
from .ordered import over_ordered
from .scaling import minmax


def auc(
    df: DataFrame, label: str = "target", score: str = "p", by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Exact area under the ROC curve, ties counting half; one row, or one per ``by``.

    Rows are first reduced to distinct scores; positives then meet the running
    number of negatives below them, slice by slice.  Null without both classes.
    """
    by = list(by)
    kept = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    scores = settle(kept.groupBy(*by, F.col(score).cast("double").alias("__score")).agg(
        F.count_if(F.col(label) == 1).alias("__pos"),
        F.count_if(F.col(label) != 1).alias("__neg")), "scores")
    run = over_ordered(scores, by, ["__score"], before={"__below": "__neg"}, slices=slices)
    won = F.sum(F.col("__pos") * (F.col("__below") + F.col("__neg") / F.lit(2.0)))
    pairs = F.sum("__pos").cast("double") * F.sum("__neg")
    return run.groupBy(*by).agg((won / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def balanced_weight(df: DataFrame, label: str = "target", out: str = "weight") -> DataFrame:
    """Add n / (2 * rows of the row's class); null labels get no weight."""
    classes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    total = classes.agg(F.sum("__n")).scalar()
    return df.join(
        classes.select(label, (total / (F.col("__n") * 2)).alias(out)), label, "left"
    ).select(*df.columns, out)


# fixed values: most boosting rounds, and rounds without a better held-out AUC that end a fit
ROUNDS, PATIENCE = 2600, 200
FIT_ROWS = 10_000  # fewest training rows of a partition; small tables would spend each round on scheduling
FIT_CELLS = 1 << 24  # most binned numbers of a partition, which lies in memory while trees grow
ROW_CELLS = 32  # what a row takes beside its binned numbers, in such numbers


def gbt(
    seed: int, *, rounds: int = ROUNDS, step: float = 0.01, depth: int = 10, leaf_rows: int = 50,
    bins: int = 64, row_fraction: float = 0.75, column_fraction: float = 0.66,
) -> GBTClassifier:
    """Boosted trees for crossfit(), which stops before ``rounds`` when held-out rows say so.

    (Spark's own early stop ends a fit whose rounds improve by less than 1 %, which at this step
    is the second round.  Rows are drawn anew for every tree; Spark has no longer interval.)
    """
    return GBTClassifier(
        featuresCol="features", labelCol="target", weightCol="weight", seed=seed,
        maxIter=rounds, stepSize=step, maxDepth=depth, minInstancesPerNode=leaf_rows,
        maxBins=bins, subsamplingRate=row_fraction, featureSubsetStrategy=str(column_fraction))


def _class_weight(counts: Mapping[float, int]) -> Column:
    """n / (2 * rows of the class) as a constant per class."""
    total, weight = sum(counts.values()), F.lit(None).cast("double")
    for target, n in counts.items():
        weight = F.when(F.col("target") == target, total / (2.0 * n)).otherwise(weight)
    return weight


def round_aucs(
    model: GBTClassificationModel, held: DataFrame, after: int = 0, slices: int | None = None
) -> list[float | None]:
    """Exact AUC on ``held`` (features, target) of the model's first r trees, for r > ``after``.

    A row's leaves are looked up in the stored trees and their values summed in the order of the
    rounds, inside the row, so all rounds take one pass and only (round, score, target) travel.
    One number per leaf comes to the driver and goes to the tasks, and one per round comes back.
    """
    spark = held.sparkSession
    path = scratch_path(spark, "trees")
    model.write().save(path)
    leaves = spark.read.parquet(f"{path}/data").where("nodeData.leftChild < 0").select(
        "treeID", F.col("nodeData.id").alias("node"), F.col("nodeData.prediction").alias("value"))
    # leaves are numbered from 0 in the order of their nodes
    table = leaves.toPandas().sort_values(["treeID", "node"], ignore_index=True)
    weights = model.treeWeights
    first = np.searchsorted(table["treeID"].to_numpy(), np.arange(len(weights)))
    sent = spark.sparkContext.broadcast(
        (first, np.asarray(weights)[table["treeID"]] * table["value"].to_numpy()))

    @F.pandas_udf("array<double>")
    def running(found: pd.Series) -> pd.Series:
        first, values = sent.value
        if not len(found):
            return pd.Series([], dtype=object)
        at = np.stack(found.to_numpy()).astype(np.int64) + first
        return pd.Series(list(np.cumsum(values[at], axis=1)[:, after:]))

    model.setLeafCol("__leaves")
    sums = model.transform(held).select("target", running(vector_to_array("__leaves")).alias("sums"))
    model.setLeafCol("")
    margins = sums.select("target", F.posexplode("sums").alias("at", "p")).withColumn(
        "round", F.col("at") + after)
    found = auc(margins, by=["round"], slices=slices)
    by_round = {r["round"]: r["auc"] for r in found.collect()}
    sent.destroy()
    return [by_round.get(r) for r in range(after, len(weights))]


def best_round(aucs: Sequence[float | None], patience: int) -> tuple[int, bool]:
    """(rounds to keep, whether to stop): the first round of the best AUC, and whether ``patience``
    rounds have passed since.  Rounds after that point do not count.  Without any AUC (held-out
    rows of one class) all rounds are kept."""
    best, top = 0, None
    for i, value in enumerate(aucs):
        if value is not None and (top is None or value > top):
            best, top = i, value
        elif top is not None and i - best >= patience:
            return best + 1, True
    return (len(aucs) if top is None else best + 1), False


def first_rounds(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` trees."""
    gateway = SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    every = model._java_obj.trees()
    for i, weight in enumerate(model.treeWeights[:n]):
        trees[i], weights[i] = every[i], weight
    cut = GBTClassificationModel(ml.classification.GBTClassificationModel(model.uid, trees, weights))
    return cut.setFeaturesCol(model.getFeaturesCol())


def fit_patiently(
    estimator: GBTClassifier, train: DataFrame, held: DataFrame, patience: int = PATIENCE
) -> tuple[GBTClassificationModel, list[float | None]]:
    """(the model up to its best round, AUC on ``held`` of every round that was fitted).

    The fit grows: it has as many rounds as it takes to run out of patience, then twice as many,
    up to the estimator's.  One seed gives the same first trees whatever follows, so the choice
    is that of a fit of all rounds; trees after the best round are dropped, not fitted again.
    """
    total, n, aucs = estimator.getMaxIter(), 0, []
    while True:
        n = min(total, max(patience + 1 + patience // 20, 2 * n))
        model = estimator.copy({estimator.maxIter: n}).fit(train)
        aucs += round_aucs(model, held, len(aucs))
        best, stop = best_round(aucs, patience)
        if stop or n == total:
            return first_rounds(model, best), aucs


def fit_parts(rows: int, width: int, cores: int, fits: int) -> int:
    """Partitions for ``rows`` training rows of ``width`` features, with ``fits`` side by side.

    A tree's levels are jobs that wait for each other, so a fit gets its share of the cores and no
    more; one with fewer than ``FIT_ROWS`` a partition gets less, and one whose rows would not lie
    in memory (``FIT_CELLS``) more.
    """
    share = min(max(1, cores // fits), -(-rows // FIT_ROWS))
    return max(share, -(-rows * (width + ROW_CELLS) // FIT_CELLS))


def crossfit(
    df: DataFrame, estimator: Callable[[int], Estimator], *, n_folds: int = 10, n_bags: int = 1,
    seed: int = 1, label: str = "target", fold: str = "fold", entity: str = "entity",
    patience: int | None = PATIENCE, parallel: int = 12,
) -> DataFrame:
    """(entity, fold, bag, target, p): each model scores its held-out fold and the unlabelled rows.

    ``df`` has ``features`` and a label of at most two values; ``estimator(seed)`` builds an
    untrained model that may read ``weight`` (class balance).  Held-out rows carry their target,
    unlabelled rows a null.  Folds without rows are skipped.

    Boosted models stop by ``patience`` (None: all rounds).  Up to ``parallel`` fits are under way
    at the same time, each a thread of the driver that only starts distributed jobs; the scores of
    a fit are stored when it is ready.  The driver holds the trees of the fits under way.
    """
    cut_lineage(df.sparkSession)
    used = settle(df.select(F.col(entity).alias("entity"), F.col(label).cast("double").alias(
        "target"), F.col(fold).alias("fold"), "features"), "training")
    labelled = used.where(F.col("fold").isNotNull())
    values = [r[0] for r in labelled.select("target").distinct().limit(4).collect()]
    if len([v for v in values if v is not None]) > 2:
        raise ValueError("the label has more than two values")
    sizes = labelled.groupBy("fold", "target").count().collect()  # a row per fold and class

    def fit(f: int, bag: int, classes: dict[float, int]) -> DataFrame:
        train, held = fold_split(used, f)
        train = train.withColumn("weight", _class_weight(classes))
        train = train.coalesce(fit_parts(sum(classes.values()), width, cores, min(parallel, len(jobs))))
        model = estimator(seed + f * n_bags + bag)
        if patience is not None and isinstance(model, GBTClassifier):
            fitted, _ = fit_patiently(model, train, held, patience)
        else:
            fitted = model.fit(train)
        rows = used.where((F.col("fold") == f) | F.col("fold").isNull())
        return settle(fitted.transform(rows).select(
            "entity", F.lit(f).alias("fold"), F.lit(bag).alias("bag"), "target",
            vector_to_array("probability")[1].alias("p")), "scores")

    jobs = []
    for f in range(n_folds):
        classes: dict[float, int] = {}
        for r in sizes:
            if r["fold"] != f:
                classes[r["target"]] = classes.get(r["target"], 0) + r["count"]
        if classes and any(r["fold"] == f for r in sizes):
            jobs += [(f, bag, classes) for bag in range(n_bags)]
    if not jobs:
        raise ValueError("no fold has both training and held-out rows")
    widest = labelled.where(F.col("features").isNotNull()).select("features").first()
    width, cores = widest[0].size if widest else 0, used.sparkSession.sparkContext.defaultParallelism
    with ThreadPoolExecutor(parallel) as pool:
        run = inheritable_thread_target(used.sparkSession)(fit)
        return stack(list(pool.map(lambda job: run(*job), jobs)))


def fold_auc(scores: DataFrame, slices: int | None = None) -> DataFrame:
    """AUC of every (fold, bag) on its held-out rows."""
    return auc(scores.where(F.col("target").isNotNull()), by=("fold", "bag"), slices=slices)


def average_predictions(scores: DataFrame, entity: str = "entity", p: str = "p") -> DataFrame:
    return scores.groupBy(entity).agg(F.avg(p).alias("p"))


def finalise(scores: DataFrame, rescale: bool = True) -> DataFrame:
    """Mean over folds and bags; ``rescale`` stretches it to [0, 1] (tree models only)."""
    mean = average_predictions(scores)
    return minmax(mean, "p") if rescale else mean


def blend(preds: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Weighted sum of (model, entity, p); an entity that lacks a model drops out."""
    table = preds.sparkSession.createDataFrame(list(weights.items()), "model string, w double")
    weighted = preds.where(F.col("p").isNotNull()).join(F.broadcast(table), "model")
    return (
        weighted.groupBy("entity")
        .agg(F.sum(F.col("w") * F.col("p")).alias("p"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == len(weights)).select("entity", "p")
    )
