"""Feature matrix to predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import attach
from ..operators.matrix import Matrix, to_vectors
from ..operators.scoring import crossfit, finalise, fold_auc, gbt

# fixed values: weights of the published blend
BLEND_WEIGHTS = {"lgbm4": 0.5, "lgbm3": 0.22, "lgbm2": 0.08, "rnn1": 0.01, "rnn2": 0.05,
                 "nn1": 0.02, "nn2": 0.12}


def score(
    matrix: Matrix, entities: DataFrame, estimator: Callable[[int], Estimator] = gbt, *,
    n_folds: int = 10, n_bags: int = 1, seed: int = 1, rescale: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(predictions of the entities without a fold, AUC per fold and bag)"""
    rows = attach(entities.select("entity", "target", "fold"), to_vectors(matrix))
    rows = rows.where(F.col("features").isNotNull())
    scores = crossfit(rows, estimator, n_folds=n_folds, n_bags=n_bags, seed=seed)
    unlabelled = scores.where(F.col("target").isNull())
    return finalise(unlabelled, rescale), fold_auc(scores)
