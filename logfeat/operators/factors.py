"""Latent factors of implicit feedback."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, settle
from .keys import code_table, label_codes
from .matrix import Matrix, array_to_coo


def both_factors(
    coo: DataFrame, rank: int, *, seed: int = 1, iterations: int = 10, reg: float = 0.1,
    alpha: float = 1.0, blocks: int | None = None, row_codes: DataFrame | None = None,
    slices: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(entity, factors) and (feature, factors): vectors of ``rank`` floats for every entity and
    every feature that has a cell.

    The product of two vectors is near 1 where the entity has the feature and near 0 elsewhere.
    Factors are only defined up to rotation: compare rankings, not coordinates.
    ``blocks`` divides both sides of the matrix; it defaults to the cluster's
    cores.  Vectors are solved in as many numbers as the matrix has rows or columns, where that is
    less than ``rank``, and stretched().  Row and column codes are 32-bit integers; ``row_codes``, a code_table()
    of all entities, saves numbering them again for every matrix.
    """
    context = coo.sparkSession.sparkContext
    cut_lineage(coo.sparkSession)
    if row_codes is None:
        row_codes = code_table(coo, "entity", slices)
    coded = coo.join(row_codes.withColumnRenamed("code", "row"), "entity")
    coded = label_codes(coded, "feature", "col", slices)
    coded = settle(coded.select("entity", "feature", F.col("row").cast("int"),
                                F.col("col").cast("int"), F.col("value").cast("float")), "ratings")
    blocks = blocks or context.defaultParallelism
    # a matrix of m rows or columns has no more than m independent directions: all products that
    # longer vectors can have, m numbers have too, at the same lengths
    sides = coded.select(F.max("row"), F.max("col")).first()
    solved = rank if sides[0] is None else min(rank, min(sides) + 1)
    als = ALS(
        rank=solved, implicitPrefs=True, maxIter=iterations, regParam=reg, alpha=alpha, seed=seed,
        numUserBlocks=blocks, numItemBlocks=blocks,
        userCol="row", itemCol="col", ratingCol="value")
    model = als.fit(coded)

    def named(name: str, code: str, factors: DataFrame) -> DataFrame:
        rows = coded.select(name, F.col(code).alias("id")).distinct().join(factors, "id")
        return settle(rows.select(name, stretched("features", solved, rank).alias("factors")), "factors")

    return named("entity", "row", model.userFactors), named("feature", "col", model.itemFactors)


def stretched(vector: str, n: int, rank: int) -> Column:
    """The vector of ``n`` floats with ``rank`` ones: number i is shared by the places i, i + n, ...
    so that products and lengths of vectors stay the same."""
    if n == rank:
        return F.col(vector)
    share = f"sqrt(1D + ({rank} - 1 - j % {n}) div {n})"
    return F.expr(f"transform(sequence(0, {rank} - 1), j -> CAST({vector}[j % {n}] / {share} AS FLOAT))")


def latent_factors(coo: DataFrame, rank: int, **options) -> DataFrame:
    """(entity, factors): the entities' side of both_factors()."""
    return both_factors(coo, rank, **options)[0]


def known_and_all(coo: DataFrame, entities: DataFrame, features: DataFrame) -> DataFrame:
    """(entity, cells, known, overall): how well factors tell an entity's features from others.

    ``known`` is the mean product of the entity's vector with those of the features it has, and
    ``overall`` that with all features' vectors; only the latter's mean travels, so no pair of an
    entity and a feature without a cell is ever made.
    """
    mean = features.select(F.posexplode("factors").alias("at", "v")).groupBy("at").agg(
        F.avg(F.col("v").cast("double")).alias("v")).agg(
        F.sort_array(F.collect_list(F.struct("at", "v"))).alias("m")).select("m.v")

    def product(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0),
                           lambda s, x: s + x)

    # entities first: a cell is shuffled before it has a vector, and the fewer features may travel
    each = coo.select("entity", "feature").join(entities, "entity").join(
        features.withColumnRenamed("factors", "_of"), "feature").select(
        "entity", product(F.col("factors"), F.col("_of")).alias("p"))
    known = each.groupBy("entity").agg(F.count(F.lit(1)).alias("cells"), F.avg("p").alias("known"))
    rows = known.join(entities, "entity").withColumn("_mean", mean.scalar())
    return rows.select(
        "entity", "cells", "known", product(F.col("factors"), F.col("_mean")).alias("overall"))


def factor_matrix(coo: DataFrame, rank: int, **options) -> Matrix:
    """latent_factors() as a block for hstack(); entities without a cell stay all zero."""
    return array_to_coo(latent_factors(coo, rank, **options), "factors", rank)
