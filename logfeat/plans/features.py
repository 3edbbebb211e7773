"""Prepared log and entities to the feature table and the feature matrix."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_parts
from ..functions.columns import DATE_PARTS
from ..operators.factors import factor_matrix
from ..operators.gaps import all_gaps
from ..operators.keys import attach, attach_by_fold, code_table
from ..operators.matrix import (
    Matrix, hashed_ngrams, hstack, interactions, min_doc_freq, reindex, to_coo)
from ..operators.rollup import (
    GROUP_ROWS, STATS, age_points, char_totals, rollup_stats, with_ages)
from ..operators.scaling import scale_columns
from ..operators.sequences import char_counts
from ..operators.target_stats import target_stats
from ..session import settle

TARGET_COLS = [f"{k}_{s}" for k in ("actor", "product") for s in ("mean", "std", "sum")]
GAP_COLS = ["gap", "gap_entity", "gap_actor", "gap_product"]

# fixed values: document-frequency limits and factor ranks of the matrix blocks
LIMITS = {"user": 1, "actor": 1, "product": 10, "gap": 1, "gap_entity": 5, "gap_actor": 5,
          "gap_product": 1}
RANKS = {"user": 350, "product": 100, "gap_entity": 300, "gap_actor": 50, "gap_product": 50}


def target_rollup(log: DataFrame, **options) -> DataFrame:
    """54 columns per entity: nine statistics of the six target statistics, -1 for none."""
    stats = {k: target_stats(log, k) for k in ("actor", "product")}
    rows = log
    for key, table in stats.items():
        rows = attach_by_fold(rows, table, key)
    return rollup_stats(rows, "entity", TARGET_COLS, fill=-1.0, source=log, **options)


def feature_table(
    log: DataFrame, entities: DataFrame, *, group_rows: int = GROUP_ROWS,
    slices: int | None = None, gaps: DataFrame | None = None,
) -> DataFrame:
    """183 numeric columns per entity, from one wide aggregation of the enriched log.

    ``gaps`` is the log with all_gaps(), where it is stored already.  Entities without log rows keep nulls (scale_columns() fills them).
    """
    stats = {k: target_stats(log, k) for k in ("actor", "product")}
    rows = all_gaps(log, slices=slices) if gaps is None else gaps
    for key, table in stats.items():
        rows = attach_by_fold(rows, table, key)
    rows = settle(rows.fillna(-1.0, subset=GAP_COLS).select(
        "*", *date_parts(F.timestamp_micros("us"))), "enriched")
    latest = log.agg(F.max("us")).first()[0]
    cols = [*TARGET_COLS, *DATE_PARTS, *GAP_COLS]
    per_entity = rollup_stats(
        rows, "entity", cols, source=log, group_rows=group_rows, slices=slices,
        extra=[F.count(F.lit(1)).alias("n_rows"), *char_totals(), *age_points()])
    filled = [f"{c}_{s}" for c in TARGET_COLS for s in STATS]
    per_entity = with_ages(per_entity.fillna(-1.0, subset=filled), latest)
    # distinct counts go through (entity, value) pairs and stay out of the wide aggregation
    distinct = log.where(F.col("entity").isNotNull()).groupBy("entity").agg(
        F.count_distinct("actor").alias("n_actors"),
        F.count_distinct("product").alias("n_products"))
    table = attach(attach(entities, per_entity), distinct)
    return table.select("*", *char_counts("entity"))


def feature_columns(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c not in ("entity", "target", "fold")]


def user_matrix(log: DataFrame, rank: int, **options) -> Matrix:
    """Latent factors of the entity x actor matrix."""
    return factor_matrix(min_doc_freq(interactions(log), LIMITS["user"]), rank, **options)


def token_matrices(
    log: DataFrame, product_rank: int, *, slices: int | None = None, buckets: int = 2**29,
    hashing: str = "xxhash64", **options
) -> tuple[Matrix, Matrix]:
    """(hashed actor sequences, latent factors of hashed product sequences)"""
    actor = hashed_ngrams(log, "actor", buckets=buckets, hashing=hashing, slices=slices)
    product = hashed_ngrams(log, "product", weights=(1.0, 1.0), tf="count", hashing=hashing,
                            slices=slices)
    return (
        reindex(min_doc_freq(actor, LIMITS["actor"]), slices),
        factor_matrix(min_doc_freq(product, LIMITS["product"]), product_rank, slices=slices,
                      **options),
    )


def gap_matrix(
    gaps: DataFrame, ranks: Mapping[str, int], *, slices: int | None = None,
    buckets: int = 2**28, hashing: str = "xxhash64", **options
) -> Matrix:
    """Hashed sequences of the four gaps; the last three as latent factors."""
    blocks = []
    for c in GAP_COLS:
        coo = min_doc_freq(hashed_ngrams(
            gaps, c, hashing=hashing, slices=slices,
            buckets=buckets if c == "gap" else 2**28), LIMITS[c])
        blocks.append(reindex(coo, slices) if c == "gap" else factor_matrix(
            coo, ranks[c], slices=slices, **options))
    return hstack(blocks)


def feature_matrix(
    log: DataFrame, entities: DataFrame, *, ranks: Mapping[str, int] = RANKS,
    slices: int | None = None, group_rows: int = GROUP_ROWS, actor_buckets: int = 2**29,
    gap_buckets: int = 2**28, hashing: str = "xxhash64", **options,
) -> Matrix:
    """All blocks side by side: table, user, actor, product, gaps.

    The actor and gap blocks go to the model as they are, up to one column per bucket.  A tree
    model keeps split candidates of every column on the driver: give it fewer buckets (2**16,
    say), which merges tokens and drops none.
    """
    gaps = settle(all_gaps(log, slices=slices), "gaps")
    table = feature_table(log, entities, group_rows=group_rows, slices=slices, gaps=gaps)
    cols = feature_columns(table)
    scaled = scale_columns(table, cols, store=True)
    options["row_codes"] = settle(code_table(entities, "entity", slices), "rows")
    actor, product = token_matrices(log, ranks["product"], slices=slices, buckets=actor_buckets,
                                    hashing=hashing, **options)
    return hstack([
        to_coo(scaled, cols),
        user_matrix(log, ranks["user"], slices=slices, **options),
        actor,
        product,
        gap_matrix(gaps, ranks, slices=slices, buckets=gap_buckets, hashing=hashing, **options),
    ])
