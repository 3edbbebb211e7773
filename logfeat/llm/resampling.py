"""Drawing documents by how much they look like a target text, with added random keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import over_ordered
from ..session import settle
from .common import let, whole

BUCKETS, SHARE, LEAST_WORDS, SEED = 10_000, 25, 20, 7
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after A-Z are lower-cased
WAYS = 16  # thresholds counted by one job, so that it does the work of four halvings
AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column | str) -> Column:
    """The runs of digits, a-z and characters beyond ASCII, A-Z lower-cased."""
    low = F.translate(whole(text), AZ, AZ.lower())
    return F.filter(F.split(low, NOT_WORD), lambda w: w != "")


def feature_buckets(text: Column | str, buckets: int = BUCKETS) -> Column:
    """(words, buckets of all single words and pairs of neighbours, as one array)."""
    def place(s: Column) -> Column:
        return (F.crc32(s.cast("binary")) % buckets).cast("int")

    def of(w: Column) -> Column:
        pairs = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)),
                           lambda a, b: place(F.concat(a, F.lit(" "), b)))
        return F.struct(F.size(w).alias("n_words"), F.concat(F.transform(w, place), pairs).alias("b"))

    return let(words(text), of)


def bucket_counts(features: DataFrame) -> dict[int, int]:
    """Features per bucket; at most one row per bucket comes to the driver."""
    found = features.select(F.explode("f.b").alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"))
    return {r["bucket"]: r["n"] for r in found.collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Per bucket, 1000 times the log of its share in the target over that in the source."""
    n, m = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return [math.floor(1000 * math.log((target.get(b, 0) + 1) * n / ((source.get(b, 0) + 1) * m)))
            for b in range(buckets)]


def scored(
    docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text: str = "text",
    target_text: str = "text", buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, row): stored, with a number for each row.

    All features of ``docs`` and of ``target`` are counted; a document's weight is the floored
    mean of its features' gains, which travel as one array of ``buckets`` numbers.  The score adds
    a Gumbel key of ``seed`` and the id, so drawing the highest scores is drawing by weight.
    """
    features = docs.select(F.col(id_col).alias("doc_id"), feature_buckets(text, buckets).alias("f"))
    aims = target.select(feature_buckets(target_text, buckets).alias("f"))
    table = gains(bucket_counts(features), bucket_counts(aims), buckets)
    gain = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    n = F.size("f.b").cast("long")
    total = F.aggregate("f.b", F.lit(0).cast("long"), lambda a, b: a + F.get(gain, b))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    key = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    rows = features.select("doc_id", F.col("f.n_words").alias("n_words"), n.alias("n_features"),
                           total.alias("total"), key.alias("key"))
    weight = F.when(F.col("n_features") > 0, F.expr(
        "(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0)).cast("long")
    rows = rows.select("doc_id", "n_words", "n_features", weight.alias("weight"), "key")
    return settle(rows.select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + F.col("key")).alias("score"),
        F.monotonically_increasing_id().alias("row")), "scores")


# -- the cutoff

def smallest(stored: DataFrame, column: str, k: int) -> tuple[int, int]:
    """(cut, below): the ``k``-th smallest value of an integer column, and how many are below it.

    Each job counts the rows at or below a few thresholds between the bounds, exactly; the bounds
    close in until they meet.  ``k`` is from 1 to the number of rows; nulls must be gone.
    """
    first = stored.agg(F.min(column), F.max(column)).first()
    low, high, below = first[0], first[1], 0  # the cut lies in [low, high]
    while low < high:
        steps = sorted({low + (high - low) * i // WAYS for i in range(WAYS)})
        counts = stored.agg(*[F.count_if(F.col(column) <= t) for t in steps]).first()
        for t, n in zip(steps, counts):
            if n >= k:
                high = t
                break
            low, below = t + 1, n
    return low, below


def draw_highest(stored: DataFrame, k: int) -> Column:
    """Whether a row is among the ``k`` highest scores, ties to the smaller id (null last), then to
    the smaller row number; ``stored`` has integer ``score``, ``doc_id`` and ``row``."""
    if k <= 0:
        return F.lit(False)
    score, before = smallest(stored.select((-F.col("score")).alias("s")), "s", k)
    drawn, at_cut = -F.col("score") < score, -F.col("score") == score
    tied, k = stored.where(at_cut), k - before
    known = tied.where("doc_id IS NOT NULL").count()
    if k > known:  # all with an id, and some without
        drawn |= at_cut & F.col("doc_id").isNotNull()
        at_cut &= F.col("doc_id").isNull()
        k -= known
    else:
        cut, before = smallest(tied.where("doc_id IS NOT NULL"), "doc_id", k)
        drawn |= at_cut & (F.col("doc_id") < cut)
        at_cut &= F.col("doc_id") == cut
        k -= before
    if stored.where(at_cut).limit(k + 1).count() > k:  # rows that repeat an id and its score
        cut, _ = smallest(stored.where(at_cut), "row", k)
        at_cut &= F.col("row") <= cut
    return F.coalesce(drawn | at_cut, F.lit(False))


def resample(
    docs: DataFrame, target: DataFrame, *, share: int = SHARE, least_words: int = LEAST_WORDS,
    **options,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs``; undrawn ranks are null.

    Of the documents with at least ``least_words`` words, ``share`` percent are drawn: those of
    the highest scored().  The cutoff comes from counting jobs over the stored scores; only drawn
    rows are range-partitioned, for their ranks.

    Null and empty texts have no features and weight 0.  Ids are integers; a null id counts as
    empty in its key and comes last among ties, and rows that repeat an id and text keep the order
    they were read in.  An empty target leaves flat counts of its side; no rows give no rows.
    """
    rows = scored(docs, target, **options)
    enough = rows.where(F.col("n_words") >= least_words)
    k = share * enough.count() // 100
    drawn = draw_highest(enough, k) & (F.col("n_words") >= least_words)
    keys = {"_best": -F.col("score"), "_unnamed": F.col("doc_id").isNull()}
    ranked = over_ordered(rows.where(drawn).withColumns(keys), [], ["_best", "_unnamed", "doc_id", "row"],
                          index="rank", rows=k)
    out = ranked.withColumn("rank", F.col("rank") + 1).unionByName(
        rows.where(~drawn).withColumn("rank", F.lit(None).cast("long")), allowMissingColumns=True)
    return out.select("doc_id", "n_features", "weight", "score", "rank")
