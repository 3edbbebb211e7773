"""The driver tables in the roles of log, entities, tokens and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logfeat.functions import micros, sentinel_to_null
from logfeat.operators.keys import attach, exclude, stratified_folds
from logfeat.session import settle

LINE_TIE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # times are naive UTC
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def event_log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("entity"),
        F.get_json_object("props", "$.k").alias("actor"),
        F.col("event_type").alias("product"),
        micros("ts").alias("us"),
        F.col("event_id").alias("rid"),
    )


def lines_of_log(spark: SparkSession, d: str) -> DataFrame:
    """The log as CSV lines; of every fifty, one has no number for a time and one lacks values."""
    at = F.expr("CAST(us div 1000000 AS STRING)")
    return event_log(spark, d).select(F.when(F.col("rid") % 50 == 1, F.col("entity")).otherwise(
        F.concat_ws(",", "entity", F.coalesce("actor", F.lit("")),
                    F.when(F.col("rid") % 50 == 0, "soon").otherwise(at), "product")).alias("line"))


def event_targets(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("user_id")
    target = F.when(u % 10 != 9, (u % 3 == 0).cast("double"))
    return table(spark, d, "events").select("user_id").distinct().select(
        u.cast("string").alias("entity"), target.alias("target"))


def event_entities(spark: SparkSession, d: str, slices: int | None = None) -> DataFrame:
    return stratified_folds(event_targets(spark, d), 10, slices=slices)


def folded_events(spark: SparkSession, d: str) -> DataFrame:
    return attach(event_log(spark, d), event_entities(spark, d))


def prepared_events(spark: SparkSession, d: str) -> DataFrame:
    """The folded log as a stored table, as the prepare plan leaves it."""
    return settle(folded_events(spark, d), "log")


def line_log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("entity"),
        F.col("l_suppkey").cast("string").alias("actor"),
        F.col("l_returnflag").alias("product"),
        micros("l_shipdate").alias("us"),
        *LINE_TIE,
    )


def line_entities(spark: SparkSession, d: str) -> DataFrame:
    status = F.col("o_orderstatus")
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("entity"),
        F.when(status != "P", (status == "F").cast("double")).alias("target"))
    return stratified_folds(rows, 10)


def folded_lines(spark: SparkSession, d: str) -> DataFrame:
    return attach(line_log(spark, d), line_entities(spark, d))


def document_labels(spark: SparkSession, d: str) -> DataFrame:
    """(entity, target) with 0.5 for unknown, as the raw label files have it."""
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return attach(table(spark, d, "documents").select("doc_id"), labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("entity"),
        F.coalesce(F.col("quality").cast("double"), F.lit(0.5)).alias("target"))


def toxic(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").where(F.col("toxic") == 1).select(
        F.col("doc_id").cast("string").alias("entity"))


def clean_labels(spark: SparkSession, d: str) -> DataFrame:
    return exclude(document_labels(spark, d), toxic(spark, d)).withColumn(
        "target", sentinel_to_null("target"))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


def word_tokens(spark: SparkSession, d: str) -> DataFrame:
    """(entity, at, token): every word of every document."""
    words = documents(spark, d).select(
        F.col("doc_id").cast("string").alias("entity"),
        F.posexplode(F.split("text", " ")).alias("at", "token"))
    return words.withColumn("at", F.col("at").cast("long"))


def scored_documents(spark: SparkSession, d: str) -> DataFrame:
    """(entity, target, p): labelled documents with a coarse score that has ties."""
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double"))
    return table(spark, d, "documents").join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("entity"),
        F.col("quality").alias("target"),
        ((F.col("n_chars") % 97) / F.lit(97.0)).alias("p"))


MODELS = ("lgbm4", "lgbm3", "lgbm2", "rnn1", "rnn2", "nn1", "nn2")


def model_predictions(spark: SparkSession, d: str) -> DataFrame:
    """(model, entity, p) of seven models; the last knows only labelled documents."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    known = table(spark, d, "labels").select("doc_id", F.lit(True).alias("known"))
    rows = attach(docs, known, "doc_id").select(
        F.explode(F.array(*[
            F.struct(F.lit(m).alias("model"),
                     ((F.col("n_chars") * (i + 3)) % 101 / F.lit(101.0)).alias("p"))
            for i, m in enumerate(MODELS)
        ])).alias("m"),
        F.col("doc_id").cast("string").alias("entity"), "known")
    return rows.where((F.col("m.model") != MODELS[-1]) | F.col("known")).select(
        "m.model", "entity", "m.p")


DIMS = [f"e{i}" for i in range(64)]


def embedding_columns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").selectExpr(
        "CAST(vec_id AS STRING) AS entity", "label",
        *[f"CAST(embedding[{i}] AS DOUBLE) AS {c}" for i, c in enumerate(DIMS)])


STEPS = ("f5", "f8", "f10", "f20", "other")


def folded_vectors(spark: SparkSession, d: str) -> DataFrame:
    """(entity, target, fold, five numbers): the sign of a vector's first component; the component
    in steps of several sizes, and another one, all moved above zero.  A tenth has no label."""
    positive = (F.col("e0") >= 0).cast("double")
    rows = embedding_columns(spark, d).select(
        "entity", F.when(F.col("entity").cast("long") % 10 != 9, positive).alias("target"),
        *[(F.floor(F.col("e0") * n) + 100).alias(f"f{n}") for n in (5, 8, 10, 20)],
        (F.floor(F.col("e1") * 10) + 100).alias("other"))
    return stratified_folds(rows, 10)
