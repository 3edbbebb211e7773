"""Quality scores from document statistics: random Fourier features, ridge, isotonic steps."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import crc_mod, whole

N_FEATURES, WIDTH, RIDGE, SEED, STEPS = 256, 5.0, 1.0, 7, 2000
SYMBOLS = b"#*$%&|<>"
NAMES = ("log_words", "log_bytes", "word_bytes", "distinct", "top_word", "repeats", "pairs",
         "upper", "digits", "symbols", "bars", "marks", "stops", "wide", "white", "lines",
         "distinct_lines", "short_words", "long_words", "symbol_words")
_UPPER = bytes(range(65, 91))
_ASCII = bytes(range(128))


def statistics(text: str) -> list[float]:
    """The numbers of ``NAMES`` for a whole text; all shares are 0 if there is nothing to share."""
    raw = text.encode("utf-8", "replace")
    words = raw.lower().split()
    n, size = len(words), max(len(raw), 1)

    def share(of: bytes) -> float:
        return (len(raw) - len(raw.translate(None, of))) / size

    w = max(n, 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = list(map(len, words))
    bare = len(raw.translate(None, _UPPER))
    return [
        math.log1p(n), math.log1p(len(raw)), sum(lengths) / w, len(set(words)) / w,
        max(Counter(words).values(), default=0) / w, sum(map(eq, words, words[1:])) / w,
        len(set(zip(words, words[1:]))) / w, (len(raw) - bare) / size, share(b"0123456789"),
        share(SYMBOLS), raw.count(b"|") / w, raw.count(b"!") / w,
        (raw.count(b".") + raw.count(b",")) / w, len(raw.translate(None, _ASCII)) / size,
        share(b" \t\n\r\x0b\x0c"), math.log1p(len(lines)), len(set(lines)) / max(len(lines), 1),
        sum(x < 3 for x in lengths) / w, sum(x > 12 for x in lengths) / w,
        share(SYMBOLS) * size / w]


def with_statistics(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "stats": [statistics(t) for t in pdf["text"]]})

    return docs.select(F.col(id_col).alias("doc_id"), whole(text).alias("text")).mapInPandas(
        batches, f"doc_id {kind}, stats array<double>")


class Features:
    """cos(Wx + b) of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(size=(len(mean), N_FEATURES)) / WIDTH
        self.b = rng.uniform(0, 2 * np.pi, N_FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.w + self.b) * np.sqrt(2 / N_FEATURES)
        return np.hstack([z, np.ones((len(x), 1))])


def _stack(lists: pd.Series) -> np.ndarray:
    return np.array(lists.tolist(), float).reshape(len(lists), len(NAMES))


def normal_equations(rows: DataFrame, features: Features) -> dict[int, np.ndarray]:
    """Per fold the matrix [Z'Z | Z'y] of (stats, y, fold): summed per partition, then by row."""
    size = N_FEATURES + 1

    def sums(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in it:
            for fold, part in pdf.groupby("fold"):
                z = features(_stack(part["stats"]))
                both = np.hstack([z, part["y"].to_numpy(float)[:, None]])
                total[fold] = total.get(fold, 0) + z.T @ both
        for fold, m in total.items():
            yield pd.DataFrame({"fold": fold, "i": range(size), "v": list(m)})

    parts = rows.mapInPandas(sums, "fold int, i int, v array<double>")
    summed = parts.groupBy("fold", "i").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
    out = {f: np.zeros((size, size + 1)) for f in (0, 1)}
    for r in summed.select("fold", "i", vector_to_array("v").alias("v")).collect():
        out[r["fold"]][r["i"]] = r["v"]
    return out


def solve(equations: np.ndarray) -> np.ndarray:
    size = len(equations)
    penalty = RIDGE * np.eye(size)
    penalty[-1, -1] = 1e-6  # the constant is free
    return np.linalg.solve(equations[:, :size] + penalty, equations[:, size])


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and values of the blocks of the non-decreasing fit to weighted means ``y``."""
    blocks: list[list[float]] = []
    for xi, yi, wi in sorted(zip(x, y, w)):
        blocks.append([wi, wi * yi, wi * xi])
        while len(blocks) > 1 and (blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]):
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks or [[1.0, 0.5, 0.0]])
    return b[:, 2] / b[:, 0], b[:, 1] / b[:, 0]


def score_quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text",
    label: str = "quality", folds: int = 5, threshold: float = 0.3,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    The statistics of whole texts go through ``N_FEATURES`` random Fourier features of a Gaussian
    kernel (width ``WIDTH`` standard deviations).  Each partition sums its normal equations, and
    only those sums meet.  All labelled rows outside the held-out fold (crc32 of the id mod
    ``folds`` = 0) are used, in two halves: each half's scores by the other half's fit, counted
    on a grid of ``STEPS`` steps, give the isotonic calibration of the fit to both.  A small part
    of the raw score is kept in, so that documents of one step stay ordered.

    A null text counts as empty; rows with a null id have no label; repeated labels of an id
    count by their mean, null labels not at all.  Without labels every score is 0.5.
    """
    rows = settle(with_statistics(docs, id_col, text).withColumn(
        "held_out", crc_mod("doc_id", folds) == 0), "statistics")
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        F.avg(label).alias("y"))
    half = (F.crc32(F.concat(F.lit("half"), F.col("doc_id").cast("string")).cast("binary")) % 2)
    train = settle(rows.where("NOT held_out").join(known, F.col("doc_id") == F.col("_id")).select(
        "stats", "y", half.cast("int").alias("fold")), "train")
    vector = array_to_vector("stats")
    kind = docs.schema[id_col].dataType.simpleString()
    if train.isEmpty():
        return rows.select("doc_id", "held_out", F.lit(0.5).alias("score"),
                           F.lit(int(0.5 >= threshold)).alias("predicted"))
    stats = train.agg(Summarizer.metrics("mean", "std").summary(vector).alias("s")).select(
        "s.mean", "s.std").first()
    std = stats["std"].toArray()
    features = Features(stats["mean"].toArray(), np.where(std > 1e-9, std, 1.0))
    equations = normal_equations(train, features)
    of_half = {f: solve(equations[1 - f]) for f in (0, 1)}
    beta = solve(equations[0] + equations[1])

    def crossed(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            z = features(_stack(pdf["stats"]))
            raw = np.where(pdf["fold"] == 0, z @ of_half[0], z @ of_half[1])
            step = np.floor(np.clip((raw + 0.5) / 2, 0, 1 - 1e-9) * STEPS).astype(int)
            yield pd.DataFrame({"step": step, "y": pdf["y"]})

    grid = train.mapInPandas(crossed, "step int, y double").groupBy("step").agg(
        F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).collect()
    at = np.array([(r["step"] + 0.5) / STEPS * 2 - 0.5 for r in grid])
    n = np.array([float(r["n"]) for r in grid])
    knots, values = isotonic(at, np.array([r["y"] for r in grid]) / n, n)

    def scored(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            raw = features(_stack(pdf["stats"])) @ beta
            score = 0.999 * np.interp(raw, knots, values) + 0.001 / (1 + np.exp(-4 * raw))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"],
                                "score": np.clip(score, 0, 1),
                                "predicted": (score >= threshold).astype(np.int32)})

    return rows.mapInPandas(
        scored, f"doc_id {kind}, held_out boolean, score double, predicted int")
