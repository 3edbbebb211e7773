"""Spelling variants, nearest vectors and target resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logfeat.llm import block_search, resampling, spelling

AZ = str.maketrans(spelling.AZ, spelling.AZ.lower())


# -- spelling

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_variants(counts, ratio=5):
    near = {w: sorted(v for v in counts if v != w and one_edit(w, v)) for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), form[w] and counts[form[w]])
            for w, n in counts.items()}


def slow_words(rows, slip=None, least=6, often=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= often}


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_variants_against_all_pairs(spark):
    dice = random.Random(3)
    words = {"".join(dice.choice("abcé×") for _ in range(dice.randint(2, 7))) for _ in range(500)}
    words |= {"aaaaaa", "aaaaa", "aaaaaaa", "baaaaa", "aaaaab", "aabaaa"}
    counts = {w: dice.choice([1, 3, 6, 30, 200, 1000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(df).collect()
    assert len(got) == len(counts) and {tuple(r) for r in got} == slow_variants(counts)


def test_long_chain_of_forms(spark):
    counts = {"a" * 6 + "b" * i: 5 ** (12 - i) for i in range(12)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(df)) == slow_variants(counts)


def test_words_beyond_the_trie(spark):
    dice = random.Random(5)
    base = "".join(dice.choice("abc") for _ in range(spelling.DEEPEST - 1))
    words = {base, base + "a", base + "ab", base + "abc", "b" + base + "a", base[:20] + "z" + base[20:]}
    long = "".join(dice.choice("ab") for _ in range(3000))
    words |= {long, long[:-1], long[1:], long[:1500] + "c" + long[1501:], long[:7] + "q" + long[7:], "x" + long + "x"}
    counts = {w: 5 ** (i % 4) for i, w in enumerate(sorted(words))}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(df)) == slow_variants(counts)


def test_a_third_of_the_words_share_a_beginning(spark):
    dice = random.Random(8)
    words = {"prefix" + "".join(dice.choice("abcd") for _ in range(4)) for _ in range(150)}
    words |= {"".join(dice.choice("abcdxyz") for _ in range(8)) for _ in range(300)}
    counts = {w: dice.randint(1, 60) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(df)) == slow_variants(counts)


def test_counted_words_with_slips(spark):
    dice = random.Random(4)
    rows = [(i if i % 9 else None, " ".join(dice.choice(
        ["Naïveté", "naïvete", "wonderful", "WONDERFULL", "short", "Äußerung", "two-part", "x×y÷zzz", "snake_case"])
        for _ in range(40))) for i in range(60)] + [(7, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for slip in (None, 3):
        got = spelling.count_words(df, slip=slip)
        assert {r["word"]: r["n"] for r in got.collect()} == slow_words(rows, slip)


def test_spelling_of_awkward_rows(spark, awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = rows_of(spelling.spelling_variants(awkward, min_count=1, slip=2))
    assert got == slow_variants(slow_words(rows, 2, often=1))
    assert spelling.spelling_variants(nothing).count() == 0


# -- vectors

def slow_nearest(rows, top, step=4):
    """rows: (id, vector or None), in their order"""
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    out = []
    for i, (q, v) in enumerate(rows):
        if q is None or q % step or not usable(v):
            continue
        found = []
        for j, (c, w) in enumerate(rows):
            if j != i and usable(w) and len(w) == len(v):
                score = 0.0
                for x, y in zip(v, w):
                    score += float(np.float32(x)) * float(np.float32(y))
                found.append((-score, c is None, c or 0, c))
        found.sort(key=lambda f: f[:3])
        out += [(q, rank, f[3], -f[0]) for rank, f in enumerate(found[:top], 1)]
    return sorted(out, key=str)


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumn("score", F.lit("s")).withColumn("row", F.lit(None)).withColumn("v", F.lit(1))


@pytest.mark.parametrize("block", [65536, 37])
def test_nearest_against_all_products(spark, block, monkeypatch):
    monkeypatch.setattr(block_search, "TILE", 500)
    monkeypatch.setattr(block_search, "LANE", 100)
    draw = np.random.default_rng(2)
    data = draw.normal(size=(220, 12)) * np.exp(draw.normal(size=(220, 1)) * 3)
    data[40:120] = data[40]  # a third are copies
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(data)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        got = block_search.nearest(vectors(spark, rows), F.col("vec_id") % 4 == 0, top=7, block=block)
        assert sorted(map(tuple, got.collect()), key=str) == slow_nearest(rows, 7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_awkward_vectors(spark):
    one = [1.0, 2.0, -3.0]
    rows = [(0, one), (4, [2.0, 0.0, 1.0]), (4, [2.0, 0.0, 1.0]), (None, one), (8, None), (12, [0.0] * 3),
            (16, [1.0, None, 2.0]), (20, [float("nan")] * 3), (24, [float("inf"), 1.0, 1.0]), (28, []),
            (32, [1.0, 1.0]), (36, [-1.0, 5.0]), (1, one), (2, one), (40, [-0.0, 1e-30, 0.0]), (3, [3.0, 3.0, 3.0])]
    got = block_search.nearest(vectors(spark, rows), F.col("vec_id") % 4 == 0, top=3)
    assert sorted(map(tuple, got.collect()), key=str) == slow_nearest(rows, 3)
    assert block_search.nearest(vectors(spark, rows).limit(0), F.col("vec_id") % 4 == 0).count() == 0


def test_wide_vectors_and_doubles(spark):
    draw = np.random.default_rng(9)
    data = draw.normal(size=(30, 2500))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    got = block_search.nearest(df, F.col("vec_id") % 10 == 0, top=4).collect()
    want = data @ data.T
    for r in got:
        others = [j for j in np.argsort(-want[r["query_id"]]) if j != r["query_id"]]
        assert others[r["rank"] - 1] == r["vec_id"]
        assert r["score"] == pytest.approx(want[r["query_id"], r["vec_id"]], abs=1e-9)


# -- resampling

def slow_resample(docs, aims, share=25, least=20, seed=7):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
        return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    source, target = Counter(), Counter()
    for _, t in docs:
        source.update(features(t)[1])
    for t in aims:
        target.update(features(t)[1])
    s, t = sum(source.values()), sum(target.values())
    rows = []
    for i, (doc, text) in enumerate(docs):
        n, b = features(text)
        gain = sum(math.floor(1000 * math.log((target[x] + 1) * (s + 10000) / ((source[x] + 1) * (t + 10000)))) for x in b)
        weight = gain // len(b) if b else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, i])
    enough = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    rank = {r[5]: k for k, r in enumerate(enough[:share * len(enough) // 100], 1)}
    return sorted(((*r[:4], rank.get(r[5])) for r in rows), key=str)


def test_resample_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    aims = spark.read.parquet(f"{data}/benchmark.parquet").select("text")
    rows, wanted = [tuple(r) for r in docs.collect()], [r[0] for r in aims.collect()]
    got = resampling.resample(docs, aims)
    assert sorted(map(tuple, got.collect()), key=str) == slow_resample(rows, wanted)


def test_ties_at_the_cutoff(spark):
    text = " ".join(["alike"] * 25)
    docs = [(5, text)] * 9 + [(None, text)] * 30 + [(3, "few words"), (4, None), (6, ""), (1, text + " or not")]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    aims = spark.createDataFrame([("alike",), (None,)], "text string")
    for share in (0, 10, 25, 60, 99, 100):
        got = resampling.resample(df, aims, share=share)
        assert sorted(map(tuple, got.collect()), key=str) == slow_resample(docs, ["alike", None], share)


def test_many_equal_scores(spark):
    rows = [(i, 7 if i % 3 else -10**12 + i, i) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, score long, row long")
    for k in (1, 299, 600, 601, 890, 900):
        got = {r["doc_id"] for r in df.where(resampling.draw_highest(df, k)).collect()}
        assert got == {r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0]))[:k]}


def test_resample_awkward_rows(spark, awkward, nothing):
    aims = spark.createDataFrame([("the word1 of the", "n")], "text string, kept string")
    rows = [(r["doc_id"], r["text"]) for r in awkward.coalesce(1).collect()]
    got = resampling.resample(awkward, aims, share=50)
    assert sorted(map(tuple, got.collect()), key=str) == slow_resample(rows, ["the word1 of the"], 50)
    assert resampling.resample(nothing, aims).count() == 0
    assert resampling.resample(awkward, aims.limit(0), share=50).count() == len(rows)
