"""Host rules, line dedup, exact duplicates, sharding and mixing against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.compare import difference, duck
from logfeat.llm import common, exact_dedup, host_rules, line_dedup, mixing, queries, sharding
from logfeat.session import settle

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_counts(awkward):
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                   r["n_repeat_words"]) for r in rows_of(host_rules.judge(awkward)))
    assert got == Counter((r["doc_id"], *counts(r["text"])) for r in rows_of(awkward))


def test_random_repeats(spark):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("source", F.lit("s"))
    got = {r["doc_id"]: r["n_repeat_words"] for r in rows_of(host_rules.judge(df))}
    assert got == {i: counts(t)[4] for i, t in texts}


def test_hosts(spark):
    """A host of failures takes its good document with it; small and good hosts keep theirs."""
    good = "this is a good text with words enough to pass the rules of the house"
    rows = [(i, "bad", "short") for i in range(300)] + [(900, "bad", good)]
    rows += [(1000 + i, "fine", good + f" {i}") for i in range(300)] + [(2000, "fine", "short")]
    rows += [(3000 + i, f"small{i}", good) for i in range(50)] + [(4000, None, good)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    kept = {r["doc_id"] for r in rows_of(host_rules.judge(df)) if r["kept"]}
    assert kept == {i for i, s, t in rows if t != "short" and s != "bad"}
    again = host_rules.keep_good(df)
    assert again.columns == df.columns and {r["doc_id"] for r in rows_of(again)} == kept


def test_lines(awkward):
    rows = rows_of(awkward)
    seen, total = defaultdict(set), defaultdict(set)
    for r in rows:
        total[r["source"]].add(r["text"] or "")
        for line in {x.strip(" \t\x0b\f\r") for x in (r["text"] or "").split("\n")} - {""}:
            seen[r["source"], line].add(r["text"])

    def strip(text, source, least):
        return None if text is None else "\n".join(
            x for x in text.split("\n") if not (
                (n := len(seen[source, x.strip(" \t\x0b\f\r")])) >= least
                and n > 0.2 * len(total[source]) and x.strip(" \t\x0b\f\r")))

    for least in (1, 3):
        got = line_dedup.strip_lines(awkward, ratio=0.2, min_pages=least)
        assert got.columns == awkward.columns
        want = Counter((r["doc_id"], r["source"], strip(r["text"], r["source"], least)) for r in rows)
        assert Counter((r["doc_id"], r["source"], r["text"]) for r in rows_of(got)) == want
    assert any(r["text"] == "" for r in rows_of(line_dedup.strip_lines(awkward, ratio=0.2, min_pages=1)))


def test_fuse_filter():
    rng = np.random.default_rng(5)
    for n in (1, 2, 10, 1000, 30_000):
        keys = rng.integers(0, 2**63, n, dtype=np.uint64)
        built = exact_dedup.build_filter(np.concatenate([keys, keys[:5]]))
        assert exact_dedup.in_filter(keys, *built).all()
        other = rng.integers(0, 2**63, 50_000, dtype=np.uint64)
        assert exact_dedup.in_filter(other, *built).mean() < 0.001
    assert len(built[3]) < 2.6 * 30_000  # bytes: under 1.3 cells of 16 bits for a key


@pytest.mark.parametrize("n_batches", [1, 2, 5])
def test_exact_groups(awkward, n_batches):
    rows = rows_of(awkward)
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    got = rows_of(exact_dedup.exact_groups(awkward, n_batches=n_batches, filter_keys=4))
    want = Counter((i, max((x for x in ids if x is not None), default=None), len(ids),
                    hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_drop_copies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    assert {r["doc_id"] for r in rows_of(exact_dedup.drop_copies(df))} == {2, 3}
    rows = [(None, "a", 0), (None, "a", None), (None, "b", 1), (4, "b", None), (4, "b", 2), (5, None, 0), (6, "", 3)]
    df = settle(spark.createDataFrame(rows, "doc_id long, text string, batch int"))
    for batch in (None, F.col("batch")):
        kept = exact_dedup.drop_copies(df.drop("batch") if batch is None else df)
        assert Counter((r["doc_id"], r["text"] or "") for r in rows_of(kept)) == Counter(
            [(None, "a"), (4, "b"), (6, "")])


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_bytes_of_positives(spark, monkeypatch, most):
    """Texts of equal digests count as shared only if all bytes agree, by either way to them."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", most)
    rows = [(0, 7, "a"), (1, 7, "a"), (1, 7, "b"), (2, 7, "c"), (0, 8, "x"), (2, 8, "y"), (0, 9, "d"),
            (2, 9, "d"), (2, 9, "d"), (1, 5, "never asked")]
    texts = spark.createDataFrame(rows, "batch int, digest long, body string")
    pairs = [(0, 1, 7), (0, 2, 7), (1, 2, 7), (0, 2, 8), (0, 2, 9), (0, 2, 9)]
    found = spark.createDataFrame(pairs, "snapshot int, batch int, digest long")
    got = rows_of(exact_dedup.same_bytes(texts, found))
    assert sorted((r["digest"], bytes(r["text_sha"]), r["bytes"]) for r in got) == [
        (7, hashlib.sha256(b"a").digest(), 1), (9, hashlib.sha256(b"d").digest(), 1)]
    asked = settle(spark.createDataFrame([(7,), (9,)], "digest long"))
    assert Counter((r["batch"], r["digest"], r["body"]) for r in rows_of(
        exact_dedup.texts_of(texts, asked))) == Counter(set(x for x in rows if x[1] in (7, 9)))


def test_a_third_of_the_rows_are_one_text(spark, monkeypatch):
    df = settle(spark.range(3000).select(F.col("id").alias("doc_id"), F.expr(
        "CASE WHEN id % 3 = 0 THEN repeat('one text ', 900) ELSE 'text ' || id div 4 END").alias("text")))
    runs = []
    for most, check in ((1_000_000, True), (0, True), (0, False)):
        monkeypatch.setattr(common, "BROADCAST_ROWS", most)
        runs.append(Counter(tuple(r) for r in exact_dedup.exact_groups(
            df, filter_keys=300, check_bytes=check).collect()))
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 3000
    assert sum(r[2] == 1000 for r in runs[0]) == 1000


def test_null_batches(spark):
    rows = [(1, "a", None), (2, "a", 1), (3, "b", None), (4, "b", None), (5, "c", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, batch int")
    got = rows_of(exact_dedup.exact_groups(df, batch=F.col("batch")))
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == {
        (1, 2, 2), (2, 2, 2), (3, 4, 2), (4, 4, 2), (5, 5, 1)}


def test_differencing_is_tight():
    rng = random.Random(1)
    sizes = [rng.randint(1, 10_000) for _ in range(500)]
    where = sharding.differencing([[s] + [0] * 7 for s in sizes], 8)
    sums = [0] * 8
    for s, w in zip(sizes, where):
        assert sorted(w) == list(range(8))
        sums[w[0]] += s
    assert max(sums) - min(sums) < 30
    assert sharding.differencing([], 8) == []


def test_shards(spark, awkward):
    rows = rows_of(sharding.shard(awkward, task_groups=4, slot_rows=3))
    sizes = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1,
                     zlib.crc32((r["text"] or "").encode())) for r in rows_of(awkward))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == sizes
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    of_text = defaultdict(set)
    for r in rows:
        of_text[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(len(v) == 1 for v in of_text.values())
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr(
        "CASE WHEN id % 3 = 0 THEN 'copy' ELSE repeat(md5(CAST(id AS STRING)), 1 + id % 40) END"
    ).alias("text"))
    shards = sharding.shard(df, task_groups=500).groupBy("shard").agg(F.sum("size").alias("s"))
    sums = [r["s"] for r in rows_of(shards)]
    assert len(sums) == 8 and max(sums) - min(sums) < 40
    # with so few parts for the driver, tasks combine them in several steps first
    deep = sharding.shard(df, task_groups=60, driver_parts=4)
    sums = [r["s"] for r in rows_of(deep.groupBy("shard").agg(F.sum("size").alias("s")))]
    assert deep.count() == 3000 and len(sums) == 8, sums
    assert max(sums) - min(sums) < 0.005 * sum(sums) / 8, sums


def differenced(sizes, k):
    """The sets of a Karmarkar-Karp partition, kept as sets of items all the way."""
    states = [[(s, {i})] + [(0, set())] * (k - 1) for i, s in enumerate(sizes)]
    while len(states) > 1:
        states.sort(key=lambda x: x[0][0] - x[-1][0])
        a, b = states.pop(), states.pop()
        both = [(s + t, x | y) for (s, x), (t, y) in zip(a, reversed(b))]
        states.append(sorted(both, key=lambda x: -x[0]))
    return {frozenset(x) for _, x in states[0]}


def test_shards_against_differencing_of_sets(spark):
    """All sizes and sums of them differ, so there is one answer: shards are those sets of groups."""
    rng = random.Random(8)
    sizes = [rng.randint(10**4, 10**6) for _ in range(120)]
    rows = [(i * 10 + j, chr(97 + i % 26) + str(i) + "x" * s) for i, s in enumerate(sizes) for j in range(1 + i % 3)]
    df = settle(spark.createDataFrame(rows, "doc_id long, text string"))
    total = [sum(len(t) + 1 for d, t in rows if d // 10 == i) for i in range(len(sizes))]
    got = defaultdict(set)
    for r in rows_of(sharding.shard(df)):
        got[r["shard"]].add(r["doc_id"] // 10)
    assert {frozenset(v) for v in got.values()} == differenced(total, 8)


def test_targets(spark):
    rng = random.Random(2)
    for _ in range(4):
        sizes = [(None if i == 6 else f"s{i}", rng.choice([0, 5, 100, 3000, 70_000])) for i in range(7)]
        df = spark.createDataFrame(sizes, "source string, source_size long")
        got = {r["source"]: r["target"] for r in rows_of(mixing.source_targets(df))}
        weight = {s: (3, 1, 2)[i % 3] for i, (s, _) in enumerate(sizes)}
        want, free, left = {}, dict(sizes), 1.5 * sum(n for _, n in sizes)
        while free:
            level = left / sum(weight[s] for s in free)
            over = [s for s, n in free.items() if 2 * n < level * weight[s]]
            if not over:
                want |= {s: level * weight[s] for s in free}
                break
            for s in over:
                want[s] = 2.0 * free.pop(s)
                left -= want[s]
        assert got == pytest.approx(want)


def test_mix(spark, awkward):
    df = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.expr("CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 7 = 1 THEN "
                                            "NULL ELSE concat('s', id % 5) END").alias("source"),
        F.expr("repeat('word ', CAST(1 + id % 50 AS INT))").alias("text"), F.lit("x").alias("target"))
    rows = rows_of(mixing.mix(df))
    assert len(rows) == 4000
    taken = defaultdict(int)
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    for r in rows:
        assert abs(taken[r["source"]] - r["target"]) <= 26  # half a document
    assert sorted(map(str, rows)) == sorted(map(str, rows_of(mixing.mix(df.repartition(5)))))
    drawn = mixing.draw(df)
    assert drawn.columns == df.columns
    copies = Counter({r["doc_id"]: r["copies"] for r in rows if r["copies"]})
    assert Counter(r["doc_id"] for r in rows_of(drawn)) == copies
    odd = rows_of(mixing.mix(awkward))
    assert len(odd) == awkward.count() and all(r["taken"] <= 2 * r["size"] for r in odd)
    assert mixing.draw(awkward).columns == awkward.columns


def test_quality_weights_draw_more_often(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"),
                                  F.lit("ten words or so").alias("text"))
    rows = rows_of(mixing.mix(df, quality=F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1),
                              share=0.3))
    even = sum(r["copies"] for r in rows if r["doc_id"] % 2 == 0)
    assert even > 4 * sum(r["copies"] for r in rows if r["doc_id"] % 2)


def test_nothing(nothing):
    for f in (mixing.mix, mixing.draw, host_rules.judge, host_rules.keep_good,
              line_dedup.strip_lines, exact_dedup.exact_groups, sharding.shard):
        assert f(nothing).count() == 0, f


@pytest.mark.parametrize("name", ["op1_mix_sources", "op6_host_rules", "op7_exact_dedup",
                                  "op10_line_dedup"])
def test_sql_agrees_on_awkward_rows(spark, awkward, data, tmp_path, name):
    ids = F.row_number().over(Window.orderBy("doc_id", "text")).cast("long")
    awkward.select(ids.alias("doc_id"), "text", "lang", "source", "n_chars").coalesce(
        1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duck(data)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    assert difference(queries.queries()[name](spark, str(tmp_path)).toPandas(), want) is None
