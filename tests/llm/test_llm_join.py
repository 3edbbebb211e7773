"""Jaccard links and the whole pipeline against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from logfeat.llm import pieces, shingle_join
from logfeat.llm.shingle_join import Rule
from logfeat.session import settle

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def groups(texts, k, percent):
    """{id: smallest id reachable}, by comparing all that share a shingle."""
    sets = {i: shingles(t, k) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for g in sets[i] for j in having[g])
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for g in sets[i]:
            having[g].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def family(rng, n_docs, length, edits, passage):
    """Copies of a text with up to ``edits`` words replaced, deleted or doubled."""
    base = [rng.choice(VOCABULARY) for _ in range(length)]
    base[5:5 + len(passage)] = passage
    for _ in range(n_docs):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            i = rng.randrange(len(w))
            w[i:i + 1] = rng.choice([[], [w[i], w[i]], [rng.choice(VOCABULARY)], ["EDIT"]])
        yield " ".join(w)


VOCABULARY = [f"w{i}" for i in range(40)] + [f"rare{i}" for i in range(3000)]


@pytest.mark.parametrize("k,percent,pool", [(3, 90, 2.0), (5, 80, 1.5), (1, 70, 1.5), (2, 95, 1.0)])
def test_components_are_exact(spark, monkeypatch, k, percent, pool):
    """Large and small families of near copies, shared passages, with low limits for tokens."""
    monkeypatch.setattr(shingle_join, "RARE", 4)
    monkeypatch.setattr(shingle_join, "LOW", 12)
    rng = random.Random(k * 100 + percent)
    passage = [f"common{i}" for i in range(30)]
    texts = [t for n, length, edits in ((60, 80, 12), (40, 200, 20), (25, 45, 3), (5, 60, 4),
                                        (3, 400, 30), (12, 12, 2), (20, 6, 1))
             for t in family(rng, n, length, edits, passage[:length // 3])]
    texts += [" ".join(rng.choice(VOCABULARY) for _ in range(60)) for _ in range(40)] + ["", " a ", "A"]
    rows = list(enumerate(rng.sample(texts, len(texts))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in rows_of(shingle_join.near_groups(df, words=k, percent=percent, pool=pool))}
    want = groups(rows, k, percent)
    assert got == want and len({c for _, c in want.values()}) < len(rows)


def test_drifting_chain_is_one_component(spark):
    """Each text links to the next one only."""
    words = [f"x{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i:3 * i + 100])) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(shingle_join.near_groups(df, words=3, percent=90))
    assert {r["doc_id"]: r["component_id"] for r in got} == {
        i: c for i, (_, c) in groups(rows, 3, 90).items()}
    assert sum(r["component_id"] == 0 for r in got) == 90


def test_limits_by_size():
    for percent in (70, 80, 90, 95):
        rule = Rule(percent=percent)
        for n in range(rule.least, 400):
            y = n  # the largest set that can link to one of n: all of n and more
            while 100 * n >= percent * (y + 1):
                y += 1
            assert rule.misses(n) == max(
                m for m in range(n) if 100 * (n - m) >= percent * n)
            assert rule.index(n) >= min(n, rule.pool(y) + rule.misses(n))
        small = rule.least - 1
        assert all(100 * a < percent * b for b in range(small + 1) for a in range(b))


def test_awkward_rows(awkward, nothing):
    rows = rows_of(shingle_join.near_groups(awkward))
    assert len(rows) == awkward.count()
    of = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert {of[i]["component_id"] for i in (1, 2, 3, 9)} == {1}
    assert of[6]["component_id"] == of[13]["component_id"] == 6
    assert all(of[i]["n_shingles"] == 0 and of[i]["component_id"] == i for i in (4, 5, 7))
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {None}
    kept = shingle_join.keep_one(settle(awkward))
    assert kept.columns == awkward.columns
    # one row of each group of copies, ids null or repeated; texts without words all stay
    left = Counter((r["doc_id"], r["text"]) for r in rows_of(kept))
    every = Counter((r["doc_id"], r["text"]) for r in rows_of(awkward))
    words = {i for i in of if of[i]["n_shingles"]}
    assert {i for i, _ in left} & words == {i for i in words if of[i]["component_id"] == i}
    assert all(n == (1 if (t or "").strip() else every[i, t]) for (i, t), n in left.items())
    assert left[8, "Ünïcode wörds: naïve façade 日本語 text"] == 1 and left[None, None] == 1
    assert shingle_join.near_groups(nothing).count() == 0


def test_versions_of_one_id_are_linked(spark):
    rows = [(1, "a b c d e f"), (5, "g h i j k l"), (5, "a b c d e f"), (7, "m n o p q r")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["component_id"]) for r in rows_of(shingle_join.near_groups(df)))
    assert got == {(1, 1): 1, (5, 1): 2, (7, 7): 1}


# -- the pipeline, in plain Python

def passes(text):
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    covered = len({i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)})
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return not (len(w) < 10 or 100 * covered > 20 * len(w)
                or sum(c in "#*$%&|<>" for c in text) > 0.3 * len(w)
                or 10 * (len(lines) - len(set(lines))) > 0.3 * len(w))


def good_hosts(docs):
    hosts = defaultdict(lambda: [0, 0])
    for d in docs:
        hosts[d["source"]][0] += 1
        hosts[d["source"]][1] += not passes(d["text"])
    n, f = (sum(h[k] for h in hosts.values()) for k in (0, 1))
    m = f / n
    v = sum(a * (b / a - m) ** 2 for a, b in hosts.values()) / n - m * (1 - m) * len(hosts) / n
    strength = min(max(m * (1 - m) / max(v, 1e-9) - 1, 1), 1e6)
    return {h for h, (a, b) in hosts.items() if (b + m * strength) / (a + strength) <= 0.5}


def strip(docs):
    """Lines that three pages and a tenth of a source's have; near copies are one page."""
    lead = {i: g[1] for i, g in groups([(d["doc_id"], d["text"]) for d in docs], 5, 80).items()}
    pages, total = defaultdict(set), defaultdict(set)
    for d in docs:
        total[d["source"]].add(lead[d["doc_id"]])
        for line in {x.strip(" \t\x0b\f\r") for x in d["text"].split("\n")} - {""}:
            pages[d["source"], line].add(lead[d["doc_id"]])
    for d in docs:
        n = len(total[d["source"]])
        d["text"] = "\n".join(x for x in d["text"].split("\n") if not (
            (t := x.strip(" \t\x0b\f\r")) and len(pages[d["source"], t]) >= 3
            and len(pages[d["source"], t]) > 0.1 * n))


def mix(docs):
    by = defaultdict(list)
    for d in docs:
        size = len(WORD.findall(d["text"]))
        u = (int(hashlib.md5(str(d["doc_id"]).encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        odd = sum(not (c.isalpha() or c == " " or "\t" <= c <= "\r") for c in d["text"])
        q = max(0.1, 1 - odd / max(len(d["text"]), 1))
        by[d["source"]].append((-math.log(u) / q, d["doc_id"], size))
    sizes = {s: sum(x[2] for x in rows) for s, rows in by.items()}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(by))}
    free, left, target = set(by), 1.5 * sum(sizes.values()), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if 2 * sizes[s] < level * weight[s]}
        target |= {s: 2 * sizes[s] if over else level * weight[s] for s in over or free}
        left -= sum(target[s] for s in over)
        free = free - over if over else set()
    copies = {}
    for s, rows in by.items():
        epochs = int(target[s] // sizes[s]) if sizes[s] else 0
        budget, done = target[s] - epochs * sizes[s], 0
        for key, i, size in sorted(rows):
            done += size
            copies[i] = epochs + (budget > 0 and done - size / 2 <= budget)
    return copies


def test_pipeline(spark, data):
    docs = rows_of(spark.read.parquet(f"{data}/documents.parquet"))
    good = good_hosts(docs)
    docs = [d for d in docs if d["source"] in good and passes(d["text"])]
    strip(docs)
    first = groups([(d["doc_id"], d["text"]) for d in docs], 5, 80)
    docs = [d for d in docs if first[d["doc_id"]][1] == d["doc_id"]]
    copies = mix(docs)
    v = pieces.Vocabulary(pieces.read_model())
    want = Counter()
    for d in docs:
        ids = v.viterbi(v.normalise(d["text"]))[0]
        want[d["doc_id"], d["text"], zlib.crc32(np.array(ids, np.int32).tobytes())] += copies[d["doc_id"]]
    got = Counter((r["doc_id"], r["decoded"], zlib.crc32(np.array(r["ids"], np.int32).tobytes()))
                  for r in rows_of(entry.queries()["pipeline"](spark, data)))
    assert got == +want
    assert len(corpus_pipeline.STAGES) == 5


def test_one_of_copies_without_ids_and_with_clashing_names(spark):
    text = "one text of some words that has copies"
    rows = [(None, text, 1, 1), (None, text, 2, 2), (7, text, 3, 3), (7, text, 4, 4),
            (9, "another text that has no copies", 5, 5), (None, "text of a row without id, alone", 6, 6)]
    for names in ("_gone long, n long", "row long, id long", "_row long, component_id long"):
        df = settle(spark.createDataFrame(rows, f"doc_id long, text string, {names}"))
        kept = shingle_join.keep_one(df)
        assert kept.columns == df.columns
        assert Counter((r[0], r[1]) for r in kept.collect()) == Counter(
            [(7, text), (9, rows[4][1]), (None, rows[5][1])])
    only = settle(spark.createDataFrame(rows[:2], "doc_id long, text string, a long, b long"))
    assert [r["a"] for r in shingle_join.keep_one(only).collect()] in ([1], [2])


def test_stages_keep_the_columns_and_take_awkward_rows(spark, awkward, nothing):
    for start in (awkward, nothing, awkward.drop("n_chars")):
        docs = settle(start)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            assert name == "pieces" or out.columns == docs.columns
            docs = settle(out)


def test_near_copies_keep_their_text_through_the_stages(spark):
    """A third of a source's rows are near copies that differ in a line: one stays, whole."""
    page = "a text of its own number {0}\nwith words {0} enough of them\nthe footer of the site"
    body = "\n".join(f"line {i} of an article that a third of all rows have, word {i * i}" for i in range(12))
    rows = [(i, f"{body}\nseen on day {i}" if i % 3 == 0 else page.format(i), "s") for i in range(300)]
    df = settle(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for name, stage in corpus_pipeline.STAGES[1:3]:
        df = settle(stage(spark, df, ""))
    got = {r["doc_id"]: r["text"] for r in rows_of(df)}
    assert [i for i, t in got.items() if t.startswith("line 0")] == [0]
    assert got[0] == f"{body}\nseen on day 0"
    assert not [t for t in got.values() if "footer" in t] and len(got) == 201


def test_copies_keep_their_text_through_the_stages(spark):
    """A third of a source's rows are copies of one text: one of them stays, whole."""
    page = "a text of its own number {0}\nwith words {0} enough of them\nthe footer of the site"
    copy = "one text that a third of all rows have\nand its second line is as common"
    rows = [(i, copy if i % 3 == 0 else page.format(i), "s") for i in range(300)]
    df = settle(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for name, stage in corpus_pipeline.STAGES[1:3]:
        df = settle(stage(spark, df, ""))
    got = {r["doc_id"]: r["text"] for r in rows_of(df)}
    assert [i for i, t in got.items() if t == copy] == [0]
    assert not [i for i, t in got.items() if not t or "footer" in t] and len(got) == 201
