"""Jaccard links between documents' shingle sets by token-combination prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import passing, settle
from .common import narrow, whole

RARE = 32  # tokens in at most so many sets are indexed alone, others in pairs
LOW, SKETCH = 128, 8  # tokens in up to LOW sets, and others, have SKETCH 64-bit words of marks each


class Rule:
    """Shingles of ``words`` words; sets link when 100 * common >= ``percent`` * union."""

    def __init__(self, words: int = 5, percent: int = 80, pool: float = 1.5):
        self.words, self.percent, self.pool_factor = words, percent, pool

    def misses(self, n: int) -> int:
        """Most tokens of a set of ``n`` that a linked set can lack."""
        return n - -(-self.percent * n // 100)

    def pool(self, n: int) -> int:
        return int(self.pool_factor * (self.misses(n) + 1)) + 1

    def index(self, n: int) -> int:
        """Tokens of a set of ``n`` (in hash order) that hold all it shares with the pool of a
        linked set: those of the largest such set's pool, and the ones that set may lack."""
        return min(n, self.pool(100 * n // self.percent) + self.misses(n))

    @property
    def least(self) -> int:
        """Sets below this size can only link to equal ones."""
        return next(n for n in range(1, 1000) if 100 * n >= self.percent * (n + 1))

    def misses_col(self, n: Column) -> Column:
        return n - F.ceil(F.lit(self.percent) * n / 100).cast("long")

    def small_misses_col(self, n: Column) -> Column:
        """The same for the smaller set of a pair (or either of two equal ones)."""
        return n - F.ceil(F.lit(2 * self.percent) * n / (100 + self.percent)).cast("long")

    def possible(self, n_a: Column, n_b: Column, common: Column) -> Column:
        """Whether two sets of these sizes can link with at most ``common`` common tokens."""
        return (100 + self.percent) * common >= self.percent * (n_a + n_b)


# -- sets of 64-bit shingle hashes

def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``k`` words (A-Z lower-cased; fewer words make
    one shingle of all; no words, none)."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    size = min(k, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - size + 1 + i])
    return np.unique(out)


def _node(tokens: np.ndarray) -> int:
    """The set's digest, even: its last bit is free for a mark."""
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(tokens.tobytes()) & ~1], np.uint64).view(np.int64)[0]


def _sets(batch: pa.RecordBatch, column: int, k: int) -> Iterator[np.ndarray]:
    for text in batch.column(column):
        yield shingle_set(text.as_py(), k)


def set_sizes(docs: DataFrame, rule: Rule, kind: str) -> DataFrame:
    """(doc_id, n, node) of every row."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sets = [(len(s), _node(s)) for s in _sets(batch, 1, rule.words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s[0] for s in sets], pa.int64()),
                 pa.array([s[1] for s in sets], pa.int64())], names=["doc_id", "n", "node"])

    return docs.mapInArrow(batches, f"doc_id {kind}, n long, node long")


def index_tokens(docs: DataFrame, rule: Rule) -> DataFrame:
    """(token, node): the first tokens of each set in hash order; nodes are marked (odd) for
    tokens that lie in the set's pool.  A set that a task has seen is not repeated."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in it:
            tokens, nodes = [], []
            for s in _sets(batch, 0, rule.words):
                if len(s) < rule.least:
                    continue
                node = _node(s)
                if node in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(node)
                own = s[:rule.index(len(s))]
                marked = np.full(len(own), node, np.int64)
                marked[:rule.pool(len(s))] |= 1
                tokens.append(own.view(np.int64))
                nodes.append(marked)
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens)), pa.array(np.concatenate(nodes))],
                    names=["token", "node"])

    return docs.select("text").mapInArrow(batches, "token long, node long")


def full_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """(node, n, tokens) of the rows of ``docs``."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in it:
            for start in range(0, big.num_rows, 500):
                sets = list(_sets(big.slice(start, 500), 0, rule.words))
                sizes = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([_node(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(sizes), pa.array(np.concatenate(sets).view(np.int64)))],
                    names=["node", "n", "tokens"])

    return docs.select("text").mapInArrow(batches, "node long, n long, tokens array<long>")


# -- candidates

def _lonely(docs: DataFrame, rule: Rule) -> DataFrame:
    """Marks and counts: (node, alone), tokens of a set's pool that no other set has indexed.

    A token of one set alone is told by the smallest and the largest node that have it, so hot
    tokens shrink to one row per task before the shuffle.
    """
    by_token = index_tokens(docs, rule).groupBy("token").agg(
        F.min("node").alias("low"), F.max("node").alias("high"))
    alone = by_token.where(F.shiftright("low", 1) == F.shiftright("high", 1)).where(
        F.col("high") % 2 != 0)
    return alone.groupBy((F.shiftright("high", 1) * 2).alias("node")).agg(
        F.count(F.lit(1)).alias("alone"))


def shared_tokens(sets: DataFrame, rule: Rule) -> DataFrame:
    """(node, n, unique, misses, shared): of the sets that can link, the tokens that other sets
    have too, (df, token) in the order of df, the number of sets that have it.

    Unique tokens come first in that order: with more of them than may be missing, nothing links.
    """
    tokens = sets.select("node", F.explode("tokens").alias("token"))
    freq = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = tokens.join(freq, "token").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared"))
    return shared.join(sets.select("node", "n"), "node").select(
        "node", "n", (F.col("n") - F.size("shared")).alias("unique"),
        rule.misses_col(F.col("n")).alias("misses"), "shared").where("unique <= misses")


def profiles(shared: DataFrame) -> DataFrame:
    """(node, low, alone, bits): what bounds the common tokens of two sets from above.

    ``low`` counts the tokens in up to LOW sets, ``alone`` those of them in this set only.  All
    others are marked in ``bits`` by hash: in the first SKETCH words if they are low, in the last
    ones if not.
    """
    marks = shared.select("node", F.explode("shared").alias("t")).select(
        "node", (F.col("t.token").bitwiseAND(F.lit(SKETCH - 1)) + F.when(
            F.col("t.df") > LOW, SKETCH).otherwise(0)).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(
            "t.token", 8).bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    words = marks.groupBy("node", "word").agg(F.bit_or("bit").alias("bits"))
    words = words.groupBy("node").agg(F.map_from_entries(F.collect_list(
        F.struct("word", "bits"))).alias("m"))
    bits = F.transform(F.sequence(F.lit(0), F.lit(2 * SKETCH - 1)), lambda j: F.coalesce(
        F.element_at("m", j), F.lit(0).cast("long")))
    low = F.size(F.filter("shared", lambda t: t["df"] <= LOW))
    rows = shared.select("node", (F.col("unique") + low).alias("low"), F.col("unique").alias("alone"))
    empty = F.array_repeat(F.lit(0).cast("long"), 2 * SKETCH)
    return rows.join(words.select("node", bits.alias("bits")), "node", "left").withColumn(
        "bits", F.coalesce("bits", empty))


def _most_common(a: str, b: str) -> Column:
    """A bound on the common tokens of the sets whose columns end in ``a`` and in ``b``.

    Each mark that only one of them has stands for a token that the other lacks.
    """
    def kept(x: str, y: str) -> Column:
        only = sum((F.bit_count(F.get(f"bits{x}", F.lit(j)).bitwiseAND(
            F.bitwise_not(F.get(f"bits{y}", F.lit(j))))) for j in range(2 * SKETCH)), F.lit(0))
        return F.col(f"n{x}") - F.col(f"alone{x}") - only

    return F.least(kept(a, b), kept(b, a))


def _ended(df: DataFrame, end: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c + end) for c in df.columns])


def signatures(shared: DataFrame, rule: Rule) -> DataFrame:
    """(sig, node, n, probe): ``sig`` is a rare token, or a pair of others.

    If the first misses + 1 tokens of a set are all rare, they are its prefix, each a signature:
    a linked set has one of them.  Otherwise the prefix is longer by g: of its tokens at least
    g + 1 are common; if none of these is rare, two of them fall into the same of g groups (by
    hash), and pairs within groups are signatures.  g follows the size in powers of two; near a
    change both are used, as a linked set may lie on the other side.

    The smaller set of a pair may miss fewer tokens of the other, so a shorter prefix will do for
    it: ``probe`` marks the signatures in that.  A pair needs one that the smaller set probes.
    """
    at = F.col("misses") + 1 - F.col("unique")  # prefix length among the shared tokens
    short = rule.small_misses_col(F.col("n")) + 1 - F.col("unique")

    def ranked(length: Column, keep) -> Column:
        prefix = F.slice("shared", F.lit(1), F.greatest(length.cast("int"), F.lit(0)))
        return F.explode(F.filter(F.transform(prefix, lambda x, i: F.struct(
            x["df"].alias("df"), x["token"].alias("token"), (i + 1).alias("rank"))), keep)).alias("t")

    sizes = F.array_distinct(F.transform(
        F.array(F.floor(F.col("n") * rule.percent / 100), F.col("n"),
                F.ceil(F.col("n") * 100 / rule.percent)),
        lambda x: F.pow(F.lit(2), F.floor(F.log2(F.greatest(x.cast("double") / 16, F.lit(1.0))))).cast(
            "int")))
    rows = shared.select(
        "node", "n", "shared", at.cast("int").alias("at"), short.cast("int").alias("short"),
        *[(F.get("shared", (k - 1).cast("int"))["df"] > RARE).alias(name)
          for k, name in ((at, "longer"), (short, "longer_short"))], sizes.alias("groups"))
    rare = rows.select("node", "n", "short", ranked(F.col("at"), lambda x: x["df"] <= RARE)).select(
        F.xxhash64("t.token").alias("sig"), "node", "n",
        (F.col("t.rank") <= F.col("short")).alias("probe"))
    schemes = rows.where("longer").select(
        "node", "n", "shared", "at", "short", "longer_short", F.explode("groups").alias("g"))
    reach = F.when(F.col("longer_short"), F.col("short") + F.col("g")).otherwise(0)
    pieces = schemes.select("node", "n", "g", reach.alias("reach"), ranked(
        F.col("at") + F.col("g"), lambda x: x["df"] > RARE))
    pieces = pieces.select("node", "n", "g", "reach", F.struct("t.token", "t.rank").alias("t"),
                           F.pmod(F.xxhash64(F.lit(3), "t.token"), F.col("g")).alias("group"))
    grouped = pieces.groupBy("node", "n", "g", "reach", "group").agg(
        F.array_sort(F.collect_list("t")).alias("own")).where(F.size("own") > 1)
    pairs = grouped.select("node", "n", F.explode(F.flatten(F.transform(
        "own", lambda x, i: F.transform(
            F.slice("own", i + 2, F.greatest(F.size("own") - i - 1, F.lit(0))),
            lambda y: F.struct(
                F.xxhash64(F.col("g"), x["token"], y["token"]).alias("sig"),
                (F.greatest(x["rank"], y["rank"]) <= F.col("reach")).alias("probe")))))).alias("p"))
    return rare.unionByName(pairs.select("p.sig", "node", "n", "p.probe"))


def _smaller(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Whether set a = (size, node) comes before b: by size, then by node."""
    return (F.col(a[0]) < F.col(b[0])) | (
        (F.col(a[0]) == F.col(b[0])) & (F.col(a[1]) < F.col(b[1])))


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(rule.possible(F.size("x"), F.size("y"), common)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that links (a, b) lead to, for nodes that have links."""
    edges = settle(links.unionByName(links.select(
        F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = settle(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select(
            "node", "comp", F.least("comp", "near").alias("new"))
        up = labels.select(F.col("node").alias("new"), F.col("comp").alias("further"))
        new = settle(step.join(up, "new", "left").select(
            "node", F.least("new", F.coalesce("further", "new")).alias("comp"),
            (F.col("comp") != F.least("new", F.coalesce("further", "new"))).alias("moved")),
            "labels")
        labels = new.select("node", "comp")
        if new.where("moved").isEmpty():
            return labels


def set_links(sets: DataFrame, rule: Rule) -> DataFrame:
    """(node, comp) of the sets that link to others.

    Members of a bucket are first compared with one of them alone, the one with the fewest tokens
    that are in few sets: that joins most groups of near copies.  Then every pair of a bucket
    that is not yet in one component is compared; members of a bucket's largest component are not
    paired with each other.  Pairs whose profiles rule a link out never leave the join.
    """
    shared = settle(shared_tokens(sets, rule), "shared")
    profile = settle(profiles(shared), "profiles")
    marks = settle(signatures(shared, rule).join(profile.select("node", "low"), "node"),
                   "signatures")
    centre = marks.groupBy("sig").agg(
        F.min(F.struct("low", "node", "n", "probe")).alias("c"), F.count(F.lit(1)).alias("m")).where(
        "m > 1").select("sig", F.col("c.node").alias("b"), F.col("c.n").alias("n_b"),
                        F.col("c.probe").alias("probe_b"))
    near = rule.possible(F.col("n"), F.col("n_b"), F.least("n", "n_b"))
    asked = F.when(_smaller(("n", "node"), ("n_b", "b")), F.col("probe")).otherwise(F.col("probe_b"))
    first = marks.join(centre, "sig").where((F.col("node") != F.col("b")) & near & asked).select(
        F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    first = settle(first, "first")
    whole_profile = profile.join(sets.select("node", "n"), "node")
    fits = rule.possible(F.col("n_a"), F.col("n_b"), _most_common("_a", "_b"))
    tried = first.join(_ended(whole_profile, "_a"), F.col("a") == F.col("node_a")).join(
        _ended(whole_profile, "_b"), F.col("b") == F.col("node_b")).where(fits).select("a", "b")
    links = settle(_verified(tried, sets, rule), "links")
    comp = components(links)

    named = marks.join(comp, "node", "left").withColumn(
        "comp", F.coalesce("comp", F.col("node")))
    buckets = named.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("m"))
    buckets = buckets.groupBy("sig").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("m", "comp")).alias("large")).where(
        "parts > 1").select("sig", F.col("large.comp").alias("large"))
    left = named.join(buckets, "sig").select("sig", "node", "n", "probe", "comp", "large")
    left = settle(left.join(profile, "node"), "open")
    others = _ended(left.where("comp != large"), "_b")
    before = _smaller(("n_a", "node_a"), ("n_b", "node_b"))
    asked = F.when(before, F.col("probe_a")).otherwise(F.col("probe_b"))
    once = before | (F.col("comp_a") == F.col("large_a"))  # two of the others meet twice
    second = _ended(left, "_a").join(others, (F.col("sig_a") == F.col("sig_b")) & (
        F.col("comp_a") != F.col("comp_b")) & asked & once & fits).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    second = second.distinct().join(first, ["a", "b"], "left_anti")
    more = settle(_verified(second, sets, rule), "links")
    return comp if more.isEmpty() else components(links.unionByName(more))


def near_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", words: int = 5,
    percent: int = 80, pool: float = 1.5,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Documents link when the Jaccard similarity of their sets of ``words``-word shingles is at
    least ``percent`` / 100; ``component_id`` is the smallest id that links lead to.

    Equal sets are one node.  A first pass over the tokens settles most documents: of two linked
    sets, each has a token of its pool (the first tokens in hash order) in the other's indexed
    part, unless it has more pool tokens to itself than a link may miss; those sets link to
    nothing.  The others, whole, go through ``set_links``.

    Null and empty texts have no shingles and link to nothing.  Rows of one id are one document,
    and linked.  A null id is no smallest id: such rows have the id of their component, or null.
    Shingles and sets are compared by 64-bit hashes.
    """
    rule = Rule(words, percent, pool)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text).alias("text"))
    sizes = settle(set_sizes(rows, rule, kind), "sizes")
    nodes = sizes.where("n > 0").groupBy("node", "n").agg(F.min("doc_id").alias("rep"))
    nodes = settle(nodes, "nodes")
    alone = settle(_lonely(rows, rule), "alone")
    left = nodes.where(F.col("n") >= rule.least).join(alone, "node", "left").where(
        F.coalesce("alone", F.lit(0)) <= rule.misses_col(F.col("n")))
    left = settle(left.select("node", "rep"), "left")
    reps = settle(left.select(F.col("rep").alias("_rep")).distinct(), "reps")
    texts = rows.join(narrow(reps), F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi")
    sets = full_sets(texts, rule)
    repeated = sizes.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if not repeated.isEmpty():  # else each of these ids has one row, and so one node
        sets = sets.join(left.select("node"), "node", "left_semi").dropDuplicates(["node"])
    sets = settle(sets, "sets")
    comp = set_links(sets, rule)

    # rows that share an id are one document: its nodes are linked too
    by_id = sizes.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("node").alias("a"), F.max("node").alias("b")).where("a != b")
    if not by_id.isEmpty():
        same = sizes.where("n > 0").join(by_id, "doc_id").select(
            F.col("a"), F.col("node").alias("b")).where("a != b")
        comp = components(settle(comp.select(F.col("node").alias("a"), F.col("comp").alias(
            "b")).unionByName(same), "same"))
    named = nodes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", F.col("node")))
    ids = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = settle(named.join(ids, "comp").select("node", "component_id"), "components")
    out = sizes.join(named.withColumnRenamed("node", "_node"),
                     (F.col("n") > 0) & (F.col("node") == F.col("_node")), "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias(
            "component_id"))


def page_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", **options,
) -> tuple[DataFrame, DataFrame]:
    """(docs as (row, n, id), groups): rows in one column ``row`` with a number ``n`` and an ``id``
    of their own (null flag, id, n), and near_groups() over these ids.

    Both read ``docs``, which must be stored so that rows keep their numbers.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       F.monotonically_increasing_id().alias("n"))
    given = F.col(f"row.{id_col}")
    rows = rows.withColumn("id", F.struct(given.isNull().alias("unnamed"), given.alias("id"), "n"))
    texts = rows.select("id", F.col(f"row.{text}").alias("text"))
    return rows, near_groups(texts, id_col="id", text="text", **options)


def keep_one(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", **options,
) -> DataFrame:
    """One row of each component of ``docs`` (a stored table): that of the smallest id, null last,
    and of rows that share it the one read first.  Columns stay as they are, whatever their names.

    Null and empty texts link with nothing and stay; repeated rows are copies, so one of them
    stays; very long texts are compared whole; no rows give no rows.
    """
    with passing(docs.sparkSession):
        rows, groups = page_groups(docs, id_col=id_col, text=text, **options)
        gone = settle(groups.where("doc_id != component_id").select("doc_id.n"), "gone")
    return rows.join(narrow(gone), "n", "left_anti").select("row.*")
