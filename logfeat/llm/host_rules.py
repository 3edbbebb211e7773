"""Quality rules with verdicts on whole hosts, as DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import WHITE, has_word, let, whole, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
# a document fails beyond these; hosts are rejected beyond a shrunken failure rate of MAX_RATE
MIN_WORDS, MAX_REPEATED, MAX_SYMBOLS, MAX_DUP_LINES, MAX_RATE = 10, 0.2, 0.3, 0.3, 0.5


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: sort the windows, look at both neighbours."""
    def twice(s: Column) -> Column:
        at = F.filter(F.transform(s, lambda x, k: F.when(
            (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["p"])),
            lambda p: p.isNotNull())
        return let(F.array_sort(at), lambda p: F.aggregate(
            F.transform(p, lambda v, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - v, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x))

    return let(F.array_sort(F.transform(
        windows, lambda x, k: F.struct(x.alias("h"), k.alias("p")))), twice)


def repeated_words(w: Column) -> Column:
    """Words inside 5-word windows that the text has twice or more, first ones included."""
    n = F.size(w)
    windows = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))
    some = let(windows, lambda g: F.when(
        F.size(F.array_distinct(g)) < F.size(g), _covered(g)).otherwise(0))
    return F.when(n > WINDOW, some).otherwise(0)


def text_counts(text: Column) -> Column:
    """Struct of the counts that the rules use."""
    seen = F.filter(F.split(text, "\n"), has_word)
    counts = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        repeated_words(w).cast("long").alias("n_repeat_words")))
    lines = let(seen, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return let(counts, lambda c: F.struct(
        c["n_words"].alias("n_words"),
        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.when(F.instr(text, "\n") == 0, 0).otherwise(lines).cast("long").alias("n_dup_lines"),
        c["n_repeat_words"].alias("n_repeat_words")))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > int(100 * MAX_REPEATED) * F.col("n_words"))


def rule_failed() -> Column:
    """A base rule, or one of the method's own: many symbols, or many repeated lines by words."""
    return base_failed() | (F.col("n_symbols") > MAX_SYMBOLS * F.col("n_words")) | (
        F.col("n_dup_lines") * 10 > F.col("n_words") * MAX_DUP_LINES)


def host_rates(rows: DataFrame) -> DataFrame:
    """(host, n, failed, rate, rejected) from rows (host, failed boolean).

    The prior is a beta distribution with the mean and the variance between hosts of the failure
    rates (moments, less the binomial part); its strength lies in 1 to a million documents.  The
    rate of a host is its posterior mean.
    """
    hosts = settle(rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("failed").alias("failed")), "hosts")
    m = hosts.agg(
        F.coalesce(F.sum("failed") / F.sum("n"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.sum("n"), F.lit(1)).alias("n"), F.count(F.lit(1)).alias("hosts")).first()
    mean, spread = float(m["mean"]), hosts.agg(F.coalesce(F.sum(
        F.col("n") * F.pow(F.col("failed") / F.col("n") - float(m["mean"]), 2)),
        F.lit(0.0)) / float(m["n"])).first()[0]
    between = max(spread - mean * (1 - mean) * m["hosts"] / m["n"], 1e-9)
    strength = min(max(mean * (1 - mean) / between - 1, 1.0), 1e6)
    rate = (F.col("failed") + mean * strength) / (F.col("n") + strength)
    return hosts.select("host", "n", "failed", rate.alias("rate"),
                        (rate > MAX_RATE).alias("rejected"))


def _counted(docs: DataFrame, id_col: str, text: str, host: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(host).alias("host"),
                       text_counts(whole(text)).alias("c")).select("doc_id", "host", "c.*")


def judge(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", host: str = "source",
) -> DataFrame:
    """Counts, ``base_failed``, ``host_rate`` and ``kept`` for every row of ``docs``.

    A document is kept if it passes all rules and its host is not rejected.  A null text counts
    as empty (and fails), a null host is a host of its own, repeated rows count as often as they
    occur, an empty table gives no rows.  Windows are compared by 64-bit hashes of their words.
    """
    rows = settle(_counted(docs, id_col, text, host), "counts")
    hosts = host_rates(rows.select("host", rule_failed().alias("failed")))
    hosts = hosts.select(F.col("host").alias("_host"), "rate", "rejected")
    out = rows.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), F.col("rate").alias("host_rate"),
        (~rule_failed() & ~F.col("rejected")).alias("kept"))


def keep_good(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", host: str = "source",
) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns."""
    counted = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
                          F.col(host).alias("_host"), text_counts(whole(text)).alias("_c"))
    rows = counted.select("_row", "_host", "_c.*").select("_row", "_host", rule_failed().alias(
        "failed"))
    stored = settle(rows, "judged")
    bad = host_rates(stored.select(F.col("_host").alias("host"), "failed")).where("rejected")
    good = stored.where("NOT failed").join(
        bad, F.col("_host").eqNullSafe(F.col("host")), "left_anti")
    return good.select("_row.*")
