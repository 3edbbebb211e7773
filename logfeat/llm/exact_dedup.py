"""Exact duplicates of incoming batches against immutable snapshots, screened by filters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.screens import screened_known
from ..session import settle
from . import common
from .common import partitions, whole

FILTER_KEYS, LEAST_KEYS = 200_000, 1_000  # digests in a filter, and fewer for more cores
N_BATCHES = 3


# -- binary fuse filters (three positions in consecutive segments, 16-bit fingerprints)

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Splitmix finaliser of 64-bit keys."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _places(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (n, 3) and fingerprints of the keys."""
    x = _mix(keys, seed)
    first = (x % np.uint64(segments)).astype(np.int64)
    y = _mix(x, seed + 1)
    within = [((y >> np.uint64(21 * k)) % np.uint64(length)).astype(np.int64) for k in range(3)]
    places = np.stack([(first + k) * length + within[k] for k in range(3)], axis=1)
    return places, (_mix(x, seed + 2) & np.uint64(0xFFFF)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) that answer yes for all ``keys``.

    Peeling goes in rounds over whole arrays: all positions that one key alone still uses give
    up that key; fingerprints are then set round by round backwards.  A round's keys do not
    touch each other's positions, so a round is one array operation.
    """
    keys = np.unique(keys)
    n = len(keys)
    length = max(4, 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    room = int(max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2))) * n) + 1
    segments = max(1, -(-room // length) - 2)
    for seed in range(1, 1_000_000):
        if seed % 20 == 0:
            segments += 1 + segments // 20
        places, prints = _places(keys, seed, length, segments)
        size = (segments + 2) * length
        uses = np.bincount(places.ravel(), minlength=size)
        which = np.zeros(size, np.int64)
        for k in range(3):
            np.bitwise_xor.at(which, places[:, k], np.arange(n))
        rounds, left = [], n
        alone = np.flatnonzero(uses == 1)
        while len(alone):
            taken, at = np.unique(which[alone], return_index=True)
            rounds.append((taken, alone[at]))
            left -= len(taken)
            touched = places[taken]
            np.subtract.at(uses, touched.ravel(), 1)
            np.bitwise_xor.at(which, touched.ravel(), np.repeat(taken, 3))
            near = np.unique(touched)
            alone = near[uses[near] == 1]
        if left == 0:
            table = np.zeros(size, np.uint16)
            for taken, at in reversed(rounds):
                three = places[taken]
                others = np.bitwise_xor.reduce(table[three], axis=1) ^ table[at]
                table[at] = prints[taken] ^ others
            return seed, length, segments, table.tobytes()
    raise ValueError("no filter found")


def in_filter(keys: np.ndarray, seed: int, length: int, segments: int, table: bytes) -> np.ndarray:
    places, prints = _places(keys, seed, length, segments)
    stored = np.frombuffer(table, np.uint16)
    return np.bitwise_xor.reduce(stored[places], axis=1) == prints


# -- Spark side

_FILTER = "snapshot int, bucket long, seed long, length long, segments long, prints binary"


def _digests(pdf: pd.DataFrame) -> np.ndarray:
    return pdf["digest"].to_numpy(np.int64).view(np.uint64)


def snapshot_filters(groups: DataFrame) -> DataFrame:
    """One static filter per snapshot and bucket of ``groups`` (batch, bucket, digest, ...)."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, length, segments, prints = build_filter(_digests(pdf))
        return pd.DataFrame({
            "snapshot": pdf["batch"].iloc[:1], "bucket": pdf["bucket"].iloc[:1], "seed": seed,
            "length": length, "segments": segments, "prints": [prints]})

    return groups.select("batch", "bucket", "digest").groupBy("batch", "bucket").applyInPandas(
        build, _FILTER)


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """Rows (snapshot, bucket, digest, text_sha, bytes, batch) whose digest a filter lets pass."""
    cols = ["snapshot", "bucket", "digest", "text_sha", "bytes", "batch"]

    def passes(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or held.empty:
            return rows[cols].iloc[:0]
        f = held.iloc[0]
        return rows[cols][in_filter(_digests(rows), f.seed, f.length, f.segments, f.prints)]

    keys = ["snapshot", "bucket"]
    return incoming.groupBy(*keys).cogroup(filters.groupBy(*keys)).applyInPandas(
        passes, "snapshot int, bucket long, digest long, text_sha binary, bytes long, batch int")


def texts_of(texts: DataFrame, digests: DataFrame) -> DataFrame:
    """The distinct (batch, digest, body) of ``texts`` with one of the stored ``digests``.

    A short list travels to the texts.  Of a longer one a bitmap does, as far as one can be made;
    what it lets pass is made distinct in the tasks before it is shuffled, so that a text that a
    third of all rows have is one row of each task.
    """
    if digests.count() <= common.BROADCAST_ROWS:
        return texts.join(F.broadcast(digests), "digest", "left_semi").distinct()
    return screened_known(texts.distinct(), digests, ["digest"])


def same_bytes(texts: DataFrame, found: DataFrame) -> DataFrame:
    """The distinct (digest, text_sha, bytes) of bodies that a batch shares with a snapshot.

    ``found`` has the positives (snapshot, batch, digest) that are in the snapshot's exact bucket.
    Only their texts are read again and shuffled; bodies join by all their bytes.
    """
    found = settle(found.select("snapshot", "batch", "digest").distinct(), "found")
    held = settle(texts_of(texts, settle(found.select("digest").distinct(), "positives")), "bodies")
    new = found.join(held, ["batch", "digest"])
    old = held.withColumnRenamed("batch", "snapshot")
    agreed = new.join(old, ["snapshot", "digest", "body"]).select("digest", "body").distinct()
    return agreed.select("digest", F.unhex(F.sha2("body", 256)).alias("text_sha"),
                         F.octet_length("body").cast("long").alias("bytes"))


def exact_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", n_batches: int = N_BATCHES,
    batch=None, filter_keys: int = FILTER_KEYS, check_bytes: bool = True,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs`` (a stored table).

    The rows come in batches (``batch``: an integer column from 0, null as 0; by default a hash of
    the id).
    Of each batch equal digests are grouped among themselves first, whatever came earlier; what
    is left, one row per text, is the batch's immutable snapshot.  Each snapshot has static
    binary fuse filters over 64-bit digests; a later batch asks the filters of all earlier ones,
    and only what they let pass joins the snapshot's exact bucket by digest, length and SHA-256;
    then the texts of what is found there are read, and all their bytes must agree.  Texts that no
    other batch has are done without these joins.  Inside a batch digest, length and SHA-256
    decide; with ``check_bytes=False`` they do everywhere.

    The row with the largest id stays (of rows with the same id and text, the one read last).
    Null texts are empty texts; a null id is below all others.  No rows give no rows, other
    columns do not matter.
    """
    body = whole(text)
    of = F.pmod(F.xxhash64(F.lit("batch"), F.col(id_col)), F.lit(n_batches)).cast("int")
    of = (of if batch is None else F.coalesce(batch, F.lit(0)).cast("int")).alias("batch")
    digest = F.xxhash64(body).alias("digest")
    rows = settle(docs.select(
        F.col(id_col).alias("doc_id"), of, digest, F.unhex(F.sha2(body, 256)).alias("text_sha"),
        F.octet_length(body).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row")), "digests")
    n, cores = rows.count(), docs.sparkSession.sparkContext.defaultParallelism
    buckets = max(partitions(n, filter_keys), min(2 * cores, partitions(n, LEAST_KEYS)))
    groups = settle(rows.groupBy("batch", "digest", "text_sha", "bytes").agg(
        F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("n")).withColumn(
        "bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets))), "snapshots")
    filters = settle(snapshot_filters(groups), "filters")

    incoming = groups.where("batch > 0").withColumn(
        "snapshot", F.explode(F.sequence(F.lit(0), F.col("batch") - 1)))
    passed = screen(incoming, filters)
    bucket = groups.select(F.col("batch").alias("snapshot"), "digest", "text_sha", "bytes")
    key = ["digest", "text_sha", "bytes"]
    found = passed.join(bucket, ["snapshot", *key])
    shared = settle(same_bytes(docs.select(of, digest, body.alias("body")), found) if check_bytes
                    else found.select(*key).distinct(), "shared")
    merged = groups.join(shared, key, "left_semi").groupBy(*key).agg(
        F.max("last").alias("all_last"), F.sum("n").alias("all_n"))
    final = groups.join(merged, key, "left").select(
        "batch", *key, F.coalesce("all_last", "last").alias("last"),
        F.coalesce("all_n", "n").alias("n"))
    out = rows.join(final, ["batch", *key])
    return out.select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("last.row")).alias("kept"),
        F.lower(F.hex("text_sha")).alias("text_sha256"))


def drop_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", **options,
) -> DataFrame:
    """The rows of ``docs`` (a stored table) that stay, one per text, with their columns.

    The row with the largest id stays, null below all others, and of rows that share it the one
    read last.  Null texts are empty texts; columns may have any names.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       F.monotonically_increasing_id().alias("n"))
    given = F.col(f"row.{id_col}")
    own = F.struct(given.isNotNull().alias("named"), given.alias("id"), "n")
    keyed = rows.select(own.alias("id"), F.col(f"row.{text}").alias("text"))
    gone = exact_groups(keyed, id_col="id", text="text", **options).where("NOT kept")
    return rows.join(gone.select("doc_id.n"), "n", "left_anti").select("row.*")
