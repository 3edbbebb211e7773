"""Shards of near-equal bytes from indivisible groups, by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import settle
from .common import partitions, whole

N_SHARDS, TASK_GROUPS, SLOT_ROWS = 8, 100_000, 50_000
DRIVER_PARTS = 5_000  # partial partitions that the driver combines; more go through tasks first


def differencing(parts: list[list[int]], k: int) -> list[list[int]]:
    """Where each partial partition's ``k`` sums go: result[i][j] is the shard of parts[i][j].

    The two partial partitions with the largest spread are combined, the largest sums of one with
    the smallest of the other, until one is left.  Each step is kept as a node of a tree, and the
    shards are handed down from the last one.
    """
    heap, nodes = [], []
    for i, sums in enumerate(parts):
        order = sorted(range(k), key=lambda j: -sums[j])
        ranked = [sums[j] for j in order]
        nodes.append((None, None, order))
        heap.append((ranked[-1] - ranked[0], i, ranked))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        sums = [x[j] + y[k - 1 - j] for j in range(k)]
        order = sorted(range(k), key=lambda j: -sums[j])
        least = sums[order[-1]]
        ranked = [sums[j] - least for j in order]  # only differences matter
        nodes.append((a, b, order))
        heapq.heappush(heap, (-ranked[0], len(nodes) - 1, ranked))
    result: list[list[int]] = [[]] * len(parts)
    down = {heap[0][1]: list(range(k))} if heap else {}
    for at in range(len(nodes) - 1, -1, -1):
        a, b, order = nodes[at]
        shards = down.pop(at)
        places = [0] * k
        for rank, j in enumerate(order):
            places[j] = shards[rank]
        if a is None:
            result[at] = places
        else:
            down[a], down[b] = places, places[::-1]
    return result


def _task_shards(groups: DataFrame, k: int) -> DataFrame:
    """(group key, part, place): every part's groups in ``k`` places, part by part."""
    def spread(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "k1", "k2"], ascending=False)
        where = differencing([[b] + [0] * (k - 1) for b in pdf["bytes"].tolist()], k)
        return pdf[["k1", "k2", "part", "bytes"]].assign(place=[w[0] for w in where])

    return groups.groupBy("part").applyInPandas(
        spread, "k1 long, k2 long, part long, bytes long, place int")


def _joined(sums: dict[int, list[int]], k: int) -> list[tuple[int, int, int]]:
    """(part, place, shard) of partial partitions, combined."""
    parts = sorted(sums)
    final = differencing([sums[p] for p in parts], k)
    return [(p, j, s) for p, where in zip(parts, final) for j, s in enumerate(where)]


def _by_part(rows, k: int) -> dict[int, list[int]]:
    sums: dict[int, list[int]] = {}
    for part, place, b in rows:
        sums.setdefault(part, [0] * k)[place] = b
    return sums


def combined(sums: DataFrame, k: int, driver_parts: int = DRIVER_PARTS) -> DataFrame:
    """(part, place, shard) from (part, place, bytes), one row for each place of each part.

    Up to ``driver_parts`` parts are combined by the driver, ``k`` numbers each.  More are first
    combined by tasks, as many at a time, to fewer parts.
    """
    sums = settle(sums, "sums")
    n = sums.select("part").distinct().count()
    if n <= driver_parts:
        rows = _joined(_by_part(sums.select("part", "place", "bytes").collect(), k), k)
        return sums.sparkSession.createDataFrame(rows, "part long, place int, shard int")

    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = _joined(_by_part(pdf[["part", "place", "bytes"]].itertuples(index=False), k), k)
        out = pd.DataFrame(rows, columns=["part", "place", "up_place"])
        return out.merge(pdf, "left", on=["part", "place"]).fillna({"up": pdf["up"].iloc[0], "bytes": 0})

    up = sums.withColumn("up", F.pmod("part", F.lit(partitions(n, driver_parts))))
    up = settle(up.groupBy("up").applyInPandas(
        step, "part long, place int, bytes long, up long, up_place int"), "combined")
    higher = combined(up.groupBy(F.col("up").alias("part"), F.col("up_place").alias("place")).agg(
        F.sum("bytes").alias("bytes")), k, driver_parts)
    higher = higher.select(F.col("part").alias("up"), F.col("place").alias("up_place"), "shard")
    return up.join(higher, ["up", "up_place"]).select("part", "place", "shard")


def shard(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", n_shards: int = N_SHARDS,
    task_groups: int = TASK_GROUPS, slot_rows: int = SLOT_ROWS, driver_parts: int = DRIVER_PARTS,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    Equal texts form a group that stays together (128-bit text hashes).  Differencing runs in
    each task over about ``task_groups`` groups and gives one partial partition: ``n_shards``
    sums.  ``combined`` goes on with these alone, in the same way.  So tasks see a bounded number
    of groups, and the driver the sums of at most ``driver_parts`` partial partitions.  A group larger than a fair share takes a
    shard nearly to itself; nothing is split.

    Slots count from 0 within a shard: numbered in buckets of about ``slot_rows`` rows that start
    where the ones before end.  A null text has size 1, null ids and repeated rows are rows like
    any other, an empty table gives no rows.
    """
    body = whole(text)
    rows = settle(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(1), body).alias("k2"),
        F.monotonically_increasing_id().alias("row")), "sizes")
    n = rows.count()
    groups = rows.groupBy("k1", "k2").agg(F.sum("size").alias("bytes")).withColumn(
        "part", F.pmod(F.xxhash64("k2"), F.lit(partitions(n, task_groups))))
    placed = settle(_task_shards(groups, n_shards), "places")
    sums = placed.groupBy("part", "place").agg(F.sum("bytes").alias("bytes"))
    table = combined(sums, n_shards, driver_parts)
    of_group = placed.join(table, ["part", "place"]).select("k1", "k2", "shard")

    bucket = F.pmod(F.xxhash64("doc_id", "row"), F.lit(partitions(n, slot_rows)))
    rows = settle(rows.join(of_group, ["k1", "k2"]).withColumn("bucket", bucket), "sharded")
    starts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = starts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = W.partitionBy("shard", "bucket").orderBy("doc_id", "row")
    out = rows.withColumn("at", F.row_number().over(inside) - 1).join(starts, ["shard", "bucket"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("at")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
