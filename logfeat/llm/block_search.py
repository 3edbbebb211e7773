"""Nearest vectors by inner product: int8 tiles with error bounds, then exact products of the rest."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import partitions

TOP = 20
BLOCK = 65_536  # about so many queries are held by a task, some 20 MB at 64 dimensions
LANE, LEAST_LANE = 1 << 22, 512  # candidates that a task reads: at most, and fewer for more cores
TILE = 1 << 21  # products of a tile that are held at a time
EXACT_DIMS = 1_040  # 127 * 127 * this < 2**24: float32 adds such integer products exactly


# -- one vector

def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 rows, scales, lengths of the int8 rows in true units, lengths of what they miss)."""
    x = x.astype(np.float64)
    scale = np.maximum(np.abs(x).max(axis=1), np.finfo(np.float64).tiny * 127) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    kept = q * scale[:, None]
    return q, scale, np.sqrt((kept * kept).sum(axis=1)), np.sqrt(((x - kept) ** 2).sum(axis=1))


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no component null or not finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


_ROW = ("row long, id long, asks boolean, dims int, q binary, scale double, length double, "
        "missed double, v binary")


def _quantised(rows: DataFrame, kind: str) -> DataFrame:
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            row, ids, vectors, asks = (batch.column(i) for i in range(4))
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            for n in np.unique(sizes):  # most tables have one width
                at = np.flatnonzero(sizes == n)
                x = flat[starts[at][:, None] + np.arange(n)]
                q, scale, length, missed = quantise(x)
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(at)) for c in (row, ids, asks)),
                     pa.array(np.full(len(at), n, np.int32)), pa.array([r.tobytes() for r in q]),
                     pa.array(scale), pa.array(length), pa.array(missed),
                     pa.array([r.tobytes() for r in x])],
                    names=["row", "id", "asks", "dims", "q", "scale", "length", "missed", "v"])

    return rows.mapInArrow(batches, _ROW)


# -- one pair of blocks

class _Block:
    """Distinct vectors of one side; ``members[i]`` are the positions of rows that have vector i."""

    def __init__(self, table: pa.Table, kind: str, most: int | None):
        table = table.combine_chunks()
        dims = table.column("dims")[0].as_py()

        def matrix(name: str, dtype) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype).reshape(-1, dims)

        self.row, ids = table.column("row").to_numpy(), table.column("id")
        self.null, self.id = ids.is_null().to_numpy(), ids.fill_null(0).to_numpy()
        raw = matrix("v", kind)
        order = np.lexsort((self.row, self.id, self.null))
        _, first, which = np.unique(np.ascontiguousarray(raw[order]).view(
            np.dtype((np.void, raw.dtype.itemsize * dims))).ravel(), return_index=True, return_inverse=True)
        self.members: list[np.ndarray] = []
        by = np.argsort(which, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(which[by])) + 1):
            self.members.append(order[part[:most]])
        at = order[first]
        self.v = raw[at].astype(np.float64)
        self.q = matrix("q", np.int8)[at]
        self.scale, self.length, self.missed = (
            table.column(c).to_numpy()[at] for c in ("scale", "length", "missed"))


def _tile(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of int8 rows, exact: float32 sums stay below 2**24."""
    out = np.zeros((len(a), len(b)))
    for lo in range(0, a.shape[1], EXACT_DIMS):
        part = slice(lo, lo + EXACT_DIMS)
        out += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of paired rows, added in the order of the components."""
    return np.add.reduce(np.ascontiguousarray((a * b).T), axis=0)


class _Search:
    """A block of queries with a heap each; blocks of candidates come one after the other."""

    def __init__(self, queries: _Block, kind: str, top: int):
        self.queries, self.kind, self.most = queries, kind, top + 1  # a query's own row may be in it
        self.heaps: list[list] = [[] for _ in queries.v]
        self.bar = np.full(len(queries.v), -np.inf)  # the worst score of a full heap

    def add(self, table: pa.Table) -> None:
        queries, cands = self.queries, _Block(table, self.kind, self.most)
        counts = np.array([len(m) for m in cands.members])
        owner = np.repeat(np.arange(len(counts)), counts)
        height = max(1, TILE // len(owner))
        for lo in range(0, len(queries.v), height):
            part = slice(lo, lo + height)
            near = _tile(queries.q[part], cands.q) * queries.scale[part, None] * cands.scale
            # |xy - x'y'| <= |x'||dy| + |dx||y'| + |dx||dy|, and a little for rounding
            off = queries.length[part, None] * cands.missed + queries.missed[part, None] * (
                cands.length + cands.missed)
            off += 1e-12 * (queries.length[part, None] * cands.length + off)
            bar = self.bar[part]
            if len(owner) > self.most:
                low = (near - off)[:, owner]
                bar = np.maximum(bar, np.partition(low, -self.most, axis=1)[:, -self.most])
            at, c = np.nonzero(near + off >= bar[:, None])
            self._offer(cands, lo + at, c, _exact(queries.v[lo + at], cands.v[c]))

    def _offer(self, cands: _Block, at: np.ndarray, c: np.ndarray, scores: np.ndarray) -> None:
        for q, i, score in zip(at.tolist(), c.tolist(), scores.tolist()):
            heap = self.heaps[q]
            for m in cands.members[i]:
                # the heap's first is the worst: lowest score, then null or largest id
                item = (score, not cands.null[m], -int(cands.id[m]), -int(cands.row[m]))
                if len(heap) < self.most:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
            if len(heap) == self.most:
                self.bar[q] = heap[0][0]

    def found(self) -> pa.RecordBatch:
        rows = []
        for heap, members in zip(self.heaps, self.queries.members):
            best = sorted(heap, reverse=True)
            for m in members:
                row, own = int(self.queries.row[m]), None if self.queries.null[m] else int(self.queries.id[m])
                others = [x for x in best if -x[3] != row][:self.most - 1]
                rows += [(row, own, -vec if known else None, -at, score)
                         for score, known, vec, at in others]
        columns = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, _FOUND.types)], schema=_FOUND)


_FOUND = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                    ("vec_row", pa.int64()), ("score", pa.float64())])
_CELL = ["dims", "line", "lane"]


def _search(kind: str, top: int):
    """Reads rows sorted by cell, the queries of a cell before its candidates."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, search = None, [], None
        for batch in it:
            table = pa.Table.from_batches([batch])
            keys = np.stack([table.column(c).to_numpy() for c in (*_CELL, "role")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)]):
                if lo == hi:
                    continue
                *here, role = keys[lo].tolist()
                if here != cell:
                    if search is not None:
                        yield search.found()
                    cell, held, search = here, [], None
                if role == 0:
                    held.append(table.slice(lo, hi - lo))
                elif held:
                    if search is None:
                        search = _Search(_Block(pa.concat_tables(held), kind, None), kind, top)
                    search.add(table.slice(lo, hi - lo))
        if search is not None:
            yield search.found()

    return batches


# -- merging

def _merged(partial: DataFrame, top: int) -> DataFrame:
    """The best ``top`` of each query's partial lists: a heap of that size per query of a task."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple, list] = {}
        for batch in it:
            for row, query, vec, vec_row, score in zip(*(c.to_pylist() for c in batch.columns)):
                # the heap's first is the worst: lowest score, then null or largest id
                item = (score, vec is not None, -(vec or 0), -vec_row)
                heap = heaps.setdefault((row, query), [])
                if len(heap) < top:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
        rows = [(query, rank, -vec if known else None, score)
                for (_, query), heap in heaps.items()
                for rank, (score, known, vec, _) in enumerate(sorted(heap, reverse=True), 1)]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()))],
            names=["query_id", "rank", "vec_id", "score"])

    return partial.repartition("row").mapInArrow(
        batches, "query_id long, rank int, vec_id long, score double")


def nearest(
    vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector: str = "embedding",
    top: int = TOP, block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with ``is_query`` the ``top`` rows of largest
    inner product, nearest first, ties to the smaller id; all, if there are fewer.

    Queries are dealt into blocks of about ``block`` rows and candidates into lanes; a task holds
    one block and reads one lane, Arrow batch by batch.  Products of int8 rows, with a bound of
    their error, leave few candidates per query; those are computed from the originals in double
    precision and go into the query's heap, so the result is exact.  A candidate travels once per
    block of queries, a query once per lane, and a query has ``top`` partial results per lane.

    Vectors that are null, all zero, or hold a null or a value that is not finite take no part;
    vectors of different length do not meet.  Ids are integers; a null id is larger than all
    others.  Rows that repeat an id are rows of their own: only a query's own row is left out.
    No rows give no rows; other columns do not matter.
    """
    single = "array<float>" in vectors.schema[vector].dataType.simpleString()
    kind = "<f4" if single else "<f8"
    item = "array<float>" if single else "array<double>"
    given = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.col(vector).cast(item).alias("v")).where(usable(F.col("v")))
    numbered = given.withColumn("row", F.monotonically_increasing_id())
    stored = settle(numbered.select("row", "id", "v", "asks"), "vectors")  # rows keep their numbers
    n, n_queries = stored.count(), stored.where("asks").count()
    rows = settle(_quantised(stored, kind), "quantised")
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    lines = partitions(n_queries, block)
    lanes = max(partitions(n, LANE), min(-(-2 * cores // lines), partitions(n, LEAST_LANE)))

    def dealt(side: DataFrame, role: int, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return side.drop("asks").withColumns({
            "role": F.lit(role), own: F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int"),
            other: F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))})

    both = dealt(rows.where("asks"), 0, "line", lines, "lane", lanes).unionByName(
        dealt(rows, 1, "lane", lanes, "line", lines))
    partial = both.repartition(*_CELL).sortWithinPartitions(*_CELL, "role").mapInArrow(
        _search(kind, top), "row long, query_id long, vec_id long, vec_row long, score double")
    return _merged(partial, top)
