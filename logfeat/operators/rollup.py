"""Per-entity statistics in one aggregation, with an exact way for hot entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions import count_digits, integer_div
from ..session import settle, settle_and_see
from .keys import stack
from .ordered import over_ordered
from .selection import (
    FULL, SPAN, packed_counts, packed_place, radix_points, running_counts, select_ranks)

STATS = ("mean", "std", "min", "median", "max", "10per", "25per", "75per", "90per")
_RANKED = {"10per": 0.10, "25per": 0.25, "median": 0.50, "75per": 0.75, "90per": 0.90}
GROUP_ROWS = 50_000
PART_ROWS = 1_000_000  # rows per task where small groups are counted
PACKED_WORDS = 256  # bigints of packed counts per group, for all columns together


def rollup_stats(
    df: DataFrame,
    by: str,
    cols: Sequence[str],
    stats: Sequence[str] = STATS,
    *,
    fill: float | None = None,
    extra: Sequence[Column] = (),
    source: DataFrame | None = None,
    group_rows: int = GROUP_ROWS,
    slices: int | None = None,
    radix: bool = False,
) -> DataFrame:
    """One row per ``by`` with ``<col>_<stat>`` for every column and statistic.

    All statistics skip nulls, except the interpolated percentiles: one null in
    the group makes them null (the median skips nulls too).  ``std`` divides by
    n - 1.  ``fill`` replaces nulls in the *result*; fill the input first where
    missing values should take part.  ``extra`` aggregates ride along.

    Mean, std, min and max combine before the shuffle.  Exact percentiles sort a
    group's values in one row, so groups of more than ``group_rows`` rows are
    taken out and ranked over the whole cluster instead; the result is the same.
    Groups are counted on ``source``, a cheaper DataFrame with the same rows per
    key, where one is given.

    ``radix=True`` finds the percentiles of all groups by radix selection: one way for every
    size, without lists or an order.  It takes more, smaller jobs and pays for logs whose
    groups are mostly large or whose shuffled lists would not fit the disks.  Columns of whole
    numbers less than SPAN apart need one level: groups of at most FULL rows count them in packed
    histograms, beside the other statistics.
    """
    source = df if source is None else source
    df = df.where(F.col(by).isNotNull())
    ranked = [s for s in stats if s in _RANKED]
    out = [f"{c}_{s}" for c in cols for s in stats]
    if ranked and radix:
        result = _radix_rollup(df, by, cols, stats, ranked, extra)
        return result.fillna(fill, subset=out) if fill is not None else result
    if ranked:
        sizes = source.where(F.col(by).isNotNull()).groupBy(by).count()
        hot = settle(sizes.where(F.col("count") > group_rows).select(by), "hot")
        if not hot.isEmpty():
            df = settle(df, "rollup")  # read three times below
            cold = _rollup(df.join(hot, by, "left_anti"), by, cols, stats, ranked, extra)
            large = df.join(hot, by, "left_semi")
            points = ranked_points(large, by, cols, [_RANKED[s] for s in ranked], slices=slices)
            result = cold.unionByName(_with_points(large, by, cols, stats, ranked, extra, points))
            return result.fillna(fill, subset=out) if fill is not None else result
    result = _rollup(df, by, cols, stats, ranked, extra)
    return result.fillna(fill, subset=out) if fill is not None else result


def _radix_rollup(df, by, cols, stats, ranked, extra) -> DataFrame:
    """rollup_stats() by radix selection: narrow columns of small groups in one level."""
    points = [_RANKED[s] for s in ranked]
    whole = [c for c in dict.fromkeys(cols) if isinstance(df.schema[c].dataType, IntegralType)]
    if not whole:
        df = settle(df, "rollup")
        return _with_points(df, by, cols, stats, ranked, extra, radix_points(df, by, cols, points))
    df, seen = settle_and_see(df, "rollup", rows=F.count(F.lit(1)), **{
        f"{end}{i}": of(F.col(f"`{c}`").cast("long"))
        for i, c in enumerate(whole) for end, of in (("low", F.min), ("high", F.max))})
    packed, words = {}, 0
    for i, c in enumerate(whole):
        low, high = seen[f"low{i}"], seen[f"high{i}"]
        if low is not None and high - low < SPAN:
            counts = packed_counts(f"`{c}`", low, high)
            if words + len(counts) <= PACKED_WORDS:
                packed[c], words = (low, counts), words + len(counts)
    if not packed:
        return _with_points(df, by, cols, stats, ranked, extra, radix_points(df, by, cols, points))
    large = settle(df.groupBy(by).count().where(F.col("count") > FULL).select(by), "large")
    small, rest = df, [c for c in cols if c not in packed]
    hot = not large.isEmpty()
    if hot:
        small = df.join(large, by, "left_anti")
    # narrow rows are shuffled, not their wide sums: a small group has few to combine before
    parts = -(-seen["rows"] // PART_ROWS)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = small.repartition(parts, by) if parts > least else small.repartition(by)
    result = _with_points(
        dealt, by, cols, stats, ranked, extra,
        radix_points(small, by, rest, points) if rest else None, packed)
    if hot:
        rows = df.join(large, by, "left_semi")
        result = result.unionByName(_with_points(
            rows, by, cols, stats, ranked, extra, radix_points(rows, by, cols, points)))
    return result


def _packed_points(sums: DataFrame, ranked: Sequence[str], packed: dict) -> DataFrame:
    """``sums`` with ``__<col>_<i>`` from the packed counts ``__w<k>_<j>`` of the k-th column."""
    shares = ", ".join(f"{_RANKED[s]}D" for s in ranked)
    found = []
    for k, (c, (low, counts)) in enumerate(packed.items()):
        at = f"((`__n_{c}` - 1) * p)"
        words = running_counts(f"array({', '.join(f'__w{k}_{j}' for j in range(len(counts)))})")
        ends = (f"transform(array(floor({at}), ceil({at})), r -> "
                f"CAST(({low}L) + {packed_place('w', 'r')} AS DOUBLE))")
        # arrays of one value stand for names, so that nothing is computed twice
        point = (f"transform(array({ends}), x -> CASE WHEN floor({at}) = ceil({at}) THEN x[0] ELSE "
                 f"(ceil({at}) - {at}) * x[0] + ({at} - floor({at})) * x[1] END)[0]")
        found.append(f"CASE WHEN `__n_{c}` > 0 THEN transform(array({words}), w -> "
                     f"transform(array({shares}), p -> {point}))[0] END AS __f{k}")
    kept = [f"`{c}`" for c in sums.columns if not c.startswith("__w")]
    values = [f"__f{k}[{i}] AS `__{c}_{i}`" for k, c in enumerate(packed) for i in range(len(ranked))]
    return sums.selectExpr(*kept, *found).selectExpr(*kept, *values)


def _with_points(df, by, cols, stats, ranked, extra, points, packed=None) -> DataFrame:
    """All statistics, where the percentiles come as a table of their own, or of packed counts."""
    plain = [s for s in stats if s not in _RANKED]
    seen = [F.count(c).alias(f"__n_{c}") for c in cols]
    packed = packed or {}
    words = [F.expr(w).alias(f"__w{k}_{j}") for k, (_, counts) in enumerate(packed.values())
             for j, w in enumerate(counts)]
    sums = _rollup(df, by, cols, plain, [], [F.count(F.lit(1)).alias("__n"), *seen, *words, *extra])
    both = _packed_points(sums, ranked, packed) if packed else sums
    if points is not None:
        both = both.join(points, by, "left")
    values = {}
    for c in cols:
        for i, s in enumerate(ranked):
            v = F.col(f"__{c}_{i}")
            values[f"{c}_{s}"] = v if s == "median" else F.when(
                F.col(f"__n_{c}") == F.col("__n"), v)
    riders = [c for c in sums.columns if c not in (
        "__n", by, *[f"__n_{c}" for c in cols], *[f"{c}_{s}" for c in cols for s in plain],
        *[f"__w{k}_{j}" for k, (_, counts) in enumerate(packed.values()) for j in range(len(counts))])]
    return both.withColumns(values).select(
        by, *[f"{c}_{s}" for c in cols for s in stats], *riders)


_PLAIN = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def _rollup(df, by, cols, stats, ranked, extra) -> DataFrame:
    """The wide aggregation as SQL text: one parsed list instead of hundreds of calls."""
    aggs, points, values = [], [], []
    for i, c in enumerate(cols):
        x = f"CAST(`{c}` AS DOUBLE)"
        aggs.append(f"count(`{c}`) AS n{i}")
        points.append(_points(i, [_RANKED[s] for s in ranked]))
        for s in stats:
            if s in _PLAIN:
                aggs.append(f"{_PLAIN[s]}({x}) AS {s}{i}")
                value = f"__s.{s}{i}"
            else:
                value = f"get(__p{i}, {ranked.index(s)})"
                if s != "median":
                    value = f"CASE WHEN __s.n{i} = __s.n THEN {value} END"
            values.append(f"{value} AS `{c}_{s}`")
    if ranked:
        row = ", ".join(f"CAST(`{c}` AS DOUBLE) AS x{i}" for i, c in enumerate(cols))
        aggs += ["count(*) AS n", f"collect_list(struct({row})) AS rows"]
    if not aggs:
        return df.groupBy(by).agg(*extra)
    wide = df.groupBy(by).agg(F.expr(f"struct({', '.join(aggs)})").alias("__s"), *extra)
    riders = [f"`{c}`" for c in wide.columns[2:]]
    if ranked:
        wide = wide.selectExpr("*", *[
            f"sort_array(__s.rows.x{i}) AS __a{i}" for i in range(len(cols))])
        wide = wide.selectExpr("*", *points)
    return wide.selectExpr(f"`{by}`", *values, *riders)


def _points(i: int, shares: Sequence[float]) -> str:
    """SQL for the interpolated percentiles of column i; its nulls sorted to the front."""
    at = f"((__s.n{i} - 1) * p)"

    def item(rank: str) -> str:
        return f"get(__a{i}, CAST(__s.n - __s.n{i} + {rank} AS INT))"

    low, high = item(f"floor({at})"), item(f"ceil({at})")
    return (f"CASE WHEN __s.n{i} > 0 THEN transform(array({', '.join(f'{p}D' for p in shares)}), "
            f"p -> CASE WHEN floor({at}) = ceil({at}) THEN {low} ELSE "
            f"(ceil({at}) - {at}) * {low} + ({at} - floor({at})) * {high} END) END AS __p{i}")


def ranked_points(
    df: DataFrame, by: str, cols: Sequence[str], points: Sequence[float],
    slices: int | None = None,
) -> DataFrame:
    """Exact interpolated percentiles ``__<col>_<i>`` of non-null values, without group maps.

    Equal values are counted before the shuffle; running counts over slices of
    the (group, column, value) order then place each percentile.
    """
    pairs = ", ".join(f"{i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    counts = settle(
        df.selectExpr(f"`{by}`", f"stack({len(cols)}, {pairs}) AS (c, v)")
        .where("v IS NOT NULL").groupBy(by, "c", "v").agg(F.count(F.lit(1)).alias("n")),
        "counts",
    )
    running = over_ordered(counts, [by, "c"], ["v"], before={"lo": "n"}, slices=slices)
    totals = counts.groupBy(by, "c").agg((F.sum("n") - 1).alias("last"))
    placed = running.join(totals, [by, "c"])

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("lo") <= rank) & (rank < F.col("lo") + F.col("n")), F.col("v")))

    aggs = []
    for i, p in enumerate(points):
        at = F.col("last") * F.lit(p)
        aggs += [value_at(F.floor(at)).alias(f"f{i}"), value_at(F.ceil(at)).alias(f"c{i}")]
    per_col = placed.groupBy(by, "c", "last").agg(*aggs)
    spread = []
    for j, c in enumerate(cols):
        for i, p in enumerate(points):
            at, low, high = F.col("last") * F.lit(p), F.col(f"f{i}"), F.col(f"c{i}")
            v = F.when(F.floor(at) == F.ceil(at), low).otherwise(
                (F.ceil(at) - at) * low + (at - F.floor(at)) * high)
            spread.append(F.max(F.when(F.col("c") == j, v)).alias(f"__{c}_{i}"))
    return per_col.groupBy(by).agg(*spread)


def entity_counts(
    log: DataFrame, entity: str = "entity", actor: str = "actor", product: str = "product",
    approximate: bool = False,
) -> DataFrame:
    """Rows, distinct actors and products, characters and digit shares per entity.

    Distinct values are reduced to (entity, value) pairs before they are counted,
    so no task holds the values of a hot entity.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    return log.where(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_rows"),
        count(actor).alias("n_actors"),
        count(product).alias("n_products"),
        *char_totals(actor, product),
    )


SKETCH_LG = 12  # 2^12 registers: a standard error of about 1.6 %, small counts are exact


def entity_sketches(
    log: DataFrame, entity: str = "entity", actor: str = "actor", product: str = "product",
) -> DataFrame:
    """(entity, n_rows, actors, products): mergeable states for distinct counts of a log part."""
    return log.where(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("entity")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(actor, SKETCH_LG).alias("actors"),
        F.hll_sketch_agg(product, SKETCH_LG).alias("products"))


def unite_sketches(parts: Sequence[DataFrame]) -> DataFrame:
    """entity_sketches() of a log from the stored ones of its parts, whose rows are not read again."""
    return stack(parts).groupBy("entity").agg(
        F.sum("n_rows").alias("n_rows"), F.hll_union_agg("actors").alias("actors"),
        F.hll_union_agg("products").alias("products"))


def sketch_counts(sketches: DataFrame) -> DataFrame:
    """(entity, n_rows, n_actors, n_products) with estimated distinct counts."""
    return sketches.select("entity", "n_rows", *[
        F.hll_sketch_estimate(c).alias(f"n_{c}") for c in ("actors", "products")])


def char_totals(actor: str = "actor", product: str = "product") -> list[Column]:
    aggs = []
    for c, name in ((actor, "actor"), (product, "product")):
        chars = F.sum(F.length(c))
        aggs.append(chars.alias(f"{name}_chars"))
        aggs.append(
            (F.sum(count_digits(c)) / F.nullif(chars, F.lit(0))).alias(f"{name}_digit_share"))
    return aggs


def recency(
    log: DataFrame, entity: str = "entity", us: str = "us", tie: Sequence[str] = ("rid",),
    slices: int | None = None, radix: bool = False,
) -> DataFrame:
    """Seconds from an entity's rows to the latest row of the whole log.

    ``age_min`` belongs to the earliest row and so is the largest; the
    percentiles pick the row at position floor((n - 1) * p / 100).  The latest time is seen
    while the log's times are stored.

    ``radix=True`` finds the five positions by radix selection instead of numbering the log.
    """
    if radix:
        return _radix_recency(log, entity, us)
    narrow, seen = settle_and_see(log.select(entity, us, *tie), "times", latest=F.max(us))
    placed = over_ordered(narrow, [entity], [us, *tie], index="at", size="n", slices=slices)
    return with_ages(placed.where(F.col(entity).isNotNull()).groupBy(entity).agg(
        *age_points(us)), seen["latest"])


def _radix_recency(log: DataFrame, entity: str, us: str) -> DataFrame:
    """recency() from the times and their numbers; null times come first, as in an order."""
    counted = log.groupBy(F.col(entity).alias("entity"), F.col(us).alias("key")).agg(
        F.count(F.lit(1)).alias("n"))
    cells, seen = settle_and_see(counted, "times", latest=F.max("key"))
    cells = cells.where("entity IS NOT NULL")
    ends = settle(cells.groupBy("entity").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))),
                                          F.lit(0)).alias("nulls"),
        F.min("key").alias("__us_min"), F.max("key").alias("__us_max")), "ends")
    shares = [(name, p) for name, p in AGES.items() if p is not None]
    rank = {name: integer_div((F.col("n") - 1) * p, 100) - F.col("nulls") for name, p in shares}
    wanted = ends.select("entity", F.explode(F.array(*rank.values())).alias("r")).where("r >= 0")
    found = select_ranks(cells.where("key IS NOT NULL"), wanted, ["entity"])
    picked = ends.join(found, "entity", "left").groupBy(
        "entity", "n", "nulls", "__us_min", "__us_max").agg(*[
            F.max(F.when(F.col("r") == rank[name], F.col("key"))).alias(f"__us_{name}")
            for name, _ in shares])
    return with_ages(picked.drop("n", "nulls").withColumnRenamed("entity", entity), seen["latest"])


AGES = {"min": None, "10per": 10, "25per": 25, "median": 50, "75per": 75, "90per": 90, "max": None}


def age_points(us: str = "us", at: str = "at", n: str = "n") -> list[Column]:
    """Aggregates that pick the timestamps with_ages() needs; combine before the shuffle."""
    aggs = [F.min(us).alias("__us_min"), F.max(us).alias("__us_max")]
    for name, p in AGES.items():
        if p is not None:
            rank = integer_div((F.col(n) - 1) * p, 100)
            aggs.append(F.max(F.when(F.col(at) == rank, F.col(us))).alias(f"__us_{name}"))
    return aggs


def with_ages(df: DataFrame, latest: int) -> DataFrame:
    """Turn the picked timestamps into ages in seconds."""
    rest = [c for c in df.columns if not c.startswith("__us_")]
    age = {name: (F.lit(latest) - F.col(f"__us_{name}")) / F.lit(1e6) for name in AGES}
    return df.select(
        *rest,
        *[a.alias(f"age_{name}") for name, a in age.items()],
        (age["min"] - age["max"]).alias("age_range"),
    )
