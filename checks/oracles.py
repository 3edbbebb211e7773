"""SQL for DuckDB, written apart from the operators: plain joins and windows."""

from __future__ import annotations

from .standins import DIMS, MODELS


def rd(e: str, n: int = 6) -> str:
    # adding 0 turns a rounded -0 into 0
    return f"(round(CAST({e} AS DOUBLE), {n}) + 0.0::DOUBLE)"


def big(e: str) -> str:
    return f"CAST({e} AS BIGINT)"


EVENTS = """ev AS (
  SELECT CAST(user_id AS VARCHAR) AS entity, json_extract_string(props, '$.k') AS actor,
         event_type AS product, epoch_us(ts) AS us, ts, event_id AS rid
  FROM events),
users AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS entity,
         CASE WHEN user_id % 10 <> 9 THEN CAST(user_id % 3 = 0 AS INT)::DOUBLE END AS target
  FROM events),
en AS (
  SELECT entity, target, CASE WHEN target IS NOT NULL THEN
         ntile(10) OVER (PARTITION BY target ORDER BY entity) - 1 END AS fold
  FROM users),
lf AS (SELECT ev.*, target, fold FROM ev LEFT JOIN en USING (entity))"""

LINES = """ln AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS entity, CAST(l_suppkey AS VARCHAR) AS actor,
         l_returnflag AS product, epoch_us(l_shipdate) AS us, l_orderkey, l_linenumber,
         l_partkey, l_suppkey
  FROM lineitem),
ords AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS entity,
         CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE
              WHEN o_orderstatus <> 'P' THEN 0.0::DOUBLE END AS target
  FROM orders),
oe AS (
  SELECT entity, target, CASE WHEN target IS NOT NULL THEN
         ntile(10) OVER (PARTITION BY target ORDER BY entity) - 1 END AS fold
  FROM ords)"""

TIE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

DOCS = """doc_labels AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS entity, coalesce(CAST(quality AS DOUBLE), 0.5) AS raw
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
cleaned AS (
  SELECT entity, CASE WHEN raw = 0.5 THEN NULL ELSE raw END AS target FROM doc_labels
  WHERE NOT EXISTS (SELECT 1 FROM labels t
                    WHERE t.toxic = 1 AND CAST(t.doc_id AS VARCHAR) = doc_labels.entity))"""

WORDS = """words AS (
  SELECT CAST(doc_id AS VARCHAR) AS entity, unnest(string_split(text, ' ')) AS token,
         unnest(range(len(string_split(text, ' ')))) AS place
  FROM documents)"""

_POINTS = {"10per": 0.10, "25per": 0.25, "75per": 0.75, "90per": 0.90}


def nine(c: str, fill: str | None = None, digits: dict | None = None) -> list[str]:
    """The nine statistics of one column as select items."""
    digits = digits or {}
    x = f"CAST({c} AS DOUBLE)"
    parts = {
        "mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})",
        "median": f"quantile_cont({x}, 0.5)", "max": f"max({x})",
        **{s: f"CASE WHEN count({c}) = count(*) THEN quantile_cont({x}, {p}) END"
           for s, p in _POINTS.items()},
    }
    out = []
    for s, e in parts.items():
        e = f"coalesce({e}, {fill})" if fill else e
        out.append(f"{rd(e, digits.get(s, 6))} AS {c}_{s}")
    return out


def other_folds(key: str, src: str = "lf") -> str:
    """Statistics of each (key, fold) from a join with the rows of the other folds."""
    return f"""
  SELECT p.{key}, p.fold, avg(o.target) AS {key}_mean, stddev_samp(o.target) AS {key}_std,
         sum(o.target) AS {key}_sum
  FROM (SELECT DISTINCT {key}, fold FROM {src} WHERE {key} IS NOT NULL) p
  JOIN (SELECT {key}, fold, target FROM {src} WHERE fold IS NOT NULL) o
    ON o.{key} = p.{key} AND (p.fold IS NULL OR o.fold <> p.fold)
  GROUP BY p.{key}, p.fold"""


def attached(src: str = "lf") -> str:
    return f"""act AS ({other_folds('actor', src)}),
prd AS ({other_folds('product', src)}),
enc AS (
  SELECT l.*, a.actor_mean, a.actor_std, a.actor_sum, p.product_mean, p.product_std, p.product_sum
  FROM {src} l
  LEFT JOIN act a ON a.actor = l.actor AND a.fold IS NOT DISTINCT FROM l.fold
  LEFT JOIN prd p ON p.product = l.product AND p.fold IS NOT DISTINCT FROM l.fold)"""


TARGET_COLS = [f"{k}_{s}" for k in ("actor", "product") for s in ("mean", "std", "sum")]
PARTS = {
    "month": "month({0})", "day": "day({0})", "hour": "hour({0})", "minute": "minute({0})",
    "second": "second({0})", "week": "week({0})", "weekday": "isodow({0}) - 1",
    "yearday": "dayofyear({0})",
}
FEATURE_STATS = ("mean", "std", "min", "median", "max", *_POINTS)
MEAN_DIGITS = {s: 10 for s in ("mean", "min", "median", "max", "10per", "25per", "75per", "90per")}
GAPS = ["gap", "gap_entity", "gap_actor", "gap_product"]
# grid values are safe at 8 digits, averages are not
GAP_DIGITS = {"mean": 3, "std": 3, "min": 8, "median": 8, "max": 8, "10per": 8, "25per": 8,
              "75per": 8, "90per": 8}


def dated(ts: str) -> str:
    return ", ".join(f"{e.format(ts)} AS {n}" for n, e in PARTS.items())


def gap(part: str | None, order: str = "us, rid") -> str:
    over = f"{'PARTITION BY ' + part if part else ''} ORDER BY {order}"
    g = f"(us - lag(us) OVER ({over})) / 1000000.0::DOUBLE"
    return f"CASE WHEN {part} IS NOT NULL THEN {g} END" if part else g


EV_GAPS = (f"gaps AS (SELECT *, {gap(None)} AS gap, {gap('entity')} AS gap_entity, "
           f"{gap('actor')} AS gap_actor, {gap('product')} AS gap_product FROM ev)")
FILLED = ("filled AS (SELECT * REPLACE (" + ", ".join(f"coalesce({g}, -1) AS {g}" for g in GAPS)
          + ") FROM gaps)")


def digits_of(c: str) -> str:
    return f"length(regexp_replace({c}, '[^0-9]', '', 'g'))"


def letters(c: str) -> str:
    return ", ".join(
        f"{big(f'len(string_split({c}, {chr(39)}{ch}{chr(39)})) - 1')} AS n_{ch}" for ch in "abcde")


AGES = """ages AS (
  SELECT entity, n, list(us ORDER BY us) AS u, (SELECT max(us) FROM ev) AS latest
  FROM (SELECT *, count(*) OVER (PARTITION BY entity) AS n FROM ev) GROUP BY entity, n)"""


def age_items() -> list[str]:
    at = {"min": "1", "max": "n"}
    at |= {s: f"((n - 1) * {p} // 100) + 1" for s, p in
           (("10per", 10), ("25per", 25), ("median", 50), ("75per", 75), ("90per", 90))}
    items = [f"{rd(f'(latest - u[{e}]) / 1000000.0::DOUBLE')} AS age_{s}" for s, e in at.items()]
    return items + [f"{rd('(u[n] - u[1]) / 1000000.0::DOUBLE')} AS age_range"]


def gram_rows(src: str, token: str, order: str, w1: float, w2: float) -> str:
    return f"""tok AS (
  SELECT entity, {token} AS t, lag({token}) OVER (PARTITION BY entity ORDER BY {order}) AS b
  FROM {src}),
grams AS (
  SELECT entity, t AS g, {w1}::DOUBLE AS w FROM tok
  UNION ALL SELECT entity, b || ' ' || t, {w2}::DOUBLE FROM tok WHERE b IS NOT NULL),
bag AS (
  SELECT entity, ('0x' || substr(md5(g), 1, 8))::BIGINT AS h, w FROM grams)"""


def hashed(buckets: int, agg: str, norm: bool = True) -> str:
    value = "v / sqrt(sum(v * v) OVER (PARTITION BY entity))" if norm else "v"
    return f"""cells AS (
  SELECT entity, h % {buckets} AS feature, {agg}(w) AS v FROM bag GROUP BY ALL),
coo AS (SELECT entity, feature, {value} AS value FROM cells)"""


def seconds_text(c: str) -> str:
    """Seconds as Spark writes a double: from 0.001 on as they are, below with an exponent."""
    us, k = f"CAST(round({c} * 1e6) AS BIGINT)", f"(length(CAST(CAST(round({c} * 1e6) AS BIGINT) AS VARCHAR)) - 1)"
    return (f"coalesce(CASE WHEN {us} BETWEEN 1 AND 999 THEN CAST({us} / pow(10, {k}) AS VARCHAR) "
            f"|| 'E' || ({k} - 6) ELSE CAST({c} AS VARCHAR) END, 'nan')")


def frequent_cells(token: str, w1: float, buckets: int, agg: str, t: int) -> str:
    """Scaled cells of hashed tokens and pairs of ``gaps`` in more than ``t`` entities."""
    return f"""(WITH {gram_rows('gaps', token, 'us, rid', w1, 1.0)}, {hashed(buckets, agg)}
  SELECT * FROM coo WHERE feature IN (
    SELECT feature FROM coo GROUP BY feature HAVING count(*) > {t}))"""


E0 = "CAST(embedding[{0}] AS DOUBLE)"
EMB = "emb AS (SELECT CAST(vec_id AS VARCHAR) AS entity, label, " + ", ".join(
    f"{E0.format(i + 1)} AS {c}" for i, c in enumerate(DIMS)) + " FROM embeddings)"


def scaled(fill_first: bool) -> str:
    items = []
    for c in DIMS:
        if fill_first:
            items.append(f"{rd(f'({c} - avg({c}) OVER ()) / (stddev_pop({c}) OVER () + avg({c}) OVER () + 1)')} AS {c}")
        else:
            items.append(f"{rd(f'coalesce(({c} - avg({c}) OVER ()) / (stddev_pop({c}) OVER () + avg({c}) OVER () + 1), -1)')} AS {c}")
    return ", ".join(items)


SCORES = """sd AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS entity, l.quality, (d.n_chars % 97) / 97.0::DOUBLE AS p
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

PREDS = "preds AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, CAST(doc_id AS VARCHAR) AS entity, "
    f"((n_chars * {i + 3}) % 101) / 101.0::DOUBLE AS p FROM documents"
    + (" WHERE doc_id IN (SELECT doc_id FROM labels)" if m == MODELS[-1] else "")
    for i, m in enumerate(MODELS)) + ")"
WEIGHTS = {"lgbm4": 0.5, "lgbm3": 0.22, "lgbm2": 0.08, "rnn1": 0.01, "rnn2": 0.05, "nn1": 0.02,
           "nn2": 0.12}

CODED = """cg AS (
  SELECT *, coalesce((us - lag(us) OVER (ORDER BY us, rid)) / 1000000.0::DOUBLE, -1) AS gap,
         coalesce((us - lag(us) OVER (PARTITION BY actor ORDER BY us, rid)) / 1000000.0::DOUBLE, -1)
           AS gap_actor
  FROM ev),
coded AS (
  SELECT *, dense_rank() OVER (ORDER BY actor) - 1 AS actor_code,
         dense_rank() OVER (ORDER BY product) - 1 AS product_code,
         dense_rank() OVER (ORDER BY gap) - 1 AS gap_code,
         dense_rank() OVER (ORDER BY gap_actor) - 1 AS gap_actor_code
  FROM cg)"""


def padded(c: str, n: int) -> str:
    last = f"list({c} ORDER BY us, rid)"
    return (f"array_to_string(list_concat(list_transform(range(greatest({n} - count(*), 0)), "
            f"lambda i: 0), list_slice({last}, greatest(count(*) - {n} + 1, 1), count(*))), ' ')")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # -- cleaning, joins, folds
    q["labels_clean"] = f"""WITH {DOCS}
SELECT entity, target, CASE WHEN target IS NOT NULL THEN
  ntile(10) OVER (PARTITION BY target ORDER BY entity) - 1 ELSE -1 END AS fold FROM cleaned"""
    q["log_known"] = f"""WITH {LINES}
SELECT ln.entity, actor, product, us, target FROM ln JOIN ords ON ords.entity = ln.entity
WHERE target IS NOT NULL"""
    q["folds"] = f"WITH {LINES} SELECT entity, target, coalesce(fold, -1) AS fold FROM oe"
    q["split_rows"] = f"""WITH {LINES}, f AS (SELECT unnest(range(10)) AS f)
SELECT f AS fold, {big('count(*) FILTER (WHERE fold <> f)')} AS n_train,
  {big('count(*) FILTER (WHERE fold = f)')} AS n_valid,
  {big('count(*) FILTER (WHERE fold IS NULL)')} AS n_unlabelled FROM oe, f GROUP BY f"""
    q["stack_distinct"] = """WITH u AS (
  SELECT CAST(c_custkey AS VARCHAR) AS entity, c_mktsegment AS product FROM customer
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), o_orderpriority FROM orders)
SELECT product, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT entity) AS BIGINT)
  AS n_entities FROM u GROUP BY product"""
    q["null_keys"] = f"""WITH {DOCS}
SELECT coalesce(CAST(CAST(target AS BIGINT) AS VARCHAR), 'nan') AS product,
  CAST(count(*) AS BIGINT) AS n_rows FROM cleaned GROUP BY 1"""
    q["global_latest"] = f"""WITH {EVENTS}
SELECT rid, {rd('((SELECT max(us) FROM ev) - us) / 1000000.0::DOUBLE', 6)} AS age FROM ev"""
    q["time_text"] = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS text,
  epoch_us(o_orderdate) AS us, CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS epoch
FROM orders"""
    q["log_preview"] = f"""WITH {LINES}
SELECT us, {TIE}, product FROM ln ORDER BY us, {TIE} LIMIT 100"""
    q["log_order"] = f"""WITH {LINES}
SELECT {big(f'row_number() OVER (ORDER BY us, {TIE})')} AS place, l_orderkey, l_linenumber,
  l_partkey, l_suppkey, us FROM ln"""
    q["join_features"] = f"""WITH {EVENTS}
SELECT entity, {big('count(*)')} AS n_rows, {rd('avg(us / 1e6)', 3)} AS us_mean,
  {big('count(DISTINCT product)')} AS n_products FROM ev GROUP BY entity"""

    q["log_known_screened"] = q["log_known"]
    q["log_excluded_screened"] = f"""WITH {LINES} SELECT * FROM ln
WHERE (entity, actor) NOT IN (SELECT entity, actor FROM ln WHERE product = 'R')"""
    q["join_features_bucketed"] = f"""WITH {LINES}
SELECT entity, {big('count(*)')} AS n_rows, {big('count(DISTINCT actor)')} AS n_actors,
  {big('count(DISTINCT product)')} AS n_products, min(us) AS first_us, max(us) AS last_us,
  min(l_partkey) AS least_part, max(l_partkey) AS most_part, {big('sum(l_partkey)')} AS parts,
  {big('sum(length(actor))')} AS actor_chars,
  {big("count(*) FILTER (WHERE product = 'R')")} AS returned FROM ln GROUP BY entity"""

    # -- target statistics
    items = ", ".join(rd(f"actor_{s}", 9) + f" AS actor_{s}" for s in ("mean", "std", "sum"))
    q["target_stats"] = f"WITH {EVENTS}, s AS ({other_folds('actor')}) SELECT actor, coalesce(fold, -1) AS fold, {items} FROM s"
    q["target_stats_lines"] = f"""WITH {LINES},
lf AS (SELECT ln.*, target, fold FROM ln LEFT JOIN oe USING (entity)),
s AS ({other_folds('actor')}) SELECT actor, coalesce(fold, -1) AS fold, {items} FROM s"""
    q["target_stats_real"] = f"""WITH {LINES},
lf AS (SELECT ln.entity, ln.actor, l_quantity AS target, oe.fold
       FROM (SELECT *, CAST(l_orderkey AS VARCHAR) AS entity, CAST(l_suppkey AS VARCHAR) AS actor
             FROM lineitem) ln LEFT JOIN oe USING (entity)),
s AS ({other_folds('actor')}) SELECT actor, coalesce(fold, -1) AS fold, {items} FROM s"""
    rows = ", ".join(rd(c, 9) + f" AS {c}" for c in TARGET_COLS)
    q["fold_join"] = f"WITH {EVENTS}, {attached()} SELECT rid, {rows} FROM enc"
    rolled = ", ".join(i for c in TARGET_COLS for i in nine(c, "-1", MEAN_DIGITS))
    q["target_stats_rollup"] = f"""WITH {EVENTS}, {attached()}
SELECT entity, {rolled} FROM enc GROUP BY entity"""
    q["target_rollup_lines"] = f"""WITH {LINES},
lf AS (SELECT ln.*, target, fold FROM ln LEFT JOIN oe USING (entity)), {attached()}
SELECT entity, {rolled} FROM enc GROUP BY entity"""

    # -- counts and text
    counts = f"""{big('count(*)')} AS n_rows, {big('count(DISTINCT actor)')} AS n_actors,
  {big('count(DISTINCT product)')} AS n_products,
  {big("length(string_agg(actor, ''))")} AS actor_chars,
  {rd(digits_of("string_agg(actor, '')") + " / length(string_agg(actor, ''))::DOUBLE")}
    AS actor_digit_share,
  {big("length(string_agg(product, ''))")} AS product_chars,
  {rd(digits_of("string_agg(product, '')") + " / length(string_agg(product, ''))::DOUBLE")}
    AS product_digit_share"""
    q["entity_counts"] = f"WITH {EVENTS} SELECT entity, {counts} FROM ev GROUP BY entity"
    q["entity_counts_lines"] = f"WITH {LINES} SELECT entity, {counts} FROM ln GROUP BY entity"
    q["char_counts"] = f"""SELECT c_custkey, {big(digits_of('c_name'))} AS n_digits,
  {letters('c_name')} FROM customer"""
    q["char_counts_text"] = f"""SELECT doc_id, {big(digits_of('text'))} AS n_digits,
  {letters('text')} FROM documents"""
    q["ngrams"] = """WITH p AS (SELECT p_partkey, string_split(p_name, ' ') AS a FROM part)
SELECT p_partkey, array_to_string(list_concat(a,
  list_transform(range(1, len(a)), lambda i: array_to_string(a[i:i + 1], '')),
  list_transform(range(1, greatest(len(a) - 1, 1)), lambda i: array_to_string(a[i:i + 2], ''))),
  ' ') AS grams FROM p"""
    q["list_text"] = """WITH o AS (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS entity, place // 100000 AS chunk,
  string_agg(coalesce(nullif(o_orderpriority, '5-LOW'), 'nan'), ' ' ORDER BY place) AS text
FROM o GROUP BY ALL"""

    # -- time
    stat_items = ", ".join(i for c in PARTS for i in nine(c))
    q["date_parts"] = ("SELECT event_id, " + ", ".join(
        f"{big(e.format('ts'))} AS {n}" for n, e in PARTS.items()) + " FROM events")
    q["date_stats"] = f"""WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS entity,
  {dated('o_orderdate')} FROM orders) SELECT entity, {stat_items} FROM o GROUP BY entity"""
    ages = ", ".join(age_items())
    q["recency"] = f"WITH {EVENTS}, {AGES} SELECT entity, {ages} FROM ages"
    q["recency_lines"] = (f"WITH {LINES}, ev AS (SELECT * FROM ln), {AGES} "
                          f"SELECT entity, {ages} FROM ages")
    q["global_gap"] = f"WITH {EVENTS}, {EV_GAPS} SELECT rid, gap FROM gaps"
    q["group_gaps"] = f"""WITH {EVENTS}, {EV_GAPS}
SELECT rid, gap_entity, gap_actor, gap_product FROM gaps"""
    q["gaps_with_ties"] = f"""WITH {LINES}
SELECT {TIE}, {gap(None, 'us, ' + TIE)} AS gap, {gap('product', 'us, ' + TIE)} AS gap_product,
  {gap('actor', 'us, ' + TIE)} AS gap_actor FROM ln"""
    q["gap_stats"] = f"""WITH {EVENTS}, {EV_GAPS}, {FILLED}
SELECT entity, {', '.join(i for c in GAPS for i in nine(c, None, GAP_DIGITS))}
FROM filled GROUP BY entity"""
    # null gaps are kept here: the median skips them, the percentiles do not
    q["gap_stats_nulls"] = f"""WITH {EVENTS}, {EV_GAPS}
SELECT actor, {', '.join(i for c in ('gap_entity', 'gap_actor') for i in nine(c, None, GAP_DIGITS))}
FROM gaps GROUP BY actor"""
    q["rollup_hot_groups"] = q["gap_stats_nulls"]
    for name in ("date_stats", "recency", "recency_lines", "gap_stats", "gap_stats_nulls"):
        q[f"{name}_radix"] = q[name]

    # -- sequences
    q["sequences"] = f"""WITH {EVENTS}, {EV_GAPS}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY us, rid) - 1 AS place FROM gaps)
SELECT entity, place // 100000 AS chunk, array_to_string(list(actor ORDER BY us, rid), ' ') AS actor,
  array_to_string(list(product ORDER BY us, rid), ' ') AS product,
  array_to_string(list(coalesce(CAST(round(gap_entity * 1000000) AS BIGINT)::VARCHAR, 'nan')
    ORDER BY us, rid), ' ') AS gap_entity FROM placed GROUP BY ALL"""
    q["sequence_chunks"] = f"""WITH {EVENTS},
r AS (SELECT *, row_number() OVER (PARTITION BY product ORDER BY us, rid) - 1 AS place FROM ev)
SELECT product, place // 100 AS chunk, array_to_string(list(rid ORDER BY place), ' ') AS rids
FROM r GROUP BY ALL"""
    q["label_codes"] = f"""WITH {EVENTS}
SELECT rid, {big('dense_rank() OVER (ORDER BY actor) - 1')} AS actor_code,
  {big('dense_rank() OVER (ORDER BY product) - 1')} AS product_code FROM ev"""
    q["label_codes_nulls"] = f"""WITH {DOCS}
SELECT entity, {big('CASE WHEN target IS NULL THEN -1 ELSE dense_rank() OVER '
                    '(ORDER BY target NULLS LAST) - 1 END')} AS target_code FROM cleaned"""
    actor_stats = ", ".join(
        i for c in ("actor_mean", "actor_std") for i in nine(c, "-1", MEAN_DIGITS)
        if i.split(" AS ")[-1].endswith(("_mean", "_std")))
    q["padded_inputs"] = f"""WITH {EVENTS}, {attached()}, {CODED},
encoded AS (SELECT entity, {actor_stats} FROM enc GROUP BY entity), padded_rows AS (
SELECT entity, {padded('actor_code', 500)} AS actor_code,
  {padded('product_code', 500)} AS product_code, {padded('gap_actor_code', 500)} AS gap_actor_code,
  {big('count(*)')} AS n_rows, {big('count(DISTINCT actor)')} AS n_actors,
  {big('count(DISTINCT product)')} AS n_products, {big(digits_of('entity'))} AS n_digits,
  {letters('entity')} FROM coded GROUP BY entity)
SELECT * FROM padded_rows JOIN encoded USING (entity)"""
    q["padded_lines"] = f"""WITH {LINES}, coded AS (
  SELECT actor AS entity, l_linenumber, us, l_orderkey, l_partkey, l_suppkey,
    row_number() OVER (PARTITION BY actor ORDER BY us, {TIE}) AS place,
    count(*) OVER (PARTITION BY actor) AS n FROM ln)
SELECT entity, repeat('0 ', CAST(greatest(600 - any_value(n), 0) AS INT))
  || string_agg(CAST(l_linenumber AS VARCHAR), ' ' ORDER BY place) FILTER (place > n - 600)
  AS lines FROM coded GROUP BY entity"""
    q["vocab_sizes"] = f"""WITH {EVENTS}, {CODED}, per AS (
  SELECT entity, count(*) AS n, count(DISTINCT actor) AS na, count(DISTINCT product) AS np
  FROM ev GROUP BY entity),
t AS (SELECT max(actor_code) + 1 AS a, max(product_code) + 1 AS p,
             greatest(max(gap_code), max(gap_actor_code)) + 2 AS g FROM coded)
SELECT {big('a')} AS actor_size, {big('p')} AS product_size, {big('g')} AS gap_size,
  {big('(SELECT max(greatest(n, na, np)) + 2 FROM per)')} AS count_size,
  {big(f"(SELECT max({digits_of('entity')}) + 1 FROM per)")} AS char_size FROM t"""

    # -- matrices
    q["interactions"] = f"""WITH {EVENTS}
SELECT entity, actor AS feature, count(*)::DOUBLE AS value FROM ev GROUP BY ALL"""
    q["doc_freq"] = f"""WITH {EVENTS}
SELECT actor AS feature, CAST(count(DISTINCT entity) AS BIGINT) AS df FROM ev GROUP BY ALL"""
    words2 = f"{WORDS}, {gram_rows('words', 'token', 'place', 1.5, 1.0)}"
    q["hashed_ngrams"] = f"""WITH {words2}, {hashed(2**28, 'max')}
SELECT entity, feature, {rd('value')} AS value FROM coo"""
    q["hashed_lists"] = q["hashed_ngrams"]
    q["hashed_counts"] = f"""WITH {EVENTS}, {gram_rows('ev', 'product', 'us, rid', 1.0, 1.0)},
{hashed(2**29, 'sum')} SELECT entity, feature, {rd('value')} AS value FROM coo"""
    q["min_doc_freq"] = f"""WITH {words2}, {hashed(2**28, 'max')}
SELECT entity, feature, {rd('value')} AS value FROM coo
WHERE feature IN (SELECT feature FROM cells GROUP BY feature HAVING count(*) > 10)"""
    q["min_doc_freq_screened"] = q["min_doc_freq"]
    q["reindex"] = f"""WITH {words2}, {hashed(2**28, 'max')}
SELECT entity, {big('dense_rank() OVER (ORDER BY feature) - 1')} AS feature, {rd('value')} AS value
FROM coo WHERE feature IN (SELECT feature FROM cells GROUP BY feature HAVING count(*) > 10)"""
    cells = " UNION ALL ".join(
        f"SELECT entity, {i}::BIGINT AS feature, {c} AS value FROM emb" for i, c in enumerate(DIMS))
    q["table_cells"] = f"""WITH {EMB}, cells AS ({cells})
SELECT entity, feature, {rd('value')} AS value FROM cells WHERE value <> 0"""
    q["dense_table"] = f"""WITH {EVENTS}, c AS (
  SELECT entity, product, count(*) AS n FROM ev GROUP BY ALL), pid AS (
  SELECT DISTINCT product FROM ev), k AS (
  SELECT product, row_number() OVER (ORDER BY product) - 1 AS i FROM pid)
SELECT entity, """ + ", ".join(
        f"coalesce(max(CASE WHEN i = {i} THEN n END), 0)::DOUBLE AS f{i}" for i in range(5)
    ) + " FROM c JOIN k USING (product) GROUP BY entity"
    q["hstack"] = f"""WITH {EVENTS}, a AS (
  SELECT entity, actor, count(*) AS n FROM ev GROUP BY ALL), p AS (
  SELECT entity, product, count(*) AS n FROM ev GROUP BY ALL), w AS (
  SELECT count(DISTINCT actor) AS w FROM ev)
SELECT entity, {big('dense_rank() OVER (ORDER BY actor) - 1')} AS feature, n::DOUBLE AS value FROM a
UNION ALL SELECT entity, {big('dense_rank() OVER (ORDER BY product) - 1 + w')}, n::DOUBLE
FROM p, w"""
    q["matrix_files"] = f"""WITH {EVENTS}, a AS (
  SELECT entity, actor, count(*) AS n FROM ev GROUP BY ALL)
SELECT entity, {big('dense_rank() OVER (ORDER BY actor) - 1')} AS feature, n::DOUBLE AS value,
  {big('(SELECT count(DISTINCT actor) FROM ev)')} AS width FROM a"""
    q["vector_rows"] = f"""WITH {EVENTS}, a AS (
  SELECT entity, actor, count(*)::DOUBLE AS n FROM ev GROUP BY ALL)
SELECT entity, {big('count(*)')} AS cells, {rd('sum(n)')} AS total, {rd('max(n)')} AS largest
FROM a GROUP BY entity"""

    # vectors are defined up to rotation, so what their products rebuild is compared
    q["latent_factors"] = f"""WITH {EVENTS}, cells AS (
  SELECT entity, actor FROM ev WHERE actor IS NOT NULL GROUP BY ALL)
SELECT entity, {big('count(*)')} AS cells, 350::BIGINT AS n_factors, TRUE AS rebuilt
FROM cells WHERE actor IN (SELECT actor FROM cells GROUP BY actor HAVING count(*) > 1)
GROUP BY entity"""
    q["crossfit_scores"] = """WITH p AS (
  SELECT CAST(vec_id AS VARCHAR) AS entity, CAST(embedding[1] >= 0 AS INT)::DOUBLE AS positive,
    CASE WHEN vec_id % 10 <> 9 THEN CAST(embedding[1] >= 0 AS INT)::DOUBLE END AS target
  FROM embeddings),
en AS (
  SELECT *, CASE WHEN target IS NOT NULL THEN
    ntile(10) OVER (PARTITION BY target ORDER BY entity) - 1 END AS fold FROM p)
SELECT entity, f.fold::BIGINT AS fold, 0::BIGINT AS bag, target, positive AS p
FROM en JOIN (SELECT unnest(range(10)) AS fold) f ON en.fold IS NULL OR en.fold = f.fold"""

    # -- scaling
    q["column_profile"] = f"WITH {EMB}, p AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", stddev_samp({c}) AS s, count(*) - count({c}) AS n FROM emb"
        for c in DIMS) + f") SELECT \"column\", {rd('s')} AS std, {big('n')} AS nulls FROM p"
    q["drop_degenerate"] = f"WITH {EMB} SELECT entity, " + ", ".join(
        f"{rd(c)} AS {c}" for c in DIMS) + " FROM emb"
    q["scaled"] = f"WITH {EMB} SELECT entity, {scaled(True)} FROM emb"
    neg = ", ".join(f"CASE WHEN {c} > 0 THEN {c} END AS {c}" for c in DIMS)
    q["scaled_skip_nulls"] = (f"WITH {EMB}, holes AS (SELECT entity, {neg} FROM emb) "
                              f"SELECT entity, {scaled(False)} FROM holes")
    q["scaled_fill_first"] = (f"WITH {EMB}, holes AS (SELECT entity, " + ", ".join(
        f"CASE WHEN {c} > 0 THEN {c} ELSE -1 END AS {c}" for c in DIMS)
        + f" FROM emb) SELECT entity, {scaled(True)} FROM holes")
    q["minmax"] = f"""SELECT o_orderkey, {rd('(o_totalprice - min(o_totalprice) OVER ()) / '
        '(max(o_totalprice) OVER () - min(o_totalprice) OVER ())')} AS o_totalprice FROM orders"""

    q["scaled_seen"], q["minmax_seen"] = q["scaled"], q["minmax"]

    # -- scoring
    q["auc"] = f"""WITH {SCORES}, a AS (SELECT p FROM sd WHERE quality = 1),
b AS (SELECT p FROM sd WHERE quality = 0)
SELECT {rd('avg(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END)')} AS auc
FROM a, b"""
    q["auc_by_group"] = """WITH o AS (
  SELECT o_orderpriority AS pr, o_totalprice AS p, CAST(o_orderstatus = 'F' AS INT) AS y
  FROM orders WHERE o_orderstatus <> 'P'),
r AS (SELECT *, rank() OVER (PARTITION BY pr ORDER BY p)
        + (count(*) OVER (PARTITION BY pr, p) - 1) / 2.0::DOUBLE AS rk FROM o)
SELECT pr, round((sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE)
  / (sum(y)::DOUBLE * sum(1 - y)), 6) AS auc FROM r GROUP BY pr"""
    q["class_weights"] = f"""WITH {SCORES}
SELECT entity, {big('quality')} AS target, {rd('count(*) OVER () / '
    '(2.0::DOUBLE * count(*) OVER (PARTITION BY quality))')} AS weight FROM sd"""
    case = " ".join(f"WHEN '{m}' THEN {w}::DOUBLE" for m, w in WEIGHTS.items())
    q["blend"] = f"""WITH {PREDS}
SELECT entity, {rd(f'sum(p * CASE model {case} END)')} AS p FROM preds
GROUP BY entity HAVING count(*) = {len(WEIGHTS)}"""
    q["avg_predictions"] = f"WITH {PREDS} SELECT entity, {rd('avg(p)')} AS p FROM preds GROUP BY entity"
    q["final_predictions"] = f"""WITH {PREDS}, m AS (
  SELECT entity, avg(p) AS p FROM preds GROUP BY entity)
SELECT entity, {rd('(p - min(p) OVER ()) / (max(p) OVER () - min(p) OVER ())')} AS p FROM m"""

    # -- files
    q["log_files"] = """SELECT CAST(user_id AS VARCHAR) AS entity,
  json_extract_string(props, '$.k') AS actor, coalesce(nullif(event_type, 'error'), 'nan') AS product,
  (epoch_us(ts) // 1000000) * 1000000 AS us FROM events WHERE user_id % 10 <> 9"""
    q["log_quarantine"] = """WITH l AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS entity, json_extract_string(props, '$.k') AS actor,
    event_type AS product, (epoch_us(ts) // 1000000) * 1000000 AS us FROM events)
SELECT entity, actor, product, us, NULL AS line FROM l WHERE event_id % 50 > 1
UNION ALL SELECT NULL, NULL, NULL, NULL, CASE WHEN event_id % 50 = 1 THEN entity
  ELSE entity || ',' || coalesce(actor, '') || ',soon,' || product END FROM l WHERE event_id % 50 <= 1"""
    q["target_stats_parts"] = q["target_stats"]
    q["entity_sketches"] = """SELECT CAST(l_orderkey AS VARCHAR) AS entity, count(*)::BIGINT AS n_rows,
  count(DISTINCT l_suppkey)::BIGINT AS n_actors, count(DISTINCT l_returnflag)::BIGINT AS n_products
FROM lineitem GROUP BY 1"""
    q["label_files"] = f"WITH {DOCS} SELECT entity, target FROM cleaned"
    q["table_files"] = """SELECT c_custkey, c_name, c_acctbal FROM customer"""

    # -- the whole feature table
    feats = [i for c in TARGET_COLS for i in nine(c, "-1", MEAN_DIGITS)]
    feats += [i for c in PARTS for i in nine(c)]
    feats += [i for c in GAPS for i in nine(c, None, GAP_DIGITS)]
    q["feature_table"] = f"""WITH {EVENTS}, {attached()}, {EV_GAPS}, {FILLED}, {AGES},
wide AS (SELECT enc.*, {dated('enc.ts')}, {', '.join(f'filled.{g}' for g in GAPS)}
         FROM enc JOIN filled ON filled.rid = enc.rid),
agg AS (SELECT entity, {', '.join(feats)}, {counts} FROM wide GROUP BY entity),
age AS (SELECT entity, {ages} FROM ages)
SELECT en.entity, en.target, coalesce(en.fold, -1) AS fold, agg.* EXCLUDE (entity), age.* EXCLUDE (entity),
  {big(digits_of('en.entity'))} AS n_digits, {letters('en.entity')}
FROM en LEFT JOIN agg ON agg.entity = en.entity LEFT JOIN age ON age.entity = en.entity"""

    # the matrix by block; of blocks of factors (vectors up to rotation) the cells alone
    exact = {s: 15 for s in FEATURE_STATS}
    raw = [i for c in TARGET_COLS for i in nine(c, "-1", exact)]
    raw += [i for c in [*PARTS, *GAPS] for i in nine(c, None, exact)]
    product = "coalesce(product, 'nan')"
    blocks = {
        2: (frequent_cells("coalesce(actor, 'nan')", 1.5, 2**29, "max", 1), None),
        3: (frequent_cells(product, 1.0, 2**28, "sum", 10), 100),
        4: (frequent_cells(seconds_text("gap"), 1.5, 2**28, "max", 1), None),
        5: (frequent_cells(seconds_text("gap_entity"), 1.5, 2**28, "max", 5), 300),
        6: (frequent_cells(seconds_text("gap_actor"), 1.5, 2**28, "max", 5), 50),
        7: (frequent_cells(seconds_text("gap_product"), 1.5, 2**28, "max", 1), 50),
    }
    summed = (f"count(*)::BIGINT AS cells, {rd('sum(value)', 4)} AS total, "
              f"{rd('sqrt(sum(value * value))', 4)} AS length")
    parts = [f"SELECT entity, 0::BIGINT AS block, {summed} FROM scaled WHERE abs(value) > 1e-9 GROUP BY entity",
             """SELECT DISTINCT entity, 1, 350, NULL, NULL FROM acts WHERE actor IN (
  SELECT actor FROM acts GROUP BY actor HAVING count(*) > 1)"""]
    parts += [f"SELECT entity, {b}, {summed} FROM {cells} GROUP BY entity" if rank is None
              else f"SELECT DISTINCT entity, {b}, {rank}, NULL, NULL FROM {cells}"
              for b, (cells, rank) in blocks.items()]
    q["feature_matrix"] = f"""WITH {EVENTS}, {attached()}, {EV_GAPS}, {FILLED}, {AGES},
wide AS (SELECT enc.*, {dated('enc.ts')}, {', '.join(f'filled.{g}' for g in GAPS)}
         FROM enc JOIN filled ON filled.rid = enc.rid),
agg AS (SELECT entity, {', '.join(raw)}, {counts} FROM wide GROUP BY entity),
age AS (SELECT entity, {ages} FROM ages),
feats AS (
  SELECT en.entity, agg.* EXCLUDE (entity), age.* EXCLUDE (entity),
    {big(digits_of('en.entity'))} AS n_digits, {letters('en.entity')}
  FROM en LEFT JOIN agg ON agg.entity = en.entity LEFT JOIN age ON age.entity = en.entity),
doubles AS (SELECT entity, coalesce(CAST(COLUMNS(* EXCLUDE (entity)) AS DOUBLE), -1) FROM feats),
long AS (UNPIVOT doubles ON COLUMNS(* EXCLUDE (entity)) INTO NAME c VALUE x),
scaled AS (
  SELECT entity, (x - avg(x) OVER w) / nullif(stddev_pop(x) OVER w + avg(x) OVER w + 1, 0) AS value
  FROM long WINDOW w AS (PARTITION BY c)),
acts AS (SELECT entity, actor FROM ev WHERE actor IS NOT NULL GROUP BY ALL)
""" + "\nUNION ALL ".join(parts)
    return q
