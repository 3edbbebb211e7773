"""One query per text operator over its whole table, and the SQL where there is one."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    block_search, exact_dedup, host_rules, language_model, line_dedup, mixing, pieces, quality_model,
    resampling, sharding, shingle_join, spelling, surrogates)
from .common import ship, table

Query = Callable[[SparkSession, str], DataFrame]

WORD = r"[^\x20\x09-\x0D]+"
AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS_SQL = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"


def op1_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def mix_sql(docs: str = "documents") -> str:
    """(doc_id, source, text..., copies, taken): the mix of the rows of ``docs``."""
    return f"""
mix_rows AS (
  SELECT *, len({WORDS_SQL}) AS size, crc32_of AS tie,
    -ln((CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), 'null'))[1:13] AS BIGINT) + 0.5)
        / 4503599627370496.0)
      / greatest(0.1, 1 - length(regexp_replace(coalesce(text, ''),
                                                '[\\p{{L}} \\x09-\\x0D]+', '', 'g'))
                 / greatest(length(coalesce(text, '')), 1)::DOUBLE) AS key
  FROM (SELECT *, md5(coalesce(text, '')) AS crc32_of FROM {docs})),
mix_sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS w,
    row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place
  FROM mix_rows GROUP BY source),
mix_levels AS (
  SELECT *, 2.0 * source_size / w AS ratio,
    (1.5::DOUBLE * sum(source_size) OVER ()
     - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0 * source_size / w, place
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(w) OVER (ORDER BY 2.0 * source_size / w, place
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM mix_sources),
mix_targets AS (
  SELECT source, source_size, CASE WHEN ratio < level THEN 2.0::DOUBLE * source_size
    ELSE max(CASE WHEN ratio >= level THEN level END) OVER () * w END AS target
  FROM mix_levels),
mix_budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM mix_targets),
mixed AS (
  SELECT r.*, source_size, target, CAST(epochs AS BIGINT) + CASE
      WHEN sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id, tie)
         - sum(size) OVER (PARTITION BY r.source, key, doc_id, tie) / 2.0
         <= target - epochs * source_size AND target - epochs * source_size > 0
      THEN 1 ELSE 0 END AS copies
  FROM mix_rows r JOIN mix_budgets b ON r.source IS NOT DISTINCT FROM b.source)"""


def op2_language_model(spark: SparkSession, d: str) -> DataFrame:
    return language_model.score_documents(table(spark, d, "documents"))


def op3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.encode_decode(table(spark, d, "documents"))


def op4_quality_model(spark: SparkSession, d: str) -> DataFrame:
    return quality_model.score_quality(table(spark, d, "documents"), table(spark, d, "labels"))


def op5_surrogates(spark: SparkSession, d: str) -> DataFrame:
    return surrogates.replace_entities(table(spark, d, "documents"))


def op6_host_rules(spark: SparkSession, d: str) -> DataFrame:
    return host_rules.judge(table(spark, d, "documents")).drop("host_rate")


def rules_sql(docs: str = "documents") -> str:
    """``judged``: the rows of ``docs`` with counts, base_failed and kept."""
    return f"""
rule_words AS (SELECT row_number() OVER () AS rid, *, {WORDS_SQL} AS w FROM {docs}),
rule_windows AS (
  SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM rule_words WHERE len(w) >= 5),
rule_grams AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g FROM rule_windows),
rule_twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM rule_grams)
  WHERE n > 1),
rule_covered AS (
  SELECT rid, count(DISTINCT pos) AS n FROM (
    SELECT rid, unnest(range(i, i + 5)) AS pos FROM rule_twice) GROUP BY rid),
rule_lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM (
    SELECT rid, unnest(string_split(text, chr(10))) AS line FROM rule_words)
  WHERE regexp_matches(line, '{WORD}') GROUP BY rid),
rule_counts AS (
  SELECT d.*, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM rule_words d LEFT JOIN rule_lines l USING (rid) LEFT JOIN rule_covered c USING (rid)),
rule_failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_symbols > 0.3 * n_words
      OR n_dup_lines * 10 > n_words * 0.3 AS failed
  FROM rule_counts),
rule_hosts AS (
  SELECT source, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS f FROM rule_failed
  GROUP BY source),
rule_mean AS (SELECT sum(f) / sum(n) AS m, sum(n) AS n, count(*) AS h FROM rule_hosts),
rule_between AS (
  SELECT any_value(m) AS m, greatest(sum(r.n * (f / r.n - m) * (f / r.n - m)) / any_value(s.n)
    - any_value(m) * (1 - any_value(m)) * any_value(h) / any_value(s.n), 1e-9) AS v
  FROM rule_hosts r, rule_mean s),
rule_prior AS (
  SELECT m, least(greatest(m * (1 - m) / v - 1, 1.0), 1e6) AS strength FROM rule_between),
rule_rejected AS (
  SELECT source, (f + m * strength) / (n + strength) > 0.5 AS rejected
  FROM rule_hosts, rule_prior),
judged AS (
  SELECT d.*, NOT failed AND NOT rejected AS kept
  FROM rule_failed d JOIN rule_rejected r ON d.source IS NOT DISTINCT FROM r.source)"""


def op7_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, d, "documents"))


def op8_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard(table(spark, d, "documents"))


def op9_shingle_join(spark: SparkSession, d: str) -> DataFrame:
    return shingle_join.near_groups(
        table(spark, d, "documents"), words=3, percent=90, pool=2.0)


def op10_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    before = docs.withColumn("n_lines", line_dedup.count_lines(F.col("text")))
    after = line_dedup.strip_lines(before)
    return after.select(
        "doc_id", "n_lines", (F.col("n_lines") - line_dedup.count_lines(F.col("text"))).alias(
            "n_dropped"), "text")


_TRIM = r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"


def lines_sql(docs: str = "documents") -> str:
    """``stripped``: the rows of ``docs`` with ``new_text``, ``n_lines`` and ``n_dropped``."""
    return f"""
line_docs AS (SELECT row_number() OVER () AS lid, * FROM {docs}),
line_rows AS (
  SELECT lid, source, page, {_TRIM} AS trimmed, line, pos FROM (
    SELECT lid, source, coalesce(text, '') AS page, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS pos FROM line_docs)),
line_totals AS (
  SELECT source, count(DISTINCT coalesce(text, '')) AS total FROM line_docs GROUP BY source),
line_common AS (
  SELECT r.source, trimmed FROM (
    SELECT source, trimmed, count(DISTINCT page) AS n FROM line_rows WHERE trimmed <> ''
    GROUP BY source, trimmed) r
  JOIN line_totals t ON r.source IS NOT DISTINCT FROM t.source
  WHERE n >= 3 AND n > 0.1 * total),
line_marked AS (
  SELECT r.*, c.trimmed IS NOT NULL AS dropped FROM line_rows r
  LEFT JOIN line_common c ON r.source IS NOT DISTINCT FROM c.source AND r.trimmed = c.trimmed),
line_texts AS (
  SELECT lid, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS new_text,
    count(*) FILTER (trimmed <> '') AS n_lines, count(*) FILTER (dropped) AS n_dropped
  FROM line_marked GROUP BY lid),
stripped AS (
  SELECT d.*, new_text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
  FROM line_docs d LEFT JOIN line_texts USING (lid))"""


def op11_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, d, "documents"), slip=199)


def op12_nearest_vectors(spark: SparkSession, d: str) -> DataFrame:
    return block_search.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_target_resampling(spark: SparkSession, d: str) -> DataFrame:
    return resampling.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))


# (i, crc): the steps of crc32 for one byte; 3988292384 is its polynomial
CRC_STEPS = """
crc_steps AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM (SELECT unnest(range(256))::BIGINT AS i))"""


def crc_sql(s: str) -> str:
    """The unsigned crc32 of the text column ``s``, in a row that has ``steps``."""
    bytes_ = (f"list_transform(range(0, strlen({s})), lambda i: "
              f"('0x' || hex(encode({s}))[2 * i + 1:2 * i + 2])::BIGINT)")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: "
            f"xor(c >> 8, steps[1 + (xor(c, b) & 255)])), 4294967295::BIGINT)")


SPELLING_SQL = f"""WITH RECURSIVE {CRC_STEPS},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(run, '{AZ}', '{AZ.lower()}') AS run,
    count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
keyed AS (
  SELECT run, k, {crc_sql("s")} AS h
  FROM (SELECT *, id || ':' || run AS s FROM runs), crc_steps),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2)
      ELSE run END AS word FROM keyed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cut AS (
  SELECT word, i, left(word, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b
    ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
ranked AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, encode(other)) AS place
  FROM near JOIN words o ON other = o.word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= 5 * w.n THEN other END AS form,
    CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND place = 1),
way(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT way.word, form FROM way JOIN formed f ON way.root = f.word WHERE form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN way ON f.word = way.word
WHERE root IN (SELECT word FROM formed WHERE form IS NULL)"""

NEAREST_SQL = """WITH usable AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scores AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS c_rid,
    list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]),
                lambda a, x: a + x) AS score
  FROM usable q JOIN usable c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST, c_rid) AS rank
  FROM scores) WHERE rank <= 20"""

_WORD_CHARS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _features_sql(table_name: str, id_col: str) -> str:
    return f"""
  SELECT {id_col} AS id, rid, unnest(list_concat(w, list_transform(range(1, len(w)),
    lambda i: w[i] || ' ' || w[i + 1]))) AS feature
  FROM (SELECT {id_col}, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), '{AZ}', '{AZ.lower()}'), '{_WORD_CHARS}') AS w FROM {table_name})"""


RESAMPLING_SQL = f"""WITH {CRC_STEPS},
doc_features AS ({_features_sql("documents", "doc_id")}),
aim_features AS ({_features_sql("benchmark", "item_id")}),
placed AS (
  SELECT feature, {crc_sql("feature")} % 10000 AS bucket
  FROM (SELECT feature FROM doc_features UNION SELECT feature FROM aim_features), crc_steps),
s AS (SELECT bucket, count(*) AS n FROM doc_features JOIN placed USING (feature) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM aim_features JOIN placed USING (feature) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(
    ((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE)
    / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (
  SELECT rid, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM doc_features JOIN placed USING (feature) JOIN gains USING (bucket) GROUP BY rid),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(
      CAST(doc_id AS VARCHAR), ''))[1:8])::BIGINT + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score,
    (coalesce(n_features, 0) + 1) // 2 AS n_words, d.rid
  FROM (SELECT doc_id, row_number() OVER () AS rid FROM documents) d LEFT JOIN weights w USING (rid)),
ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank,
    25 * count(*) OVER () // 100 AS k
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= k THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (rid)"""


def _shipped(f: Query) -> Query:
    @functools.wraps(f)
    def run(spark: SparkSession, d: str) -> DataFrame:
        ship(spark)
        return f(spark, d)

    return run


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


def queries() -> dict[str, Query]:
    return {f.__name__: _shipped(f) for f in (
        op1_mix_sources, op2_language_model, op3_pieces, op4_quality_model, op5_surrogates,
        op6_host_rules, op7_exact_dedup, op8_sharding, op9_shingle_join,
        op10_line_dedup, op11_spelling_variants, op12_nearest_vectors, op13_target_resampling,
        pipeline)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": f"""WITH {mix_sql()}
SELECT doc_id, size::BIGINT AS size, source_size, target, (copies * size)::BIGINT AS taken
FROM mixed""",
        "op6_host_rules": f"""WITH {rules_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM judged""",
        "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
        "op9_shingle_join": f"""WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{AZ}',
  '{AZ.lower()}'), '{WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * common >= 90 * (a.n + b.n - common)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT id, y FROM reach JOIN edges ON other = x)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM documents d JOIN reach ON id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id""",
        "op10_line_dedup": f"""WITH {lines_sql()}
SELECT doc_id, n_lines, n_dropped, new_text AS text FROM stripped""",
        "op11_spelling_variants": SPELLING_SQL,
        "op12_nearest_vectors": NEAREST_SQL,
        "op13_target_resampling": RESAMPLING_SQL,
    }
