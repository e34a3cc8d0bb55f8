"""The registered queries of the corpus operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actlens.llm import bpe, decontamination, html_text, language_id, near_dedup, quality_rules, secret_scan, token_counts, token_output, url_filter
from actlens.llm.common import Scratch, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.expr("filter(spans, s -> s.kind <> 'random')")
    written = "transform({}, s -> concat(s.kind, ':', cast(s.start as string), ':', cast(s.end as string)))"
    return found.withColumn("base", base).select(
        "doc_id",
        *[F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(F.expr(f"array_join({written.format('base')}, ',')"), 256).alias("base_sha256"),
        F.expr(f"array_join({written.format('spans')}, ',')").alias("spans"),
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws)))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id > b.doc_id GROUP BY 1, 2),
l AS (
  SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
  WHERE 100 * c.c >= 80 * (x.n + y.n - c.c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l UNION SELECT doc_id, doc_id FROM documents),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON m.a = d.doc_id
"""


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("cosine", 4).alias("cosine"), F.round("lcs_share", 4).alias("lcs_share"), F.round("answer_share", 4).alias("answer_share"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out(F.col("doc_id"))
    model = language_id.learn(docs.where(~held))
    return language_id.identify(docs, model).select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_counts(table(spark, sf_dir, "documents"), rule="largest")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "tokens")
    return token_output.write_shards(table(spark, sf_dir, "documents"), f"{scratch.root}/shards", scratch=scratch)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    blocked = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    return url_filter.judge(table(spark, sf_dir, "pages"), blocked)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.verdicts(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT doc_id, i FROM p QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(0, 5) x(k) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT x) AS d FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM w) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(l.d, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    (length(t) - length(replace(t, '!!', ''))) // 2 AS n_bangs, len(list_distinct(ws)) AS n_distinct
  FROM w LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)),
b AS (
  SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT + 16 * (10 * n_upper > 4 * word_chars)::BIGINT
    + 32 * (10 * n_bangs > n_words)::BIGINT + 64 * (word_chars > 20 * n_words)::BIGINT + 128 * (n_words >= 50 AND 20 * n_distinct < n_words)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits & 127 = 0 AS kept, fail_bits FROM b
"""


def queries() -> dict:
    return {f.__name__: f for f in (op1_secret_scan, op2_minhash_near_dedup, op3_bpe, op4_benchmark_decontamination, op5_html_text, op6_language_id, op7_token_counts, op8_token_output, op9_url_filter, op10_quality_rules)}


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash_near_dedup": OP2_SQL, "op10_quality_rules": OP10_SQL}
