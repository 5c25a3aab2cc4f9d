"""Queries of the operators that judge and compare texts (2, 3, 5, 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.llm import jaccard_join, line_dedup, quality_rules, site_quality
from saleswright.llm.common import table
from saleswright.scale import scratch_path


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judged(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def _stop_list() -> str:
    return ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)


def _rules_sql() -> str:
    return " OR ".join(f"{r.measure} {r.fails_if} {r.bound}" for r in quality_rules.RULES)


OP2_SQL = rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
),
grams AS (
    SELECT doc_id, i, list_slice(words, i, i + 2) AS gram
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i
          FROM d WHERE len(words) >= 3)
),
twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams)
    WHERE n >= 2
),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM twice CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
),
m AS (
    SELECT d.doc_id,
           len(words)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           greatest(len(words), 1) AS n, greatest(len(lines), 1) AS n_lines,
           length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations,
           len(list_filter(words, lambda x: regexp_matches(x, '^\p{{Lu}}{{2}}'))) AS n_capitals,
           len(list_filter(words, lambda x: lower(x) IN ({_stop_list()}))) AS n_stops,
           len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets,
           len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipses
    FROM d LEFT JOIN covered USING (doc_id)
),
r AS (
    SELECT *, word_chars / n AS mean_word_chars, n_symbols / n AS symbol_ratio,
           n_exclamations / n AS exclamation_ratio, n_capitals / n AS capital_ratio,
           n_stops / n AS stop_word_ratio, n_dup_lines / n_lines AS dup_line_ratio,
           n_bullets / n_lines AS bullet_line_ratio, n_ellipses / n_lines AS ellipsis_line_ratio,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({_rules_sql()}) AS kept
FROM r
"""

# A good document is of good quality and not toxic.
GOOD = "quality = 1 AND toxic = 0"


def fitted(spark: SparkSession, folder: str) -> site_quality.Evidence:
    """The classifier from the labelled documents of a data folder."""
    docs = table(spark, folder, "documents")
    return site_quality.fit_evidence(docs, table(spark, folder, "labels"), GOOD)


def op3_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    scored = site_quality.site_scores(docs, fitted(spark, folder), settle=True)
    return scored.select("doc_id", "evidence", "site_share", "score", "kept")


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    index = line_dedup.LineIndex(spark, scratch_path(spark, "line-index")).insert(docs)
    return index.clean(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


OP5_SQL = r"""
WITH lines AS (
    SELECT doc_id, line, i,
           translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
),
frequent AS (
    SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
),
marked AS (SELECT lines.*, frequent.key IS NOT NULL AS gone FROM lines LEFT JOIN frequent USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_classes(table(spark, folder, "documents"))


ALL = {
    "op2_quality_rules": (op2_quality_rules, OP2_SQL),
    "op3_site_quality": (op3_site_quality, None),
    "op5_line_dedup": (op5_line_dedup, OP5_SQL),
    "op7_jaccard_join": (op7_jaccard_join, None),
}
