"""Queries of the operators that search words and passages (11, 12, 13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.llm import periodic_runs, positional_index, spelling
from saleswright.llm.common import LOWER, NOT_SPACE, UPPER, table, text_of
from saleswright.scale import scratch_path

TYPO_ONE_IN = 31


def _crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a text's bytes, with the table ``t`` of the CTE ``crc``."""
    digits = f"hex(encode({text}))"
    data = f"list_transform(range(length({digits}) // 2), lambda k: ('0x' || substr({digits}, 2 * k + 1, 2))::BIGINT)"
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: {step}), 4294967295)"


# The polynomial of CRC-32, reversed (fixed value).
CRC_SQL = """crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.run_counts(table(spark, folder, "documents"), typo_one_in=TYPO_ONE_IN)
    return spelling.variants(words)


OP11_SQL = rf"""
WITH RECURSIVE {CRC_SQL},
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                             '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run
    FROM documents
),
checked AS (
    SELECT run, length(run) AS size, {_crc32_sql("doc_id || ':' || run")} AS h
    FROM runs, crc WHERE length(run) >= 7
),
spelt AS (
    SELECT CASE WHEN h % {TYPO_ONE_IN} = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2)
                ELSE run END AS word
    FROM checked
),
words AS (
    SELECT word, count(*) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
),
gaps AS (
    SELECT word, n, substr(word, 1, i) || '*' || substr(word, i + 2) AS gap
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
shorter AS (
    SELECT DISTINCT g.word, g.n, w.word AS less, w.n AS less_n
    FROM gaps g JOIN words w ON w.word = replace(g.gap, '*', '')
),
near AS (
    SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b USING (gap) WHERE a.word <> b.word
    UNION ALL SELECT word, less, less_n FROM shorter
    UNION ALL SELECT less, word, n FROM shorter
),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n
    FROM near GROUP BY word
),
formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
           CASE WHEN other_n >= {spelling.FORM_TIMES} * n THEN other END AS form,
           CASE WHEN other_n >= {spelling.FORM_TIMES} * n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
),
steps AS (
    SELECT word, word AS root, 0 AS step FROM formed
    UNION ALL
    SELECT s.word, f.form, s.step + 1 FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NOT NULL
),
roots AS (SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN roots USING (word)
"""


def with_planted_periods(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """In a tenth of the documents, by the checksum of the key, repeat a stretch of words to the end.

    A null key changes nothing.
    """
    words, n, at = F.col("words"), F.size("words"), F.col("at")
    check = F.crc32(F.col(key).cast("string").cast("binary"))
    seed = F.floor(check / F.lit(10)).cast("long")
    first = F.pmod(seed, n)
    period = 1 + F.floor((n - first) / (3 + F.pmod(seed, F.lit(8)))).cast("long")

    def word(i: Column) -> Column:
        moved = first + F.pmod(i - first, period)
        return F.get(words, F.when(i < first, i).otherwise(moved).cast("int"))

    repeated = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    split = F.when(check % 10 == 0, F.regexp_extract_all(text_of(text), F.lit(f"{NOT_SPACE}+"), F.lit(0)))
    rows = df.withColumn("words", split)
    return rows.withColumn(text, F.when(n > 0, repeated).otherwise(F.col(text))).drop("words")


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_planted_periods(table(spark, folder, "documents").select("doc_id", "text"))
    found = periodic_runs.periodic_runs(docs)
    # Of runs in order, a later one is better only with a greater length for its period.
    best = F.aggregate(
        F.slice("runs", F.lit(2), F.greatest(F.size("runs"), F.lit(0))),
        F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    shown = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(shown, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP12_SQL = rf"""
WITH {CRC_SQL},
d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
checked AS (
    SELECT *, len(w) AS n, {_crc32_sql("doc_id::VARCHAR")} AS h
    FROM d, crc
),
seeded AS (SELECT *, h // 10 AS g, (h // 10) % greatest(n, 1) AS a FROM checked),
words AS (
    SELECT r, n, i,
           w[1 + CASE WHEN h % 10 = 0 AND i >= a
                      THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM seeded)
),
equal AS (
    SELECT x.r, x.i, y.i - x.i AS p
    FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
),
stretches AS (
    SELECT r, p, min(i) AS start, count(*) + p AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM equal)
    GROUP BY r, p, island HAVING count(*) + p >= greatest(24, 3 * p)
),
runs AS (SELECT r, start, length, min(p) AS period FROM stretches GROUP BY r, start, length),
of_doc AS (
    SELECT r, count(*) AS n_runs,
           first(struct_pack(start, length, period)
                 ORDER BY length::DOUBLE / period DESC, start, period) AS best,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS shown
    FROM runs GROUP BY r
),
repeated AS (
    SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS text
    FROM words ANTI JOIN repeated USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli,
       sha256(coalesce(shown, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN of_doc USING (r) LEFT JOIN kept USING (r)
"""

WINDOW_WORDS = 10


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "positions")
    positional_index.write_index(table(spark, folder, "documents"), path)
    index = positional_index.PositionalIndex(spark, path)
    found = positional_index.contamination(index, table(spark, folder, "benchmark"), WINDOW_WORDS)
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS_SQL = (
    rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS_SQL} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(len(w), {WINDOW_WORDS}) AS size,
           array_to_string(w[k : k + {WINDOW_WORDS} - 1], ' ') AS phrase
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW_WORDS} + 1, 1) + 1)) AS k
          FROM i WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
    SELECT r, size, k, array_to_string(w[k : k + size - 1], ' ') AS phrase
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d CROSS JOIN sizes WHERE len(w) >= size)
),
found AS (SELECT r, item, k, size FROM grams JOIN windows USING (size, phrase)),
hit AS (
    SELECT r, count(DISTINCT place) AS n_hit
    FROM (SELECT r, unnest(range(k, k + size)) AS place FROM found) GROUP BY r
),
named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

ALL = {
    "op11_spelling": (op11_spelling, OP11_SQL),
    "op12_periodic_runs": (op12_periodic_runs, OP12_SQL),
    "op13_decontamination": (op13_decontamination, OP13_SQL),
}
