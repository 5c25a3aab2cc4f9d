"""Quality rules (operator 2).

A threshold table (measure, operator, bound) is compiled into one projection over the
text's length, symbol, stop-word and line measures. Nothing is shuffled and no user
function runs. A text is kept when it passes the base rules and every row of the table.

Words are runs of characters other than the six of ASCII white space. A null text has no
words, fails the length rules and is not kept; so does an empty one. Texts are measured whole. Ties and
repeated rows are judged one by one. Other columns are passed on; those named like a measure
or a verdict are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import NOT_SPACE, column, fresh, text_of

# Common words of English, French, German and Spanish (fixed values).
STOP_WORDS = (
    "the of and to a in is that it for was on with as this be by are at from "
    "de la le et les des en du un que pour une est qui dans par sur au pas avec "
    "der die und den das von zu mit sich auf für nicht dem ist im ein eine als "
    "el y los las del se no por con su para una es al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """Reject when ``measure`` compares so with ``bound``; ``<`` and ``>`` are known."""

    name: str
    measure: str
    fails_if: str
    bound: float


# The production thresholds. Ratios are per word or per line with a word.
RULES = (
    Rule("short_words", "mean_word_chars", "<", 3.0),
    Rule("long_words", "mean_word_chars", ">", 10.0),
    Rule("symbols", "symbol_ratio", ">", 0.1),
    Rule("exclamations", "exclamation_ratio", ">", 0.2),
    Rule("capitals", "capital_ratio", ">", 0.5),
    Rule("stop_words", "stop_word_ratio", "<", 0.02),
    Rule("repeated_lines", "dup_line_ratio", ">", 0.5),
    Rule("bullet_lines", "bullet_line_ratio", ">", 0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", ">", 0.3),
)
BASE_WORDS = 50
BASE_REPEATED_PERCENT = 50
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _matches(text: Column, pattern: str) -> Column:
    """Characters of the text that match a character class."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def _repeated_words(words: Column, grams: Column) -> Column:
    """Words covered by a window of three words that stands in the text twice or more.

    ``grams`` are the windows with their places, sorted, so equal ones stand together.
    """
    same = F.transform(
        grams,
        lambda g, i: F.when(
            (F.get(grams, i - 1)["gram"] == g["gram"]) | (F.get(grams, i + 1)["gram"] == g["gram"]),
            g["place"],
        ),
    )
    covered = F.flatten(
        F.transform(
            F.filter(same, lambda p: p.isNotNull()), lambda p: F.array(p, p + 1, p + 2)
        )
    )
    return F.size(F.array_distinct(covered)).cast("long")


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts and ratios that the rules compare."""
    body, words, grams, lines = (fresh(df.columns, n) for n in ("body", "words", "grams", "lines"))
    out = df.withColumn(body, text_of(text))
    out = out.withColumn(words, F.regexp_extract_all(body, F.lit(f"({NOT_SPACE}+)"), F.lit(1)))
    out = out.withColumn(
        grams,
        F.sort_array(
            F.transform(
                F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
                lambda w, i: F.struct(
                    F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("gram"),
                    i.alias("place"),
                ),
            )
        ),
    )
    out = out.withColumn(lines, F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_SPACE)))
    w, b, ln = F.col(words), F.col(body), F.col(lines)
    n, n_lines = F.greatest(F.size(w), F.lit(1)), F.greatest(F.size(ln), F.lit(1))
    counts = {
        "n_words": F.size(w).cast("long"),
        "word_chars": _matches(b, f"{NOT_SPACE}+"),
        "n_symbols": _matches(b, r"[#*$%&|<>]+"),
        "n_dup_lines": (F.size(ln) - F.size(F.array_distinct(ln))).cast("long"),
        "n_repeat_words": _repeated_words(w, F.col(grams)),
    }
    per_word = lambda column: column / n
    per_line = lambda pattern: F.size(F.filter(ln, lambda x: x.rlike(pattern))) / n_lines
    ratios = {
        "mean_word_chars": per_word(counts["word_chars"]),
        "symbol_ratio": per_word(counts["n_symbols"]),
        "exclamation_ratio": per_word(_matches(b, "!+")),
        "capital_ratio": per_word(F.regexp_count(b, F.lit(r"(?<![^\x20\x09-\x0D])\p{Lu}{2,}"))),
        "stop_word_ratio": per_word(
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS)))
        ),
        "dup_line_ratio": counts["n_dup_lines"] / n_lines,
        "bullet_line_ratio": per_line(r"^[\x20\x09-\x0D]*[-*•]"),
        "ellipsis_line_ratio": per_line(r"(\.\.\.|…)[\x20\x09-\x0D]*$"),
    }
    return out.withColumns(counts | ratios).drop(body, words, grams, lines)


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one condition: true for a text that some rule rejects."""
    tests = [
        F.col(r.measure) < r.bound if r.fails_if == "<" else F.col(r.measure) > r.bound
        for r in rules
    ]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def verdicts(measures: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to measured rows."""
    base = (F.col("n_words") < BASE_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_REPEATED_PERCENT * F.col("n_words")
    )
    return measures.withColumn("base_failed", base).withColumn(
        "kept", ~F.col("base_failed") & ~compiled(rules)
    )


def judged(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add all measures, ``base_failed`` and ``kept``."""
    return verdicts(measured(df, text), rules)


def passing(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that the rules keep, with the columns they came with."""
    row, at = fresh([text], "row"), fresh([text], "at")
    whole = F.struct(*(column(c) for c in df.columns))
    measures = measured(df.select(whole.alias(row), column(text).alias(text)), text)
    # A filter that needs the row's number stays above the measures; below them, it would
    # compute them again for every use.
    counted = measures.withColumn(at, F.monotonically_increasing_id())
    return verdicts(counted, rules).filter(F.col("kept") & (F.col(at) >= 0)).select(f"`{row}`.*")
