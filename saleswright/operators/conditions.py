"""Row conditions of the mapping, checked one by one before any row is read.

A condition is SQL text over the source columns of one sheet. Each distinct text is checked
alone, so what is wrong with one fails only the mapping rows that have it:

* a text that cannot be parsed or does not make sense as a condition is an error of that text;
* the columns it names are found by asking Spark which names it cannot resolve, and looked up
  in the header of each sheet; a sheet without one of them is an error of that mapping row;
* a cast that a cell does not bear, written or implied (a text compared with a number), is
  an error of the mapping row of that cell. The condition is built so that such a cast gives NULL instead
  of ending the job, and a second expression says that it happened.

Texts are configuration: there are as many as someone wrote by hand, whatever the number of rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.logger import PySparkLogger
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from saleswright.functions import cleaning as cl
from saleswright.functions.text import letters_to_number

ANSI = "spark.sql.ansi.enabled"
SYNTAX, UNKNOWN, CAST, INVALID = "syntax error", "unknown column", "cast failed", "invalid condition"
# Names that one condition may use before it is called invalid.
MOST_NAMES = 200


@dataclass(frozen=True)
class Condition:
    """A condition's text, the columns it needs, its casts and what is wrong with it."""

    text: str
    names: tuple[str, ...] = ()
    casts: tuple[tuple[str, str], ...] = ()
    error: str | None = None


@contextmanager
def lenient(spark: SparkSession) -> Iterator[None]:
    """Expressions built inside give NULL where a cast or a division fails.

    Spark decides that when an expression is built, so nothing else is touched.
    """
    before = spark.conf.get(ANSI)
    spark.conf.set(ANSI, "false")
    try:
        yield
    finally:
        spark.conf.set(ANSI, before)


@contextmanager
def unlogged() -> Iterator[None]:
    """Errors that are answers here are not logged as failed queries."""
    log = PySparkLogger.getLogger("SQLQueryContextLogger")
    before, log.disabled = log.disabled, True
    try:
        yield
    finally:
        log.disabled = before


def quoted_names(text: str) -> str:
    """Double-quoted column names to Spark's quoting, outside of text literals."""
    pieces = text.split("'")
    pieces[::2] = [re.sub(r'"([^"]+)"', r"`\1`", p) for p in pieces[::2]]
    return "'".join(pieces)


def casts_in(text: str) -> list[tuple[str, str]]:
    """Operand and type of every CAST of an expression as Spark prints it."""
    found, open_casts, depth, i = [], [], 0, 0
    last_as: dict[int, int] = {}
    while i < len(text):
        c = text[i]
        if c in "'`":
            i += 1
            while i < len(text) and text[i] != c:
                i += 2 if text[i] == "\\" and c == "'" else 1
        elif c == "(":
            depth += 1
            if re.search(r"(?<![A-Z_])CAST$", text[:i]):
                open_casts.append((depth, i + 1))
        elif c == ")":
            if open_casts and open_casts[-1][0] == depth:
                _, start = open_casts.pop()
                cut = last_as[depth]
                found.append((text[start:cut], text[cut + 4 : i]))
            last_as.pop(depth, None)
            depth -= 1
        elif text.startswith(" AS ", i):
            last_as[depth] = i
        i += 1
    return found


def _unresolved(error: AnalysisException) -> str | None:
    """The plain column name that an error is about."""
    if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
        return None
    name = (error.getMessageParameters() or {}).get("objectName", "")
    bare = re.fullmatch(r"`((?:[^`]|``)+)`", name)
    return bare.group(1).replace("``", "`") if bare else None


# Words that Spark reads as functions where no column has their name (fixed values).
NO_COLUMNS = {"current_catalog", "current_database", "current_date", "current_schema", "current_time",
              "current_timestamp", "current_user", "localtimestamp", "session_user", "user"}


def _candidates(text: str) -> list[str]:
    """What may be a column's name: quoted names and bare words outside of text literals."""
    outside = " ".join(text.split("'")[::2])
    quoted = re.findall(r'"([^"]+)"', outside)
    bare = re.findall(r"[A-Za-z_]\w*", re.sub(r'"[^"]*"', " ", outside))
    by_low = {n.lower(): n for n in [*bare, *quoted] if n.lower() not in NO_COLUMNS}
    return list(by_low.values())[:MOST_NAMES]


def check_condition(spark: SparkSession, text: str) -> Condition:
    """Parse and resolve one condition; nothing is run.

    It is resolved over an empty table that has every word of the text as a column of texts; those that
    it really uses are its names. A name that is still unknown is added, one at a time.
    """
    names = _candidates(text)
    with lenient(spark), unlogged():
        while len(names) <= MOST_NAMES:
            columns = [F.lit(None).cast("string").alias(n) for n in names]
            try:
                probe = spark.range(0).select(*columns).filter(F.expr(quoted_names(text)))
            except ParseException:
                return Condition(text, error=SYNTAX)
            except AnalysisException as error:
                name = _unresolved(error)
                if name is None or name.lower() in (n.lower() for n in names):
                    return Condition(text, error=INVALID)
                names.append(name)
                continue
            condition = probe._jdf.queryExecution().analyzed().condition()
            used = condition.references().toSeq()
            found = sorted(used.apply(i).name() for i in range(used.size()))
            return Condition(text, tuple(found), tuple(dict.fromkeys(casts_in(condition.sql()))))
    return Condition(text, error=INVALID)


def check_conditions(mapping: DataFrame) -> list[Condition]:
    """All distinct conditions of a mapping (column ``predicate``), each checked alone."""
    texts = mapping.filter("predicate IS NOT NULL").select("predicate").distinct().collect()
    spark = mapping.sparkSession
    return [check_condition(spark, r[0]) for r in sorted(texts)]


def all_names(conditions: list[Condition]) -> list[str]:
    """The column names of all conditions; those that differ only in case are one."""
    by_low = {n.lower(): n for c in conditions for n in c.names}
    return [by_low[low] for low in sorted(by_low)]


def with_condition_places(mapping: DataFrame, conditions: list[Condition]) -> DataFrame:
    """Add ``name_places`` and ``condition_error`` to mapping rows.

    ``name_places`` are the cell indexes of ``all_names`` in the sheet; -1 where it has no such
    column within the range. With a header, names are header texts, else column letters.
    """
    names = all_names(conditions)
    inside = F.transform(
        F.col("header_cells"),
        lambda h, i: F.when(i.between(F.col("from_col"), F.col("to_col")), F.lower(cl.clean_text(h))),
    )

    def place(name: str) -> Column:
        by_name = F.array_position("_low", F.lit(name.lower())).cast("int") - 1
        if re.fullmatch(r"[A-Za-z]{1,2}", name):
            letter = letters_to_number(F.lit(name.upper())) - 1
            by_letter = F.when(letter.between(F.col("from_col"), F.col("to_col")), letter).otherwise(-1)
        else:
            by_letter = F.lit(-1)
        return F.when(F.col("use_header"), F.coalesce(by_name, F.lit(-1))).otherwise(by_letter)

    listed = F.array(*map(place, names)) if names else F.array().cast("array<int>")
    placed = mapping.withColumn("_low", inside).withColumn("name_places", listed).drop("_low")
    error = F.lit(None).cast("string")
    for c in conditions:
        missing = [
            F.when(F.get("name_places", F.lit(i)) < 0, F.lit(n))
            for i, n in enumerate(names)
            if n.lower() in (x.lower() for x in c.names)
        ]
        unknown = F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>")
        said = F.lit(c.error) if c.error else F.when(
            F.size(unknown) > 0, F.concat(F.lit(f"{UNKNOWN}: "), F.array_join(unknown, ", "))
        )
        error = F.when(F.col("predicate") == c.text, said).otherwise(error)
    return placed.withColumn("condition_error", error)


def judged(rows: DataFrame, conditions: list[Condition], keys: Sequence[str] = ()) -> DataFrame:
    """Add ``passes`` and ``cast_failed`` to rows of ``predicate``, ``name_places`` and ``cells``.

    One CASE expression holds all conditions; each is evaluated only for the rows of its own sheets.
    ``keys`` are columns by which Spark may know that the rows are partitioned, and still does after this.
    """
    usable = [c for c in conditions if c.error is None]
    if not usable:
        return rows.withColumns({"passes": F.col("predicate").isNull(), "cast_failed": F.lit(False)})
    names = all_names(conditions)
    taken = {n.lower() for n in names}
    whole = next(w for w in ("row", "_row", "__row", *(f"row{i}" for i in range(len(taken) + 1)))
                 if not any(n == w or n.startswith(f"{w}_") for n in taken))
    cells = [F.get("cells", F.get("name_places", F.lit(i))) for i in range(len(names))]
    there = [F.get("name_places", F.lit(i)) >= 0 for i in range(len(names))]
    named = rows.select(
        F.struct(*[c for c in rows.columns if c not in keys]).alias(whole),
        *[F.col(c).alias(f"{whole}_{c}") for c in keys],
        *[F.when(t, c).alias(n) for n, t, c in zip(names, there, cells, strict=True)],
    )
    own = F.col(f"{whole}.predicate")
    passes, failed = F.when(own.isNull(), F.lit(True)), F.when(own.isNull(), F.lit(False))
    with lenient(rows.sparkSession):
        for c in usable:
            passes = passes.when(own == c.text, F.expr(quoted_names(c.text)))
            bad = F.lit(False)
            for operand, kind in c.casts:
                bad = bad | F.expr(f"({operand}) IS NOT NULL AND CAST({operand} AS {kind}) IS NULL")
            failed = failed.when(own == c.text, bad)
        return named.select(
            *[F.col(f"{whole}_{c}" if c in keys else f"{whole}.{c}").alias(c) for c in rows.columns],
            F.coalesce(passes, F.lit(False)).alias("passes"),
            F.coalesce(failed, F.lit(False)).alias("cast_failed"),
        )
