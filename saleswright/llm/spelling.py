"""Spelling variant grouping by permuterm rotations (operator 11).

Two words are near when one inserted, deleted or replaced character turns one into the other.

A word is marked with a terminator and written in all its rotations. A word with one
character changed or added keeps everything else, so among its rotations is one that ends
with that character: what stands before it is a prefix that all its near words share,

* as the prefix of their own rotation with another last character (a replacement), or
* as a whole rotation of the word without that character (an insertion or a deletion).

All rotations are dealt by that prefix and sorted, and each group is scanned once. A group
has at most one whole rotation and one row for each last character, so the alphabet bounds
it, whatever the number of words. No pairs are made for the summary: from the best two of
its group and their number, a row knows how many words are near it there and which is best.
The place of a replaced character is unique. Where a character was put into a run of equal
ones, the first of the run counts, so no pair counts twice.

Words are told apart by their code points. Null words are left out; of repeated words the
counts are added. The empty word is a word. Words holding the terminator (U+0000) have no
near words. Empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright.llm.common import LOWER, UPPER, column, text_of
from saleswright.scale import settled

END = "\u0000"
# A word's form has at least so many times its own count.
FORM_TIMES = 10


def _lowered(word: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def run_counts(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    letters: str = "A-Za-zÀ-ÿ",
    min_chars: int = 7,
    min_count: int = 2,
    typo_one_in: int | None = None,
) -> DataFrame:
    """``word`` and ``n`` of the maximal runs of ``letters``, A-Z lower-cased.

    ``typo_one_in`` takes a character out of one in so many runs, by the checksum of key and
    run, as a test of what finds it again; a null key counts as empty there. Null texts have
    no words. Shorter and rarer words are left out.
    """
    runs = F.regexp_extract_all(text_of(text), F.lit(f"[{letters}]{{{max(min_chars, 1)},}}"), F.lit(0))
    word = F.col("word")
    rows = df.select(
        F.coalesce(column(key).cast("string"), F.lit("")).alias("key"), F.explode(runs).alias("word")
    ).withColumn("word", _lowered(word))
    if typo_one_in:
        check = F.crc32(F.concat("key", F.lit(":"), "word").cast("binary"))
        at = F.pmod("check", F.char_length(word)).cast("int")
        left, right = F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word))
        rows = rows.withColumn("check", check).withColumn(
            "word",
            F.when(F.col("check") % typo_one_in == 0, F.concat(left, right)).otherwise(word),
        )
    long = rows.filter(F.char_length(word) >= min_chars)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """Every rotation as the prefix of its group and its last character.

    ``last`` is null for a whole rotation, which is a group's prefix itself.
    """
    marked = words.filter(~F.col("word").contains(END))
    size = F.char_length("word")
    at = F.col("at")
    right = F.substring(F.col("word"), at + 1, size)
    left = F.substring(F.col("word"), F.lit(1), at)
    whole = F.struct(F.concat(right, F.lit(END), left).alias("prefix"), F.lit(None).cast("string").alias("last"))
    cut = F.struct(
        F.concat(F.substring(F.col("word"), at + 2, size), F.lit(END), left).alias("prefix"),
        F.substring(F.col("word"), at + 1, F.lit(1)).alias("last"),
    )
    both = F.when(at < size, F.array(whole, cut)).otherwise(F.array(whole))
    return (
        marked.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("at"))
        .select("n", F.explode(both).alias("rotation"))
        .select("n", "rotation.*")
    )


def _word_of(prefix: Column, last: Column) -> Column:
    """The word behind a rotation."""
    right = F.substring_index(prefix, END, 1)
    left = F.substring_index(prefix, END, -1)
    return F.concat(left, F.coalesce(last, F.lit("")), right)


def _before(prefix: Column) -> Column:
    """The character before the last one in the word; the terminator at a word's start."""
    return F.substring(prefix, -1, 1)


def near_summary(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near`` and its best near word, ``best`` and ``best_n``.

    The best is the one of largest ``n``, of equals the smallest by code points.
    """
    group = (
        Window.partitionBy("prefix")
        .orderBy(F.col("last").isNull(), F.col("n").desc(), "last")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    before, last = _before(F.col("prefix")), F.col("last")
    one = F.struct(F.when(last.isNotNull(), F.col("n")).alias("n"), last.alias("last"))
    scanned = rotations(words).select(
        "*",
        F.count("last").over(group).alias("cuts"),
        F.max(F.when(last.isNull(), F.col("n"))).over(group).alias("whole_n"),
        F.count(F.when(last != before, 1)).over(group).alias("added"),
        F.first(one).over(group).alias("first"),
        F.nth_value(one, 2).over(group).alias("second"),
    )
    is_whole, new = last.isNull(), last != before
    # A whole rotation is near the cut ones whose last character is new; a cut one is near all
    # other cut ones, and near the whole one if its own character is new.
    n_near = F.when(is_whole, F.col("added")).otherwise(
        F.col("cuts") - 1 + F.when(new & F.col("whole_n").isNotNull(), 1).otherwise(0)
    )
    top = F.when(F.col("first.last") != F.when(is_whole, before).otherwise(last), F.col("first")).otherwise(
        F.col("second")
    )

    def ranked(n: Column, added: Column) -> Column:
        return F.struct((-n).alias("less"), _word_of(F.col("prefix"), added).alias("word"))

    beside = F.when(top["last"].isNotNull(), ranked(top["n"], top["last"]))
    shorter = F.when(
        ~is_whole & new & F.col("whole_n").isNotNull(), ranked(F.col("whole_n"), F.lit(""))
    )
    # Null structs are passed over; of two, the smaller has the larger count.
    found = scanned.select(
        _word_of(F.col("prefix"), last).alias("word"),
        n_near.alias("n_near"),
        F.least(beside, shorter).alias("best"),
    ).filter("n_near > 0")
    kind = found.schema["best"].dataType.simpleString()
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast(kind).alias("best"))
    rows = alone.unionByName(found.withColumn("n", F.lit(None).cast("long")))
    return (
        rows.groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
        .select("word", "n", "n_near", F.col("best.word").alias("best"), (-F.col("best.less")).alias("best_n"))
    )


def neighbours(words: DataFrame) -> DataFrame:
    """All near words as rows of ``word`` and ``other``, each pair once in both directions."""
    groups = (
        rotations(words)
        .groupBy("prefix")
        .agg(F.collect_set("last").alias("lasts"), F.max(F.col("last").isNull()).alias("whole"))
        .filter((F.size("lasts") + F.col("whole").cast("int")) > 1)
    )
    before = _before(F.col("prefix"))
    cut = groups.select("prefix", "lasts", "whole", F.explode("lasts").alias("a"))
    swaps = cut.withColumn("b", F.explode("lasts")).filter("a <> b")
    added = cut.filter(F.col("whole") & (F.col("a") != before))

    def pair(a: Column, b: Column) -> list[Column]:
        return [_word_of(F.col("prefix"), a).alias("word"), _word_of(F.col("prefix"), b).alias("other")]

    return (
        swaps.select(*pair(F.col("a"), F.col("b")))
        .unionByName(added.select(*pair(F.col("a"), F.lit(""))))
        .unionByName(added.select(*pair(F.lit(""), F.col("a"))))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the last form reached from each word that has one.

    Counts grow along forms, so there is no cycle, and each round doubles the steps taken.
    """
    now = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = settled(now.join(further, "root", "left"))
        if step.filter("next IS NOT NULL").isEmpty():
            return now
        now = step.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """Group spelling variants: ``word, n, n_near, form, form_n, root``.

    ``words`` has the columns ``word`` and ``n``. A word's form is its best near word where
    that has at least ``times`` its count (2 or more); the root is the last form that is
    reached, or the word itself.
    """
    if times < 2:
        raise ValueError("times must be 2 or more")
    counted = words.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    found = near_summary(settled(counted))
    is_form = F.col("best_n") >= times * F.col("n")
    formed = settled(
        found.select(
            "word",
            "n",
            "n_near",
            F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        )
    )
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
