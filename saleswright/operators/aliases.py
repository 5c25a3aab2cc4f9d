"""Header words to fields: dictionaries, layout rules, saved and confirmed mappings.

All of these work on tables with one row per sheet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.config import LayoutRule
from saleswright.functions.cleaning import strip
from saleswright.functions.text import normal_header


def header_for(headers: Column, words: list[str], skip_single: bool) -> Column:
    """The header that equals the first listed word, without regard to case.

    Of repeated headers the last one is taken. With ``skip_single`` headers of
    one character are not looked at.
    """
    lowered = F.transform(headers, lambda h: F.lower(strip(h)))
    if skip_single:
        lowered = F.transform(lowered, lambda h: F.when(F.length(h) > 1, h).otherwise(F.lit("")))
    listed = list(dict.fromkeys(w.lower().strip() for w in words))
    present = F.filter(F.array(*[F.lit(w) for w in listed]), lambda w: F.array_contains(lowered, w))
    word = F.get(present, F.lit(0))
    place = F.size(lowered) - F.array_position(F.reverse(lowered), word).cast("int")
    return F.when(word.isNotNull() & (word != ""), strip(F.get(headers, place)))


def layout_overrides(headers: Column, rules: list[LayoutRule]) -> Column:
    """Field -> header of the first rule all of whose triggers are present, compared exactly."""
    none = F.create_map().cast("map<string,string>")
    chosen = none
    for rule in reversed(rules):
        fires = F.size(F.array_except(F.array(*[F.lit(t) for t in rule.triggers]), headers)) == 0
        pairs = [F.lit(x) for pair in rule.overrides.items() for x in pair]
        chosen = F.when(fires, F.create_map(*pairs)).otherwise(chosen)
    return chosen


def rule_number(headers: Column, rules: list[LayoutRule]) -> Column:
    """1-based number of the rule that applies, NULL when none does."""
    return F.coalesce(
        *[
            F.when(
                F.size(F.array_except(F.array(*[F.lit(t) for t in rule.triggers]), headers)) == 0,
                F.lit(i),
            )
            for i, rule in enumerate(rules, start=1)
        ]
    )


def header_positions(headers: Column, wanted: Column) -> Column:
    """Field -> 0-based index for a map of field -> header text; absent headers drop out."""
    normal = F.transform(headers, lambda h: normal_header(F.coalesce(h, F.lit(""))))
    places = F.transform_values(
        wanted, lambda _, h: (F.array_position(normal, normal_header(h)) - 1).cast("int")
    )
    return F.map_filter(places, lambda _, i: i >= 0)


def saved_by_signature(saved: DataFrame) -> DataFrame:
    """Saved (signature, field, header) rows as one map per signature."""
    return saved.groupBy("signature").agg(
        F.map_from_entries(
            F.array_sort(F.collect_set(F.struct("field", "header")))
        ).alias("saved_headers")
    )


def apply_saved(sheets: DataFrame, saved: DataFrame) -> DataFrame:
    """Let a saved mapping of the same header signature replace the detected one.

    ``sheets`` has ``signature``, ``header_cells`` and ``col_map``. Adds
    ``from_saved``.
    """
    joined = sheets.join(saved_by_signature(saved), "signature", "left")
    from_saved = F.col("saved_headers").isNotNull()
    positions = header_positions(F.col("header_cells"), F.col("saved_headers"))
    return (
        joined.withColumn("from_saved", from_saved)
        .withColumn("col_map", F.when(from_saved, positions).otherwise(F.col("col_map")))
        .drop("saved_headers")
    )


def merge_maps(detected: Column, confirmed: Column) -> Column:
    """Confirmed positions win over detected ones; a detected field cannot be dropped."""
    kept = F.map_filter(detected, lambda k, _: ~F.map_contains_key(confirmed, k))
    return F.when(confirmed.isNull(), detected).otherwise(F.map_concat(kept, confirmed))


def missing_fields(col_map: Column, required: list[str]) -> Column:
    """Required fields without a position, in the listed order."""
    names = F.array(*[F.lit(r) for r in required]) if required else F.array().cast("array<string>")
    held = F.coalesce(F.map_keys(col_map), F.array().cast("array<string>"))
    return F.filter(names, lambda r: ~F.array_contains(held, r))
