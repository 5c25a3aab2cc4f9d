"""Changes between two product snapshots.

Both snapshots go into one aggregate by key, which gives each key its record on either side. All
changes are read from that table: a key on one side only was added or removed, and a key whose
product differs left the one product and came to the other. No side is joined with itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.scale import attach, settled

FIELDS = ["product_key", "superseded_by"]
# Lost keys of one product that one task pairs with all its gained ones, about.
PAIR_KEYS = 1_000


def latest_by_key(records: DataFrame) -> DataFrame:
    """One record per key: the one with the highest ``pos``."""
    return (
        records.groupBy("key")
        .agg(F.max_by(F.struct(*FIELDS), "pos").alias("r"))
        .select("key", "r.*")
    )


def both_sides(old: DataFrame, new: DataFrame) -> DataFrame:
    """``key, old, new``: the latest record of each key in either snapshot, or NULL.

    Inputs are records with ``pos``, or tables with one row per key. NULL is a key like any other.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        pos = F.col("pos") if "pos" in df.columns else F.lit(0)
        return df.select("key", F.struct(*FIELDS).alias(name), pos.alias(f"{name}_pos"))

    rows = side(old, "old").unionByName(side(new, "new"), allowMissingColumns=True)
    return rows.groupBy("key").agg(
        F.max_by("old", "old_pos").alias("old"), F.max_by("new", "new_pos").alias("new")
    )


def with_successors(sides: DataFrame) -> DataFrame:
    """Add ``successor``: whether a new record names the key as the one that replaces it."""
    named = F.col("new.superseded_by")
    none = F.lit(None)
    own = F.struct("key", "old", "new", F.lit(False).alias("successor"))
    kinds = {f.name: f.dataType for f in sides.schema}
    other = F.struct(
        named.alias("key"), none.cast(kinds["old"]).alias("old"), none.cast(kinds["new"]).alias("new"),
        F.lit(True).alias("successor"),
    )
    rows = sides.select(F.explode(F.array_compact(F.array(own, F.when(named != "", other)))).alias("r"))
    return (
        rows.select("r.*")
        .groupBy("key")
        .agg(
            F.first("old", ignorenulls=True).alias("old"),
            F.first("new", ignorenulls=True).alias("new"),
            F.max("successor").alias("successor"),
        )
        .filter("old IS NOT NULL OR new IS NOT NULL")
    )


def _members(sides: DataFrame) -> DataFrame:
    """``product_key, key, lost``: keys that a product has on one side only."""
    moved = ~F.coalesce(F.col("old.product_key").eqNullSafe(F.col("new.product_key")), F.lit(False))
    alone = F.col("old").isNull() | F.col("new").isNull()

    def member(name: str, lost: bool) -> Column:
        there = F.col(name).isNotNull() & (alone | moved)
        return F.when(
            there, F.struct(F.col(f"{name}.product_key").alias("product_key"), "key", F.lit(lost).alias("lost"))
        )

    found = F.array_compact(F.array(member("old", True), member("new", False)))
    return sides.select(F.explode(found).alias("m")).select("m.*")


def product_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per product, how many keys it lost and gained. Products without a key count as one product."""
    return (
        _members(both_sides(old, new))
        .groupBy("product_key")
        .agg(F.count_if("lost").alias("lost"), F.count_if(~F.col("lost")).alias("gained"))
    )


def change_log(old: DataFrame, new: DataFrame) -> DataFrame:
    """The change log with a row for each key, linear in the snapshots.

    Kinds are new, removed, lost, gained and change. A product that lost and gained keys has one row for
    each of them, with both numbers in ``lost_keys`` and ``gained_keys``; ``expand_updates`` makes
    the pairs. Superseded records are reported on every run.
    """
    sides = settled(with_successors(both_sides(old, new)))
    empty = F.lit("")

    def row(there: Column, kind: str, record: str, was: Column = empty, now: Column = empty, note: str = "") -> Column:
        return F.when(
            there,
            F.struct(
                F.col(f"{record}.product_key").alias("product_key"),
                "key",
                F.lit(kind).alias("change_type"),
                was.alias("old_sku_key"),
                now.alias("new_sku_key"),
                F.lit(note).alias("note"),
            ),
        )

    found = F.array_compact(
        F.array(
            row(F.col("old").isNull() & ~F.col("successor"), "new", "new"),
            row(F.col("new").isNull(), "removed", "old"),
            row(F.col("new.superseded_by") != "", "change", "new", F.col("key"), F.col("new.superseded_by"), "superseded"),
        )
    )
    plain = sides.select(F.explode(found).alias("r")).select("r.*")
    # Products without a key are one product; two columns that are never NULL say which it is.
    members = _members(sides).withColumns(
        {"_none": F.col("product_key").isNull(), "_product": F.coalesce("product_key", empty)}
    )
    classes = (
        members.groupBy("_none", "_product")
        .agg(F.count_if("lost").alias("lost_keys"), F.count_if(~F.col("lost")).alias("gained_keys"))
        .filter("lost_keys > 0 AND gained_keys > 0")
    )
    updated = attach(members, classes, ["_none", "_product"]).select(
        "product_key",
        "key",
        F.when(F.col("lost"), "lost").otherwise("gained").alias("change_type"),
        F.when(F.col("lost"), F.col("key")).otherwise(empty).alias("old_sku_key"),
        F.when(F.col("lost"), empty).otherwise(F.col("key")).alias("new_sku_key"),
        empty.alias("note"),
        "lost_keys",
        "gained_keys",
    )
    return plain.unionByName(updated, allowMissingColumns=True)


def expand_updates(log: DataFrame, pair_keys: int = PAIR_KEYS) -> DataFrame:
    """The change log with a row for each key a product lost with each it gained.

    These pairs are the report itself, so their number cannot be less. A product's lost keys are
    dealt into parts by their number, and its gained ones copied to each part, so many tasks make the
    pairs of a large product and a small one is not copied.
    """
    parts = F.ceil(F.col("lost_keys") / F.lit(pair_keys)).cast("int")
    rows = log.withColumns(
        {"_none": F.col("product_key").isNull(), "_product": F.coalesce("product_key", F.lit(""))}
    )
    lost = rows.filter("change_type = 'lost'").select(
        "_none", "_product", F.pmod(F.xxhash64("key"), parts).cast("int").alias("_part"),
        F.col("key").alias("old_sku_key"),
    )
    gained = rows.filter("change_type = 'gained'").select(
        "_none", "_product", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"),
        "product_key", "key",
    )
    pairs = lost.join(gained, ["_none", "_product", "_part"]).select(
        "product_key", "key", F.lit("updated").alias("change_type"), "old_sku_key",
        F.col("key").alias("new_sku_key"), F.lit("").alias("note"),
    )
    others = log.filter("change_type NOT IN ('lost', 'gained')")
    return others.select(*pairs.columns).unionByName(pairs)


def sku_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The change log with its pairs: new, removed, updated and change rows."""
    return expand_updates(settled(change_log(old, new)))
