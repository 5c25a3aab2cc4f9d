"""Flat transactions to participant documents and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.functions.cleaning import plain_number, strict_us_date
from saleswright.scale import PAGE_ROWS, paged

FLAT_COLUMNS = [
    "participant_key", "entity_id", "transaction_id", "transaction_type", "sku_key", "uom_key",
    "quantity", "amount", "invoice_date", "purchaser_id", "seller_key",
]


def nest_transactions(flat: DataFrame, order: str = "row_idx", page_rows: int | None = PAGE_ROWS) -> DataFrame:
    """One document per participant: entities, each with its transactions in row order.

    Every participant's transactions are cut into pages of ``page_rows`` rows and each page
    is a document, told apart by ``part_no``. Dates must be m/d/yy.
    """
    nothing = F.array().cast("array<string>")
    filled = {
        c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
        for c in ("purchaser_id", "seller_key")
    }
    transaction = F.struct(
        F.col(order).alias("_order"),
        "transaction_id",
        "transaction_type",
        "sku_key",
        "uom_key",
        plain_number(F.col("quantity").cast("string")).alias("quantity"),
        plain_number(F.col("amount").cast("string")).alias("amount"),
        strict_us_date(F.col("invoice_date")).cast("string").alias("invoice_date"),
        nothing.alias("properties"),
        F.when(
            filled["purchaser_id"].isNotNull(), F.struct(filled["purchaser_id"].alias("id"))
        ).alias("purchaser"),
        F.when(
            filled["seller_key"].isNotNull(), F.struct(filled["seller_key"].alias("key"))
        ).alias("seller"),
    )
    named = flat.withColumns(
        {c: F.coalesce(c, F.lit("")) for c in ("participant_key", "entity_id")}
    )
    parts = paged(named, ["participant_key"], order, page_rows)
    entities = (
        parts.select("participant_key", "part_no", "entity_id", transaction.alias("t"))
        .groupBy("participant_key", "part_no", "entity_id")
        .agg(F.array_sort(F.collect_list("t")).alias("t"))
    )
    entity = F.struct(
        F.get("t", F.lit(0))["_order"].alias("_order"),
        F.col("entity_id").alias("id"),
        nothing.alias("properties"),
        F.transform("t", lambda t: t.dropFields("_order")).alias("transactions"),
    )
    return (
        entities.select("participant_key", "part_no", entity.alias("e"))
        .groupBy("participant_key", "part_no")
        .agg(F.array_sort(F.collect_list("e")).alias("e"))
        .select(
            "participant_key",
            "part_no",
            F.lit("").alias("request_id"),
            nothing.alias("properties"),
            F.transform("e", lambda e: e.dropFields("_order")).alias("entities"),
            nothing.alias("relationships"),
        )
    )


def flatten_transactions(documents: DataFrame) -> DataFrame:
    """One row per transaction; missing parts are empty text."""
    rows = (
        documents.select("participant_key", F.explode("entities").alias("e"))
        .select("participant_key", F.col("e.id").alias("entity_id"), F.explode("e.transactions").alias("t"))
    )
    places = {
        "participant_key": "participant_key",
        "entity_id": "entity_id",
        "purchaser_id": "t.purchaser.id",
        "seller_key": "t.seller.key",
    }
    return rows.select(
        *[
            F.coalesce(F.col(places.get(c, f"t.{c}")).cast("string"), F.lit("")).alias(c)
            for c in FLAT_COLUMNS
        ]
    )
