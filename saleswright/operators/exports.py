"""Transaction rows to request documents, as JSON and as block text."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.config import DEFAULT_TRANSACTION_TYPE, DEFAULT_UOM
from saleswright.functions.cleaning import clean_text, iso_text, leading_number
from saleswright.functions.display import padded, short_number
from saleswright.functions.text import comma_list, stable_uuid
from saleswright.scale import PAGE_ROWS, attach, number_rows, paged

# Input columns; purchaser_id and seller_key stand for the dotted sheet headers.
EXPORT_COLUMNS = [
    "request_id", "transaction_id", "invoice_date", "sku_key", "uom_key", "quantity", "amount",
    "transaction_type", "earnings", "purchaser_id", "seller_key", "offer_key", "participant_key",
    "status",
]


def undotted(df: DataFrame) -> DataFrame:
    """Rename purchaser.id and seller.key to names without dots."""
    return df.withColumnsRenamed({"purchaser.id": "purchaser_id", "seller.key": "seller_key"})


def status_text(df: DataFrame) -> Column:
    return F.lower(clean_text(F.col("status")))


def eligible_rows(df: DataFrame) -> DataFrame:
    """Rows that are not blank and whose status is not skip."""
    any_value = F.concat(*[clean_text(F.col(c).cast("string")) for c in EXPORT_COLUMNS])
    return df.filter((any_value != "") & (status_text(df) != "skip"))


def pending_rows(df: DataFrame) -> DataFrame:
    return eligible_rows(df).filter(status_text(df) == "pending")


def rows_of_requests(df: DataFrame, request_ids: str) -> DataFrame:
    """Rows of the request ids in a comma list, whatever their status."""
    wanted = [w for w in (p.strip() for p in request_ids.split(",")) if w]
    return eligible_rows(df).filter(clean_text(F.col("request_id")).isin(wanted))


def rows_of_request_table(df: DataFrame, requests: DataFrame, column: str = "request_id") -> DataFrame:
    """Rows whose request id occurs in a table of comma lists."""
    ids = requests.select(F.explode(comma_list(F.col(column))).alias("_id")).distinct()
    rows = eligible_rows(df).withColumn("_id", clean_text(F.col("request_id")))
    return attach(rows, ids, ["_id"], how="left_semi").drop("_id")


def set_status(df: DataFrame, selected: Column, status: str) -> DataFrame:
    """Set the status of the selected rows: pending, exported, or empty text to reset."""
    return df.withColumn("status", F.when(selected, F.lit(status)).otherwise(F.col("status")))


def set_status_of(df: DataFrame, ids: DataFrame, key: str, status: str) -> DataFrame:
    """Set the status of the rows whose key is in a table."""
    marks = ids.select(key).distinct().withColumn("_picked", F.lit(True))
    picked = attach(df, marks, [key], how="left")
    return set_status(picked, F.col("_picked"), status).drop("_picked")


def mark_exported(df: DataFrame) -> DataFrame:
    """After an export of the pending rows: pending becomes exported."""
    return set_status(df, status_text(df) == "pending", "exported")


def count_requests(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct(clean_text(F.col("request_id"))).alias("n_requests"))


def clean_transactions(df: DataFrame) -> DataFrame:
    """Trimmed text, lenient numbers and ISO dates, ready to be grouped."""
    texts = ["transaction_id", "transaction_type", "sku_key", "uom_key", "seller_key",
             "purchaser_id", "offer_key", "participant_key"]
    return df.select(
        "row_idx",
        clean_text(F.col("request_id")).alias("request_id"),
        *[clean_text(F.col(c)).alias(c) for c in texts],
        *[
            leading_number(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c)
            for c in ("quantity", "amount", "earnings")
        ],
        iso_text(F.col("invoice_date")).alias("invoice_date"),
    )


def has_incentive() -> Column:
    return (F.col("offer_key") != "") & (F.col("earnings") > 0)


# -- block text -------------------------------------------------------------


def _quoted(name: str) -> Column:
    return F.concat(F.lit('"'), F.col(name), F.lit('"'))


def _entries(indent: int, entries: list[tuple[str, Column]]) -> list[Column]:
    return [F.concat(F.lit(" " * indent + f'"{key}": '), value) for key, value in entries]


def _braced(indent: int, inner: list[Column]) -> list[Column]:
    return [F.lit(" " * indent + "{"), *inner, F.lit(" " * indent + "}")]


def _nested(indent: int, key: str, inner: tuple[str, Column]) -> list[Column]:
    return [
        F.lit(" " * indent + f'"{key}": {{'),
        *_entries(indent + 4, [inner]),
        F.lit(" " * indent + "}"),
    ]


def transaction_text(shift: int = 0) -> Column:
    """One transaction as block text, from ``clean_transactions`` columns."""
    pad = 12 + shift
    incentive = F.concat_ws(
        "\n",
        F.lit("["),
        F.lit(" " * (pad + 8) + "{"),
        F.concat(F.lit(" " * (pad + 12)), _quoted("offer_key"), F.lit(": "), short_number(F.col("earnings"))),
        F.lit(" " * (pad + 8) + "}"),
        F.lit(" " * (pad + 4) + "]"),
    )
    lines = _entries(
        pad,
        [
            ("transaction_id", _quoted("transaction_id")),
            ("transaction_type", _quoted("transaction_type")),
            ("sku_key", _quoted("sku_key")),
            ("uom_key", _quoted("uom_key")),
            ("quantity", short_number(F.col("quantity"))),
            ("amount", short_number(F.col("amount"))),
            ("invoice_date", _quoted("invoice_date")),
        ],
    )
    lines += _nested(pad, "seller", ("key", _quoted("seller_key")))
    lines += _nested(pad, "purchaser", ("id", _quoted("purchaser_id")))
    lines += _entries(
        pad, [("expected_incentives", F.when(has_incentive(), incentive).otherwise("[]"))]
    )
    return F.concat_ws("\n", *_braced(pad - 4, lines))


def request_text(df: DataFrame, page_rows: int | None = PAGE_ROWS) -> DataFrame:
    """One text block per request: (request_id, part_no, first_row, participant_key, block).

    Blocks follow the first row of each request; ``first_row`` gives that order. Every
    request is cut into parts of ``page_rows`` rows.
    """
    rows = clean_transactions(df).withColumn("text", transaction_text())
    parts = paged(rows, ["request_id"], "row_idx", page_rows)
    blocks = parts.groupBy("request_id", "part_no").agg(
        F.min("row_idx").alias("first_row"),
        F.min_by("participant_key", "row_idx").alias("participant_key"),
        F.array_sort(F.collect_list(F.struct("row_idx", "text"))).alias("t"),
    )
    body = F.array_join(F.transform("t", lambda t: t["text"]), "\n")
    block = F.concat_ws(
        "\n",
        F.lit("{"),
        *_entries(4, [("request_id", _quoted("request_id")), ("participant_key", _quoted("participant_key"))]),
        F.lit('    "transactions": ['),
        body,
        F.lit("    ]"),
        F.lit("}"),
    )
    return blocks.select("request_id", "part_no", "first_row", "participant_key", block.alias("block"))


# -- documents --------------------------------------------------------------


def request_documents(
    df: DataFrame, page_rows: int | None = PAGE_ROWS, run_id: str | None = None
) -> DataFrame:
    """The exported rows as nested documents.

    All rows go under the first request id and participant, without seller and
    incentives. They are cut into pages of ``page_rows`` rows, and each page is a document with
    the same heading.
    """
    rows = clean_transactions(df)
    heading = rows.agg(
        F.min_by("request_id", "row_idx").alias("request_id"),
        F.min_by("participant_key", "row_idx").alias("participant_key"),
    ).first()
    nothing = F.array().cast("array<string>")
    transaction = F.struct(
        "row_idx", "transaction_id", "transaction_type", "sku_key", "uom_key", "quantity",
        "amount", "invoice_date", nothing.alias("properties"),
        F.struct(F.col("purchaser_id").alias("id")).alias("purchaser"),
    )
    grouped = (
        paged(rows.withColumn("_all", F.lit(0)), ["_all"], "row_idx", page_rows)
        .groupBy("part_no")
        .agg(F.array_sort(F.collect_list(transaction)).alias("t"))
    )
    request_id = F.lit(heading["request_id"]).cast("string")
    entity = F.struct(
        stable_uuid(F.lit(run_id or uuid.uuid4().hex), request_id, F.col("part_no").cast("string")).alias("id"),
        nothing.alias("properties"),
        F.transform("t", lambda t: t.dropFields("row_idx")).alias("transactions"),
    )
    return grouped.select(
        F.lit(heading["participant_key"]).cast("string").alias("participant_key"),
        request_id.alias("request_id"),
        "part_no",
        nothing.alias("properties"),
        F.array(entity).alias("entities"),
        nothing.alias("relationships"),
    )


# -- scenario examples ------------------------------------------------------


def fill_defaults(transactions: DataFrame) -> DataFrame:
    """Defaults for older scenario rows: type, unit, 2-digit ordinal id, empty seller.

    Needs scenario_id, test_id and row_idx.
    """
    numbered = number_rows(transactions, ["scenario_id", "test_id"], "row_idx", "_no")

    def or_else(name: str, default: Column) -> Column:
        value = F.col(name).cast("string")
        return F.coalesce(F.when(value != "", value), default)

    return numbered.withColumns(
        {
            "transaction_type": or_else("transaction_type", F.lit(DEFAULT_TRANSACTION_TYPE)),
            "uom": or_else("uom", F.lit(DEFAULT_UOM)),
            "txn_id": or_else("txn_id", padded(F.col("_no"), 2)),
            "seller": or_else("seller", F.lit("")),
            "offer_key": or_else("offer_key", F.lit("")),
        }
    ).drop("_no")


def scenario_text(transactions: DataFrame, participant_key: str, page_rows: int | None = PAGE_ROWS) -> DataFrame:
    """One text block per scenario test: (scenario_id, test_id, part_no, block).

    Takes ``fill_defaults`` rows with quantity, total and date text and the test's
    ``earnings``, which is repeated on every transaction. Every test is cut into parts of
    ``page_rows`` rows.
    """
    pad = 16
    def raw(name: str) -> Column:
        return F.coalesce(F.when(F.col(name) != "", F.col(name)), F.lit("0"))

    lines = _entries(
        pad,
        [
            ("transaction_id", _quoted("txn_id")),
            ("transaction_type", _quoted("transaction_type")),
            ("sku_key", _quoted("sku")),
            ("uom_key", _quoted("uom")),
            ("quantity", raw("quantity")),
            ("amount", raw("total")),
            ("invoice_date", _quoted("date")),
        ],
    )
    lines += _nested(pad, "seller", ("key", _quoted("seller")))
    lines += [
        F.lit(" " * pad + '"expected_incentives": ['),
        F.lit(" " * (pad + 4) + "{"),
        F.concat(
            F.lit(" " * (pad + 8)), _quoted("offer_key"), F.lit(": "),
            short_number(F.coalesce("earnings", F.lit(0.0))),
        ),
        F.lit(" " * (pad + 4) + "}"),
        F.lit(" " * pad + "]"),
    ]
    text = F.concat_ws("\n", *_braced(pad - 4, lines))
    keyed = transactions.withColumn("text", text)
    parts = paged(keyed, ["scenario_id", "test_id"], "row_idx", page_rows)
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "text"))), lambda t: t["text"]), "\n"
    )
    block = F.concat_ws(
        "\n",
        F.lit("    {"),
        *_entries(8, [("request_id", _quoted("test_id")), ("participant_key", F.lit(f'"{participant_key}"'))]),
        F.lit('        "transactions": ['),
        F.col("body"),
        F.lit("        ]"),
        F.lit("    }"),
    )
    return (
        parts.groupBy("scenario_id", "test_id", "part_no")
        .agg(body.alias("body"))
        .select("scenario_id", "test_id", "part_no", block.alias("block"))
    )
