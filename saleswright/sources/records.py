"""Open JSON records from service responses as text tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.config import ENVELOPE_NAMES

# Names that become columns when the caller gives none.
MOST_COLUMNS = 2_000


def unpack_envelope(payloads: DataFrame, column: str, names: list[str] | None = None) -> DataFrame:
    """One row per record, as variant column ``record``.

    A payload is an array of records, or an object that holds the array under
    one of the names (the first that is an array), or one record.
    """
    body = F.try_parse_json(F.col(column))
    lists = [F.try_variant_get(body, "$", "array<variant>")]
    lists += [
        F.try_variant_get(body, f"$.{name}", "array<variant>") for name in names or ENVELOPE_NAMES
    ]
    records = F.coalesce(*lists, F.when(body.isNotNull(), F.array(body)))
    return payloads.withColumn("record", F.explode(records))


def cell_text(value: Column) -> Column:
    """A variant value as text: nothing is empty, lists and objects are JSON,
    booleans are TRUE or FALSE."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(value.isNull() | F.is_variant_null(value), F.lit(""))
        .when(kind == "BOOLEAN", F.upper(text))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.to_json(value))
        .otherwise(text)
    )


def record_names(records: DataFrame, column: str = "record") -> list[str]:
    """All names used by any record, sorted; more than ``MOST_COLUMNS`` are an error.

    They become columns. Where there may be more, keep them as data (``record_cells``).
    """
    keys = F.json_object_keys(F.to_json(F.col(column)))
    found = records.select(F.explode(keys).alias("name")).distinct().limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} names; give the names that are to be columns")
    return sorted(row["name"] for row in found)


def tabulate(
    records: DataFrame, keep: list[str] | None = None, names: list[str] | None = None,
    column: str = "record",
) -> DataFrame:
    """Records as text columns, one per name in sorted order, after the ``keep`` columns."""
    columns = names if names is not None else record_names(records, column)
    kept = keep or []
    fields = F.try_variant_get(F.col(column), "$", "map<string,variant>")
    return records.select(*kept, fields.alias("_f")).select(
        *kept, *[cell_text(F.try_element_at("_f", F.lit(c))).alias(c) for c in columns]
    )


def _as_cell(value: object) -> str:
    """A decoded JSON value as a report shows it: 10.0 stays 10.0, lists and objects keep their order."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (list, dict)):
        return json.dumps(value)
    # A lone half of a surrogate pair has no UTF-8 form.
    return str(value).encode("utf-8", "replace").decode()


def _record_cells(payload: str | None, names: list[str]) -> list[list[tuple[str, str]]]:
    try:
        body = json.loads(payload or "")
    except (ValueError, RecursionError):
        return []
    found = body
    if isinstance(body, dict):
        found = next((body[n] for n in names if isinstance(body.get(n), list)), [body])
    if not isinstance(found, list):
        return []
    return [
        [(str(k).encode("utf-8", "replace").decode(), _as_cell(v)) for k, v in r.items()] if isinstance(r, dict) else []
        for r in found
    ]


def record_cells(payloads: DataFrame, column: str, names: list[str] | None = None) -> DataFrame:
    """One row per record: ``record_no`` in its payload, from 0, and ``cells``, a map of name to text.

    Payloads are as for ``unpack_envelope``. Texts are those of the payload: numbers that were written
    with a point or an exponent stay decimal numbers, and objects keep the order of their names.
    Text that is no JSON has no records, and a record that is no object has no cells. Names are
    data here: ``cell_names`` lists them, ``cell_rows`` gives a row each, ``cell_columns``
    makes columns of those that the caller names, and nothing goes through the driver.
    """
    wanted = names or ENVELOPE_NAMES
    kind = pa.list_(pa.map_(pa.string(), pa.string()))

    def cells(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_record_cells(p, wanted) for p in batch.to_pylist()], kind)

    made = F.arrow_udf(cells, "array<map<string,string>>")(F.col(column).cast("string"))
    return payloads.withColumn("_records", made).select(
        *payloads.columns, F.posexplode("_records").alias("record_no", "cells")
    )


def cell_names(records: DataFrame) -> DataFrame:
    """Every name with the number of records that have it."""
    return records.select(F.explode(F.map_keys("cells")).alias("name")).groupBy("name").agg(
        F.count(F.lit(1)).alias("records")
    )


def cell_rows(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """A row for each cell: the ``keep`` columns, ``record_no``, ``name`` and ``text``."""
    return records.select(*(keep or []), "record_no", F.explode("cells").alias("name", "text"))


def cell_columns(records: DataFrame, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Records as text columns of the given names; a record without a name has an empty text."""
    cells = [F.coalesce(F.try_element_at("cells", F.lit(n)), F.lit("")).alias(n) for n in names]
    return records.select(*(keep or []), "record_no", *cells)
