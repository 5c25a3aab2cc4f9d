"""Dirty distributor data made from the given tables.

Each view is SQL text that Spark and DuckDB both read, so a query and its oracle
start from the same rows. Table names are written {lineitem}; LIST( builds an array
and SERIAL( a spreadsheet day number. Every view covers its whole tables.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

from saleswright.scale import compiled, scratch_path, shuffles_removed

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_spark(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    text = text.replace("LIST(", "array(")
    text = re.sub(r"SERIAL\((\w+)\)", r"datediff(\1, DATE '1899-12-30')", text)
    used = {n: table(spark, sf_dir, n) for n in TABLES if f"{{{n}}}" in text}
    return spark.sql(text, **used)


def in_duckdb(text: str) -> str:
    text = text.replace("LIST(", "list_value(")
    text = re.sub(r"SERIAL\((\w+)\)", r"(\1 - DATE '1899-12-30')", text)
    for name in TABLES:
        text = text.replace(f"{{{name}}}", name)
    return text


def s(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def money(expression: str) -> str:
    return s(f"CAST({expression} AS DECIMAL(18,2))")


# One row per supplier, order and line; the pair of order and line repeats in the source.
LINES = f"""
SELECT l_suppkey AS s, l_orderkey AS o, l_linenumber AS n, max(l_partkey) AS p,
       CAST(sum(l_quantity) AS BIGINT) AS qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS ext,
       max(CAST(l_shipdate AS DATE)) AS d
FROM {{lineitem}} GROUP BY l_suppkey, l_orderkey, l_linenumber
"""

SHORT_YEAR = f"lpad({s('year(d) % 100')}, 2, '0')"
US_DATE = f"{s('month(d)')} || '/' || {s('day(d)')} || '/'"

# Cell texts of one line; '' is an empty cell.
DIRTY = f"""
SELECT s, o, n, qty, ext,
  CASE WHEN o % 13 = 0 OR o % 11 = 0 THEN '' ELSE 'SO' || {s('o')} END AS order_txt,
  CASE WHEN o % 13 = 0 THEN ''
       WHEN o % 5 = 0 THEN {s('d')}
       WHEN o % 5 = 1 THEN {US_DATE} || {s('year(d)')}
       WHEN o % 5 = 2 THEN {US_DATE} || {SHORT_YEAR}
       WHEN o % 5 = 3 THEN {s('SERIAL(d)')}
       ELSE 'n/a' END AS date_txt,
  CASE WHEN o % 13 = 0 OR o % 11 = 0 THEN '' ELSE 'P-' || {s('p')} END AS sku_txt,
  CASE WHEN o % 11 = 0 OR o % 17 = 0 THEN ''
       WHEN p % 6 = 0 THEN p_name || ' Elbow 90'
       WHEN p % 6 = 1 THEN 'PVC tubing ' || p_name
       WHEN p % 6 = 2 THEN 'SOLID copper tube ' || p_name
       WHEN p % 6 = 3 THEN p_name || ' coupling union'
       ELSE p_name END AS desc_txt,
  CASE WHEN o % 13 = 0 THEN ''
       WHEN (o + n) % 6 = 0 THEN {s('qty')}
       WHEN (o + n) % 6 = 1 THEN {s('qty')} || ' EA'
       WHEN (o + n) % 6 = 2 THEN {s('qty')} || 'ft'
       WHEN (o + n) % 6 = 3 THEN '*' || {s('qty')}
       WHEN (o + n) % 6 = 4 THEN ''
       ELSE {s('qty')} || '.5' END AS qty_txt,
  CASE WHEN o % 13 = 0 OR (o + n) % 4 = 0 THEN ''
       WHEN (o + n) % 4 = 1 THEN '*' || {money('p_retailprice')}
       ELSE {money('p_retailprice')} END AS price_txt,
  CASE WHEN o % 13 = 0 THEN ''
       WHEN (o + n) % 7 = 0 THEN '(' || {s('ext')} || ')'
       WHEN (o + n) % 7 = 1 THEN '$' || {s('ext')}
       WHEN (o + n) % 7 = 2 THEN '#VALUE!'
       WHEN (o + n) % 7 = 3 THEN {s('1 + p % 90')} || ',' || lpad({s('o % 1000')}, 3, '0') || '.25'
       ELSE {s('ext')} END AS ext_txt,
  CASE WHEN o % 13 = 0 THEN ''
       WHEN o % 19 = 0 THEN '---'
       WHEN o % 23 = 0 THEN '* ='
       ELSE 'EA' END AS uom_txt
FROM ({LINES}) l JOIN {{part}} ON l.p = p_partkey
"""

FILE = "'dist_' || {} || '.csv'".format(s("s"))
SHEET = """CASE WHEN s % 3 = 0 THEN 'Reported Sales DATA' WHEN s % 3 = 1 THEN 'Sales detail'
 ELSE 'Sheet1' END"""
SHEET_ORDINAL = "CASE WHEN s % 3 = 2 THEN 0 ELSE 1 END"
HEADER_ROW = "1 + s % 6"
DATA_ROW = "10 + o * 8 + n"

HEADERS = {
    0: ["Order Number", "Order Date", "SKU", "Description", "Qty", "Unit Price", "Extended Price",
        "UOM"],
    1: ["Item  Description", "QTY", "Ext Price", "Invoice #", "Date", "Part Number", "Price",
        "UofM"],
    2: ["Order Number", "Order Date", "SKU", "Description", "Qty", "Unit Price", "Line Value",
        "UOM"],
    3: ["c1", "c2", "c3", "c4", "c5", "c6", "c7", "c8"],
}


def _list(items: list[str]) -> str:
    return "LIST(" + ", ".join(items) + ")"


HEADER_CELLS = "CASE " + " ".join(
    f"WHEN s % 4 = {k} THEN " + _list([f"'{h}'" for h in v]) for k, v in HEADERS.items()
) + " END"

_ORDER = ["order_txt", "date_txt", "sku_txt", "desc_txt", "qty_txt", "price_txt", "ext_txt",
          "uom_txt"]
_TURNED = ["desc_txt", "qty_txt", "ext_txt", "order_txt", "date_txt", "sku_txt", "price_txt",
           "uom_txt"]


def _cells(names: list[str]) -> str:
    return _list([f"nullif({n}, '')" for n in names])


_EMPTY = "CAST(NULL AS STRING)"
# A sheet per supplier and, for two of three suppliers, a first sheet that is not data.
GRID = f"""
SELECT {FILE} AS file_name, {SHEET} AS sheet_name, {SHEET_ORDINAL} AS sheet_ordinal,
       {DATA_ROW} AS row_idx,
       CASE WHEN s % 4 = 1 THEN {_cells(_TURNED)} ELSE {_cells(_ORDER)} END AS cells
FROM ({DIRTY}) d
UNION ALL
SELECT {FILE}, {SHEET}, {SHEET_ORDINAL}, CAST({HEADER_ROW} AS BIGINT), {HEADER_CELLS}
FROM (SELECT s_suppkey AS s FROM {{supplier}}) h
UNION ALL
SELECT {FILE}, {SHEET}, {SHEET_ORDINAL}, CAST(1 AS BIGINT),
       {_list(["'Sales of ' || s_name"] + [_EMPTY] * 7)}
FROM (SELECT s_suppkey AS s, s_name FROM {{supplier}}) b WHERE {HEADER_ROW} > 1
UNION ALL
SELECT {FILE}, {SHEET}, {SHEET_ORDINAL}, CAST(8 AS BIGINT),
       {_list(["'Total'", _EMPTY, "'x'", _EMPTY, "'12'", _EMPTY, "'99.00'", _EMPTY])}
FROM (SELECT s_suppkey AS s FROM {{supplier}}) t
UNION ALL
SELECT {FILE}, CASE WHEN s % 3 = 0 THEN 'Instructions' ELSE 'Notes' END, 0, CAST(1 AS BIGINT),
       {_list(["'How to fill this in'", "s_name"])}
FROM (SELECT s_suppkey AS s, s_name FROM {{supplier}}) i WHERE s % 3 <> 2
"""


_LANDED: dict[tuple[str, str, str], str] = {}


def landed_path(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """The folder of files that ``write`` leaves, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = scratch_path(spark, name)
        with compiled(spark), shuffles_removed(spark):
            write(path)
        _LANDED[key] = path
    return _LANDED[key]


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> DataFrame:
    return spark.read.parquet(landed_path(spark, sf_dir, name, write))


def landed(spark: SparkSession, sf_dir: str, name: str, text: str) -> DataFrame:
    """A view as files, as an ingest job would leave them: written once per session, whole.

    Rows are written where the view's own plan makes them. They are not dealt out again: that would
    shuffle and sort all of them once more, and a range's bounds would compute the view twice.
    """
    return _once(spark, sf_dir, name, lambda path: in_spark(spark, sf_dir, text).write.parquet(path))


def raw_table(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Dirty text rows as files."""
    return landed(spark, sf_dir, f"raw_{hashlib.md5(text.encode()).hexdigest()[:10]}", text)


def stored(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """A result that later steps read as a table, such as a loaded ledger."""
    return _once(spark, sf_dir, name, lambda path: make().write.parquet(path))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "sales_grid", GRID)


# -- DuckDB forms of the cleaning rules, used by the oracles -------------------

NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def d_int(x: str) -> str:
    return f"TRY_CAST({x} AS INT)"


def d_quantity(x: str) -> str:
    return (
        f"coalesce({d_int(x)}, "
        f"TRY_CAST(regexp_replace({x}, '([*]|,|ea|ft|pc)', '', 'gi') AS INT))"
    )


def d_amount(x: str) -> str:
    return (
        f"coalesce(TRY_CAST({x} AS DECIMAL(10,2)), TRY_CAST(nullif(regexp_replace({x}, "
        f"'([*]|,|#VALUE!|#DIV/0!)', '', 'g'), '') AS DECIMAL(10,2)))"
    )


def d_date(x: str) -> str:
    return (
        f"CASE WHEN nullif(trim({x}), '') IS NULL THEN NULL "
        f"WHEN {d_int(x)} IS NOT NULL THEN DATE '1899-12-30' + {d_int(x)} "
        f"ELSE coalesce(CAST(try_strptime(trim({x}), '%m/%d/%y') AS DATE), "
        f"CAST(try_strptime(trim({x}), '%m/%d/%Y') AS DATE), TRY_CAST(trim({x}) AS DATE)) END"
    )


def d_number(x: str) -> str:
    bare = f"replace(replace(trim({x}), '$', ''), ',', '')"
    signed = (
        f"CASE WHEN {bare} LIKE '(%)' THEN '-' || substr({bare}, 2, length({bare}) - 2) "
        f"ELSE {bare} END"
    )
    return f"TRY_CAST({signed} AS DOUBLE)"
