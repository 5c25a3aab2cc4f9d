"""Audits over all line items: categories, exclusions, file counts and totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswright.config import CATEGORY_KEYWORDS, EXCLUSION_TERMS, FLAG_COLUMNS
from saleswright.operators import audits, reports
from saleswright.sources.files import pasted_counts
from workload import views as v
from workload.views import in_duckdb, in_spark, money, s

# One transaction per line item, with flags and earnings as text.
TRANSACTIONS = f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
 'Contractor ' || {s('l_suppkey % 10')} AS contractor_name, 'dist_' || {s('l_suppkey')} || '.csv' AS file_name,
 CASE WHEN l_partkey % 6 = 0 THEN p_name || ' Elbow 90' WHEN l_partkey % 6 = 1 THEN 'PVC tubing ' || p_name
  WHEN l_partkey % 6 = 2 THEN 'SOLID copper tube ' || p_name WHEN l_partkey % 6 = 3 THEN p_name || ' bushing NIBCO'
  WHEN l_partkey % 6 = 4 THEN 'Lasco ' || p_name || ' ipex union' END AS item_description,
 CASE WHEN l_linenumber % 4 = 0 THEN 'Y' WHEN l_linenumber % 4 = 1 THEN 'y' WHEN l_linenumber % 4 = 2 THEN ' Y ' END AS exclude,
 CASE WHEN l_linenumber % 3 = 0 THEN '0' WHEN l_linenumber % 3 = 1 THEN ' ' END AS potential_earnings,
 CASE WHEN l_orderkey % 4 = 0 THEN 'TRUE' WHEN l_orderkey % 4 = 1 THEN 'n' WHEN l_orderkey % 4 = 2 THEN '1' END AS pipe,
 CASE WHEN l_orderkey % 3 = 0 THEN 'Y' WHEN l_orderkey % 3 = 1 THEN '' END AS fittings
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey"""


def transactions(spark, sf):
    return v.raw_table(spark, sf, TRANSACTIONS)


def category_discrepancies(spark, sf):
    return audits.category_discrepancies(transactions(spark, sf)).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "item_description",
        "keywords_found", "final_category", "highest_priority", "pipe", "fittings", "discrepancy_type",
    )


# The flags of the report that the view lacks, from the keys.
_FLAGS = [f for f in FLAG_COLUMNS if f not in ("pipe", "fittings", "exclude")]
_FLAG_SQL = ", ".join(f"CASE WHEN l_partkey % {i + 2} = 0 THEN 'Y' ELSE '' END AS {f}" for i, f in enumerate(_FLAGS))
_REPORT = f"SELECT t.*, {_FLAG_SQL} FROM ({TRANSACTIONS}) t"
_REPORT_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "item_description"]


def category_report(spark, sf):
    """The discrepancies with all flag columns beside them, in order."""
    found = audits.category_discrepancies(v.raw_table(spark, sf, _REPORT))
    rows = found.select(*_REPORT_ORDER, "keywords_found", "final_category", *FLAG_COLUMNS, "discrepancy_type")
    return reports.in_order(rows, [F.col(c) for c in _REPORT_ORDER])


_KEYWORDS = ", ".join(f"('{w}', '{c}', {p})" for w, c, p in CATEGORY_KEYWORDS)

def _category_sql(rows, flags):
    return f"""WITH k(keyword, category, priority) AS (VALUES {_KEYWORDS}), t AS (SELECT *, row_number() OVER () AS rid FROM ({rows}) x),
found AS (SELECT rid, l_orderkey, l_partkey, l_suppkey, l_linenumber, item_description, {flags},
 string_agg(keyword, ', ' ORDER BY keyword) AS keywords_found, max(priority) AS highest_priority,
 first(category ORDER BY priority DESC, position(keyword IN lower(item_description)), keyword) AS final_category
 FROM t JOIN k ON position(keyword IN lower(item_description)) > 0 GROUP BY ALL)
SELECT * EXCLUDE (rid) FROM (SELECT *, CASE
 WHEN final_category = 'pipe' AND lower(pipe) NOT IN ('y','1','true') THEN 'Should be marked as pipe but pipe column is not true'
 WHEN final_category = 'fitting' AND lower(fittings) NOT IN ('y','1','true') THEN 'Should be marked as fitting but fittings column is not true'
 END AS discrepancy_type FROM found) x WHERE discrepancy_type IS NOT NULL"""


CATEGORY = _category_sql(TRANSACTIONS, "pipe, fittings")


def exclusion_report(spark, sf):
    return audits.exclusion_report(transactions(spark, sf))


_TERMS = "CASE " + " ".join(
    f"WHEN contains(lower(item_description), '{t.lower()}') THEN '{t}'" for t in EXCLUSION_TERMS
) + " END"
EXCLUSIONS = f"""WITH t AS (SELECT *, {_TERMS} AS term, trim(coalesce(exclude, '')) AS flag FROM ({TRANSACTIONS}) x)
SELECT contractor_name, file_name, item_description, flag AS exclude, 'Found "' || term || '" but exclude is not "Y"' AS issue_type
 FROM t WHERE term IS NOT NULL AND flag <> 'Y' UNION ALL
SELECT contractor_name, file_name, item_description, flag, 'Found "' || term || '" but potential_earnings is not empty'
 FROM t WHERE term IS NOT NULL AND trim(potential_earnings) <> ''"""

# Expected counts as pasted lines, made from each supplier's own count: right, wrong, missing,
# repeated or under another name.
LOADED = f"SELECT ' dist ' || {s('l_suppkey')} || '.csv ' AS file_name FROM {{lineitem}}"
_NAME = f"'dist ' || {s('s_suppkey')} || '.csv'"
PASTED = f"""SELECT CASE WHEN s_suppkey % 6 = 0 THEN {_NAME} || '  ' || {s('n')}
 WHEN s_suppkey % 6 = 1 THEN ' ' || {_NAME} || ' ' || {s('n + 3')} || ' ' WHEN s_suppkey % 6 = 2 THEN {_NAME}
 WHEN s_suppkey % 6 = 3 THEN 'unknown ' || {s('s_suppkey')} || '.csv 5' WHEN s_suppkey % 6 = 4 THEN ''
 ELSE {_NAME} || ' ' || {s('n')} END AS value
FROM {{supplier}} JOIN (SELECT l_suppkey, count(*) AS n FROM {{lineitem}} GROUP BY l_suppkey) c ON s_suppkey = l_suppkey
UNION ALL SELECT {_NAME} || ' 7' FROM {{supplier}} WHERE s_suppkey % 12 = 0"""


def _reconciled(spark, sf):
    loaded = audits.loaded_counts(in_spark(spark, sf, LOADED))
    return audits.reconcile_counts(pasted_counts(in_spark(spark, sf, PASTED)), loaded)


RECONCILED = f"""WITH db AS (SELECT trim(file_name) AS f, count(*) AS db_count FROM ({LOADED}) l GROUP BY 1),
lines AS (SELECT trim(value) AS line FROM ({PASTED}) p WHERE trim(value) <> ''),
listed AS (SELECT CASE WHEN regexp_full_match(line, '.+\\s+[0-9]+') THEN trim(regexp_extract(line, '^(.+?)\\s+([0-9]+)$', 1)) ELSE line END AS f,
 CASE WHEN regexp_full_match(line, '.+\\s+[0-9]+') THEN CAST(regexp_extract(line, '([0-9]+)$', 1) AS BIGINT) END AS input_count FROM lines),
result AS (SELECT listed.f AS file_name, input_count, db_count, CASE WHEN db_count IS NULL THEN 'not found'
  WHEN input_count IS NULL THEN 'found (no input count)' WHEN input_count = db_count THEN 'found (count matches)'
  ELSE 'found (count mismatch: input=' || CAST(input_count AS VARCHAR) || ', db=' || CAST(db_count AS VARCHAR) || ')' END AS status
 FROM listed LEFT JOIN db ON listed.f = db.f UNION ALL
 SELECT f, NULL, db_count, 'MISSING' FROM db WHERE f NOT IN (SELECT f FROM listed))"""

TOTALS_HEADERS = "LIST('Order', 'x', ' Extended_Price ')"
# Order totals per customer: sheets with samples first, a few without a header.
TOTALS_GRID = f"""
SELECT 'store_' || {s('o_custkey')} || '.xlsx' AS file_name, 'Data' AS sheet_name, 2 AS sheet_ordinal, o_orderkey + 300 AS row_idx,
 CASE WHEN o_orderkey % 5 = 0 THEN LIST(NULL, NULL, {money('o_totalprice')}) WHEN o_orderkey % 5 = 1 THEN LIST('O', 'x', 'n/a')
  WHEN o_orderkey % 5 = 2 THEN LIST('O', NULL, '$5') ELSE LIST('O', o_orderpriority, {money('o_totalprice')}) END AS cells FROM {{orders}}
UNION ALL SELECT 'store_' || {s('c_custkey')} || '.xlsx', CASE WHEN c_custkey % 9 = 8 THEN 'All SAMPLES' ELSE 'Data' END, 2,
 CAST(CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 250 END AS BIGINT), CASE WHEN c_custkey % 7 = 6 THEN LIST('Order', 'x', 'price') ELSE {TOTALS_HEADERS} END FROM {{customer}}
UNION ALL SELECT 'store_' || {s('c_custkey')} || '.xlsx', 'Sample data', 0, CAST(1 AS BIGINT), LIST('extended_price', '5', '6') FROM {{customer}}
UNION ALL SELECT 'store_' || {s('c_custkey')} || '.xlsx', 'Sample data', 0, CAST(2 AS BIGINT), LIST('7', '5', '6') FROM {{customer}}"""


def file_totals(spark, sf):
    return audits.file_totals(v.landed(spark, sf, "totals_grid", TOTALS_GRID))


# Customers whose every sheet with an order is usable; a sample sheet of that number holds no orders.
FILE_TOTALS = f"""SELECT '''store_' || CAST(c_custkey AS VARCHAR) || '.xlsx' AS file_name,
 CASE WHEN c_custkey % 7 = 6 OR c_custkey % 9 = 8 THEN 0 ELSE coalesce(n, 0) END AS transaction_count,
 CASE WHEN c_custkey % 7 = 6 OR c_custkey % 9 = 8 THEN 0.0 ELSE coalesce(total, 0.0) END AS sales_total
FROM {{customer}} LEFT JOIN (SELECT o_custkey, count(*) FILTER (o_orderkey % 5 <> 0) AS n,
 CAST(sum(CASE WHEN o_orderkey % 5 IN (0, 3, 4) THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS total
 FROM {{orders}} GROUP BY o_custkey) o ON c_custkey = o_custkey"""

# Some stores have an empty first sheet, some have no sheet with a row, and some files are unreadable.
STORE_SHEETS = """SELECT 'store_' || CAST(c_custkey AS STRING) || '.xlsx' AS file_name, 'Front' AS sheet_name, -1 AS sheet_ordinal FROM {customer} WHERE c_custkey % 13 = 5
 UNION ALL SELECT 'empty_' || CAST(c_custkey AS STRING) || '.xlsx', 'Sheet1', 0 FROM {customer} WHERE c_custkey % 17 = 3
 UNION ALL SELECT 'samples_' || CAST(c_custkey AS STRING) || '.xlsx', 'Sample', 0 FROM {customer} WHERE c_custkey % 17 = 4"""
BROKEN = "SELECT 'broken_' || CAST(c_custkey AS STRING) || '.xlsx' AS file_name FROM {customer} WHERE c_custkey % 19 = 2"


def file_totals_inventory(spark, sf):
    return audits.file_totals(
        v.landed(spark, sf, "totals_grid", TOTALS_GRID), unreadable=in_spark(spark, sf, BROKEN), sheets=in_spark(spark, sf, STORE_SHEETS)
    )


INVENTORY_TOTALS = f"""SELECT file_name, CASE WHEN k % 13 = 5 THEN 0 ELSE transaction_count END AS transaction_count,
 CASE WHEN k % 13 = 5 THEN 0.0 ELSE sales_total END AS sales_total FROM (SELECT *, CAST(regexp_extract(file_name, '[0-9]+') AS BIGINT) AS k FROM ({FILE_TOTALS}) f) g
 UNION ALL SELECT DISTINCT chr(39) || file_name, 0, 0.0 FROM ({STORE_SHEETS}) e WHERE file_name NOT LIKE 'store%'
 UNION ALL SELECT chr(39) || file_name, NULL, NULL FROM ({BROKEN}) b"""
CATEGORY_REPORT = _category_sql(_REPORT, ', '.join(FLAG_COLUMNS))
CATEGORY_REPORT = f"""SELECT row_number() OVER (ORDER BY {', '.join(_REPORT_ORDER)}) AS row_number, {', '.join(_REPORT_ORDER)}, keywords_found, final_category,
 {', '.join(FLAG_COLUMNS)}, discrepancy_type FROM ({CATEGORY_REPORT}) c"""

ALL = {
    "category_report": (category_report, in_duckdb(CATEGORY_REPORT)),
    "file_totals_inventory": (file_totals_inventory, in_duckdb(INVENTORY_TOTALS)),
    "category_discrepancies": (category_discrepancies, in_duckdb(CATEGORY)),
    "exclusion_report": (exclusion_report, in_duckdb(EXCLUSIONS)),
    "reconcile_counts": (_reconciled, in_duckdb(RECONCILED + " SELECT * FROM result")),
    "reconcile_summary": (
        lambda spark, sf: audits.reconcile_summary(_reconciled(spark, sf)),
        in_duckdb(RECONCILED + """ SELECT CASE WHEN contains(status, 'count mismatch') THEN 'found (count mismatch)'
 ELSE status END AS status_class, count(*) AS n_files FROM result GROUP BY 1"""),
    ),
    "file_totals": (file_totals, in_duckdb(FILE_TOTALS)),
}
