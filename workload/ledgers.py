"""Payment-run load: mapping rows made from suppliers, one sheet per supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswright.config import BASE_LEDGER, CREDIT_LEDGER
from saleswright.operators import ledger_checks as lc
from saleswright.plans.payment_run import normalize_transactions
from workload import views as v
from workload.views import in_duckdb, in_spark, s

LAST_ROW = "999999999999"
# Layout 3 has no usable header, so it is addressed by letters; one supplier in five has a
# condition, one in seven is not processed, one in eleven names a column that is not there.
# Of thirty suppliers four have other conditions: one names an unknown column, one is no SQL, one
# casts texts that are no numbers, and one casts texts that are.
LETTERS = dict(zip(v._ORDER, "ABCDEFGH"))
QUOTED = {
    k: dict(zip(v._TURNED if k == 1 else v._ORDER, heads)) for k, heads in v.HEADERS.items()
}


# The text , '*', '' with its quotes, as both engines' SQL texts read it.
STAR = "', ' || chr(39) || '*' || chr(39) || ', ' || chr(39) || chr(39)"


def _reference(name: str) -> str:
    cases = " ".join(
        f"WHEN s % 4 = {k} THEN '\"{QUOTED[k][name]}\"'" for k in (0, 1, 2)
    )
    return f"CASE {cases} ELSE '{LETTERS[name]}' END"


def _mapping(ledger_fields: str) -> str:
    return f"""
SELECT {v.FILE} AS file_name, {v.SHEET} AS sheet_name,
 CASE WHEN s % 4 = 3 THEN 'A9:H{LAST_ROW}' ELSE 'A' || {s('2 + s % 6')} || ':H{LAST_ROW}' END AS data_range,
 CASE WHEN s % 4 = 3 THEN '' ELSE 'A' || {s(v.HEADER_ROW)} || ':H' || {s(v.HEADER_ROW)} END AS header_range,
 CASE WHEN s % 4 = 3 THEN 'False' ELSE 'TRUE' END AS use_header,
 CASE WHEN s % 7 = 6 THEN 'FALSE' WHEN s % 7 = 5 THEN 'yes' ELSE 'TRUE' END AS process,
 CASE WHEN s % 30 = 8 THEN '"Not there" > 1 AND ' || {_reference('qty_txt')} || ' IS NOT NULL'
      WHEN s % 30 = 7 THEN 'IS NOT NULL AND AND'
      WHEN s % 30 = 2 THEN 'CAST(' || {_reference('price_txt')} || ' AS DOUBLE) > 0'
      WHEN s % 30 = 1 THEN 'CAST(replace(' || {_reference('price_txt')} || {STAR} || ') AS DOUBLE) > 1000'
      WHEN s % 5 = 4 AND s % 4 = 3 THEN 'WHERE E IS NOT NULL'
      WHEN s % 5 = 4 AND s % 4 = 1 THEN 'where "QTY" IS NOT NULL'
      WHEN s % 5 = 4 THEN '"Qty" IS NOT NULL' ELSE 'N/A' END AS filter,
 'HQ of ' || s_name AS wholesaler_hq, 'NULL' AS wholesaler_branch_name, {s('s')} AS wholesaler_branch_number,
 {ledger_fields}
 CASE WHEN s % 11 = 10 THEN '"Not there"' ELSE 'N/A' END AS item_upc,
 {_reference('order_txt')} AS sales_order_number, {_reference('date_txt')} AS ordered_on,
 {_reference('sku_txt')} AS item_sku, '' AS item_sku_alt, 'NA' AS item_sku_category,
 {_reference('desc_txt')} AS product_description, {_reference('price_txt')} AS unit_price,
 {_reference('qty_txt')} AS ship_quantity, {_reference('uom_txt')} AS uom,
 {_reference('ext_txt')} AS extended_price
FROM (SELECT s_suppkey AS s, s_name FROM {{supplier}}) x"""


BASE_MAPPING = _mapping("'Builder' AS contractor_name, 'C-7' AS contractor_vendor_number, "
                        "'$$Acme$$' AS vendor, 'NULL' AS customer_name,")
CREDIT_MAPPING = _mapping("'NULL' AS vendor, '$$Walk-in$$' AS customer_name, 'NULL' AS material_group_number,")

PREPARED = f"""
SELECT s, o, n, {v.FILE} AS archive_file_name, {v.SHEET} AS sheet_name,
 nullif(trim(order_txt), '') AS sales_order_number, {v.d_date('date_txt')} AS ordered_on,
 nullif(sku_txt, '') AS item_sku, nullif(desc_txt, '') AS item_description,
 {v.d_amount("nullif(price_txt, '')")} AS unit_price, {v.d_quantity("nullif(qty_txt, '')")} AS ship_quantity,
 nullif(uom_txt, '') AS uom, {v.d_amount("nullif(ext_txt, '')")} AS extended_price, qty_txt, ext_txt, price_txt
FROM ({v.DIRTY}) d WHERE s % 7 <> 6 AND s % 11 <> 10"""
# The total row lies inside the range of sheets with a header, and of no other sheet.
TOTAL_ROW = f"""
SELECT s, 0 AS o, -2 AS n, {v.FILE} AS archive_file_name, {v.SHEET} AS sheet_name,
 CASE WHEN s % 4 = 1 THEN NULL ELSE 'Total' END AS sales_order_number,
 CASE WHEN s % 4 = 1 THEN DATE '1899-12-30' + 12 END AS ordered_on,
 CASE WHEN s % 4 = 1 THEN NULL ELSE 'x' END AS item_sku,
 CASE WHEN s % 4 = 1 THEN 'Total' END AS item_description, CAST(CASE WHEN s % 4 = 1 THEN '99.00' END AS DECIMAL(10,2)) AS unit_price,
 CASE WHEN s % 4 <> 1 THEN 12 END AS ship_quantity, CAST(NULL AS VARCHAR) AS uom,
 CAST(CASE WHEN s % 4 <> 1 THEN '99.00' END AS DECIMAL(10,2)) AS extended_price,
 CASE WHEN s % 4 = 1 THEN '' ELSE '12' END AS qty_txt, CASE WHEN s % 4 = 1 THEN 'x' ELSE '99.00' END AS ext_txt,
 CASE WHEN s % 4 = 1 THEN '99.00' ELSE '' END AS price_txt
FROM (SELECT s_suppkey AS s FROM {{supplier}}) t WHERE s % 4 <> 3 AND s % 7 <> 6 AND s % 11 <> 10"""
IN_RANGE = f"({PREPARED} UNION ALL {TOTAL_ROW})"
# A cast fails where some row in range has a price that is no number; other errors do not depend on rows.
CAST_FAILS = f"""s IN (SELECT s FROM {IN_RANGE} f WHERE s % 30 = 2 AND price_txt <> '' AND TRY_CAST(price_txt AS DOUBLE) IS NULL)"""
PASSES = f"""(CASE WHEN s % 30 IN (7, 8) OR {CAST_FAILS} THEN FALSE
 WHEN s % 30 = 2 THEN price_txt <> '' AND TRY_CAST(price_txt AS DOUBLE) > 0
 WHEN s % 30 = 1 THEN price_txt <> '' AND TRY_CAST(replace(price_txt, '*', '') AS DOUBLE) > 1000
 ELSE s % 5 <> 4 OR qty_txt <> '' END)"""
COUNTED = ("(sales_order_number IS NOT NULL OR ordered_on IS NOT NULL OR item_sku IS NOT NULL OR unit_price IS NOT NULL"
           " OR ship_quantity IS NOT NULL OR uom IS NOT NULL OR extended_price IS NOT NULL)")
LOADED = f"(SELECT * FROM {IN_RANGE} r WHERE {PASSES} AND {COUNTED})"
TYPED = f"""SELECT 'HQ of ' || s_name AS wholesaler_hq, CAST(NULL AS VARCHAR) AS wholesaler_branch_name,
 CAST(s AS VARCHAR) AS wholesaler_branch_number, @PARTY@
 CAST(NULL AS VARCHAR) AS item_sku_alt, CAST(NULL AS VARCHAR) AS item_sku_category, CAST(NULL AS VARCHAR) AS item_upc,
 sales_order_number, CAST(ordered_on AS VARCHAR) AS ordered_on, item_sku, item_description,
 CAST(unit_price AS DOUBLE) AS unit_price, ship_quantity, uom, CAST(extended_price AS DOUBLE) AS extended_price,
 CAST(row_number() OVER (PARTITION BY s ORDER BY o * 8 + n) AS INT) AS row_id, 'unspecified' AS type,
 sheet_name, archive_file_name
FROM {LOADED} l JOIN {{supplier}} ON s = s_suppkey"""
BASE_TYPED = TYPED.replace("@PARTY@", "'Builder' AS contractor_name, 'C-7' AS contractor_number, CAST(NULL AS VARCHAR) AS customer_name,"
                      " 'Acme' AS vendor,")
CREDIT_TYPED = TYPED.replace("@PARTY@", "CAST(NULL AS VARCHAR) AS vendor, 'Walk-in' AS customer_name,"
                        " CAST(NULL AS VARCHAR) AS material_group_number,")


def _run(spark, sf, ledger=BASE_LEDGER):
    mapping = in_spark(spark, sf, BASE_MAPPING if ledger is BASE_LEDGER else CREDIT_MAPPING)
    return normalize_transactions(v.grid(spark, sf), mapping, ledger)


def shown(ledger):
    """Plain types, without the generated key."""
    return ledger.drop("transaction_id").withColumns(
        {
            "ordered_on": F.col("ordered_on").cast("string"),
            "unit_price": F.col("unit_price").cast("double"),
            "extended_price": F.col("extended_price").cast("double"),
        }
    )


def normalize_ledger(spark, sf):
    return shown(_run(spark, sf).ledger)


def normalize_credit_ledger(spark, sf):
    return shown(_run(spark, sf, CREDIT_LEDGER).ledger)


METADATA = f"""SELECT {v.FILE} AS archive_file_name, {v.SHEET} AS sheet_name,
 coalesce(raw_rows, 0) AS raw_rows, coalesce(loaded_rows, 0) AS loaded_rows,
 s % 5 = 4 OR s % 30 IN (8, 7, 2, 1) AS has_explicit_filter,
 CASE WHEN s % 11 = 10 OR condition_error <> '' THEN 'failed' ELSE 'loaded' END AS status,
 CASE WHEN s % 11 = 10 THEN 'item_upc' ELSE '' END AS missing_columns, condition_error
FROM (SELECT s, CASE WHEN s % 30 = 8 THEN 'unknown column: Not there' WHEN s % 30 = 7 THEN 'syntax error'
  WHEN s % 11 <> 10 AND {CAST_FAILS} THEN 'cast failed' ELSE '' END AS condition_error FROM (SELECT s_suppkey AS s FROM {{supplier}} WHERE s_suppkey % 7 <> 6) m0) m
LEFT JOIN (SELECT s AS s1, count(*) AS raw_rows FROM (SELECT s, o FROM ({v.DIRTY}) d UNION ALL
  SELECT s_suppkey, 0 FROM {{supplier}} WHERE s_suppkey % 4 <> 3) a GROUP BY s) r ON s = s1
LEFT JOIN (SELECT s AS s2, count(*) AS loaded_rows FROM {LOADED} b GROUP BY s) l ON s = s2"""


def load_metadata(spark, sf):
    return _run(spark, sf).metadata


def load_bad_values(spark, sf):
    return _run(spark, sf).bad_values


BAD = f"""SELECT archive_file_name, 'extended_price' AS column_name, count(*) AS bad_values FROM {LOADED} l
WHERE ext_txt <> '' AND ext_txt <> '#VALUE!' AND extended_price IS NULL GROUP BY archive_file_name"""

# -- checks on the loaded ledger -----------------------------------------------


_RUNS = {}


def _checked_run(spark, sf):
    """The one run that the checks look at; its ledger and its metadata read the same staged rows."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        _RUNS[key] = _run(spark, sf)
    return _RUNS[key]


def _ledger(spark, sf):
    """The loaded ledger as a table, which the checks read after the load."""
    return v.stored(spark, sf, "ledger", lambda: _checked_run(spark, sf).ledger)


def _metadata(spark, sf):
    return v.stored(spark, sf, "metadata", lambda: _checked_run(spark, sf).metadata)


def qc_issues(spark, sf):
    found = lc.issues(_ledger(spark, sf), BASE_LEDGER, _metadata(spark, sf))
    return found.select(lc.FILE, "check", "severity", "detail", "samples")


def qc_column_profile(spark, sf):
    return lc.column_profile(_ledger(spark, sf))


def qc_samples(spark, sf):
    return lc.samples(_ledger(spark, sf))


def qc_summary(spark, sf):
    ledger, metadata = _ledger(spark, sf), _metadata(spark, sf)
    found = lc.issues(ledger, BASE_LEDGER, metadata, with_samples=False)
    return lc.run_summary(ledger, found, metadata)


def key_violations(spark, sf):
    return lc.key_violations(_ledger(spark, sf)).agg(F.count(F.lit(1)).alias("violations"))


_T = f"(SELECT * FROM ({BASE_TYPED}) bt)"
_JUNK = "regexp_full_match({}, '[-=*\\s]+')"
_DATA = BASE_LEDGER.data_columns
_TEXT = BASE_LEDGER.text_columns
_PROFILE = " UNION ALL ".join(
    f"SELECT archive_file_name, '{c}' AS column_name, count({c}) AS non_null, count(*) AS total,"
    f" count(*) - count({c}) AS nulls, round((count(*) - count({c})) / count(*) * 100, 0) AS pct_null"
    f" FROM t GROUP BY archive_file_name" for c in _DATA
)
PROFILE = f"WITH t AS {_T} {_PROFILE}"
_HITS = (
    f"SELECT archive_file_name, row_id, 'Empty rows' AS \"check\", CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS value FROM t WHERE "
    + " AND ".join(f"{c} IS NULL" for c in _DATA)
    + " UNION ALL SELECT archive_file_name, row_id, 'Missing item_description', NULL, NULL FROM t WHERE coalesce(trim(item_description), '') = '' UNION ALL "
    + " UNION ALL ".join(
        f"SELECT archive_file_name, row_id, 'Junk values', '{c}', {c} FROM t WHERE {_JUNK.format(c)}" for c in _TEXT
    )
)
SAMPLES = f"""WITH t AS {_T}, hits AS ({_HITS})
SELECT archive_file_name, "check", column_name, row_id, value, example_no FROM (
 SELECT *, row_number() OVER (PARTITION BY archive_file_name, "check", column_name ORDER BY row_id) AS example_no FROM hits) x
WHERE example_no <= 5"""


def _commas(x: str) -> str:
    return f"format('{{:,}}', {x})"


ISSUES = f"""WITH t AS {_T}, hits AS ({_HITS}), prof AS ({_PROFILE}), meta AS ({METADATA}),
first5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY archive_file_name, "check", column_name ORDER BY row_id) AS rn FROM hits) x WHERE rn <= 5),
shown AS (SELECT archive_file_name, "check", column_name, string_agg(CASE WHEN column_name IS NULL THEN CAST(row_id AS VARCHAR)
  ELSE 'row ' || CAST(row_id AS VARCHAR) || '=''' || value || '''' END, ', ' ORDER BY rn) AS txt
  FROM first5 GROUP BY archive_file_name, "check", column_name),
samples AS (SELECT archive_file_name, "check", string_agg(CASE WHEN column_name IS NULL THEN txt ELSE column_name || ': ' || txt END, '; '
  ORDER BY list_position({_TEXT}, column_name)) AS samples FROM shown GROUP BY archive_file_name, "check"),
fails AS (SELECT archive_file_name, "check", 'FAIL' AS severity, CASE
  WHEN "check" = 'Empty rows' THEN CAST(count(*) AS VARCHAR) || ' row(s) with all data columns NULL'
  WHEN "check" = 'Missing item_description' THEN CAST(count(*) AS VARCHAR) || ' row(s) with NULL or blank item_description'
  ELSE CAST(count(*) AS VARCHAR) || ' junk value(s) in ' || CAST(count(DISTINCT column_name) AS VARCHAR) || ' column(s)' END AS detail
  FROM hits GROUP BY archive_file_name, "check"),
found AS (SELECT * FROM fails UNION ALL
 SELECT archive_file_name, 'Sparse column', 'WARN', '''' || column_name || ''': ' || {_commas('non_null')} || ' rows have a value, '
  || {_commas('nulls')} || ' are NULL (' || CAST(CAST(pct_null AS INT) AS VARCHAR) || '% NULL)' FROM prof WHERE nulls > 0 AND non_null > 0 UNION ALL
 SELECT archive_file_name, 'Skipped rows', 'WARN', '''' || sheet_name || ''': ' || CAST(raw_rows - loaded_rows AS VARCHAR) || ' row(s) skipped ('
  || {_commas('loaded_rows')} || ' loaded from ' || {_commas('raw_rows')} || ' rows in range)' FROM meta
  WHERE status = 'loaded' AND raw_rows > loaded_rows AND NOT has_explicit_filter UNION ALL
 SELECT archive_file_name, 'Load failed', 'LOAD', concat_ws('; ', CASE WHEN missing_columns <> '' THEN 'missing column for: ' || missing_columns END,
  CASE WHEN condition_error <> '' THEN 'condition: ' || condition_error END) FROM meta WHERE status = 'failed')
"""
SUMMARY = ISSUES + """SELECT (SELECT count(DISTINCT archive_file_name) FROM meta) AS files,
 (SELECT count(DISTINCT archive_file_name) FROM found WHERE severity = 'LOAD') AS load_failures,
 (SELECT count(DISTINCT archive_file_name) FROM found WHERE severity = 'FAIL') AS quality_failures,
 (SELECT count(DISTINCT archive_file_name) FROM found WHERE severity = 'WARN') AS warnings,
 (SELECT count(*) FROM t) AS rows_added"""
ISSUES_OUT = ISSUES + """SELECT archive_file_name, "check", severity, detail, samples
 FROM found LEFT JOIN samples USING (archive_file_name, "check")"""

ALL = {
    "normalize_ledger": (normalize_ledger, in_duckdb(BASE_TYPED)),
    "normalize_credit_ledger": (normalize_credit_ledger, in_duckdb(CREDIT_TYPED)),
    "load_metadata": (load_metadata, in_duckdb(METADATA)),
    "load_bad_values": (load_bad_values, in_duckdb(BAD)),
    "qc_issues": (qc_issues, in_duckdb(ISSUES_OUT)),
    "qc_column_profile": (qc_column_profile, in_duckdb(PROFILE)),
    "qc_samples": (qc_samples, in_duckdb(SAMPLES)),
    "qc_summary": (qc_summary, in_duckdb(SUMMARY)),
    "key_violations": (key_violations, "SELECT CAST(0 AS BIGINT) AS violations"),
}
