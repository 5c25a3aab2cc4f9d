"""Header search, profiling, rules and template conversion on the sales grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswright.config import LAYOUT_RULES, REQUIRED_FIVE, TEMPLATE_ALIASES
from saleswright.functions import text as tx
from saleswright.operators import aliases as al
from saleswright.operators import grids as gr
from saleswright.operators.profile import densest_headers, profile_files, row_density
from saleswright.plans.template_run import scan_files, template_records
from saleswright.scale import settled
from saleswright.sources.files import clean_overrides
from saleswright.sources.grids import read_range
from workload import views as v
from workload.views import in_duckdb, in_spark, s

ALL = {}
SUPPLIERS = "(SELECT s_suppkey AS s, s_name FROM {supplier}) x"


def _positions(col_map):
    entries = F.array_sort(F.map_entries(col_map))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


# -- header search ---------------------------------------------------------------

FOUND = {
    0: {"extended_price": 6, "item_description": 3, "item_sku": 2, "order_date": 1,
        "sales_order_number": 0, "ship_quantity": 4, "unit_price": 5},
    1: {"extended_price": 2, "item_description": 0, "item_sku": 5, "order_date": 4,
        "sales_order_number": 3, "ship_quantity": 1, "unit_price": 6},
    2: {"item_description": 3, "item_sku": 2, "order_date": 1, "sales_order_number": 0,
        "ship_quantity": 4, "unit_price": 5},
    3: {},
}
_FOUND = "CASE " + " ".join(
    f"WHEN s % 4 = {k} THEN '" + ",".join(f"{a}={b}" for a, b in f.items()) + "'" for k, f in FOUND.items()
) + " END"


def detect_header_alias(spark, sf):
    found = gr.alias_headers(v.grid(spark, sf), TEMPLATE_ALIASES)
    return found.select(
        "file_name", "sheet_name", "header_row", _positions(F.col("col_map")).alias("found"),
        tx.header_signature(F.col("header_cells")).alias("signature"),
    )


_SIGNATURE = "CASE " + " ".join(
    f"WHEN s % 4 = {k} THEN '" + "|".join(sorted(h.lower() for h in heads)) + "'" for k, heads in v.HEADERS.items()
) + " END"
ALL["detect_header_alias"] = (
    detect_header_alias,
    in_duckdb(f"""SELECT {v.FILE} AS file_name, {v.SHEET} AS sheet_name, CAST({v.HEADER_ROW} AS BIGINT) AS header_row,
 {_FOUND} AS found, {_SIGNATURE} AS signature FROM {SUPPLIERS} WHERE s % 4 <> 3"""),
)


def detect_header_fallback(spark, sf):
    full = gr.fullest_headers(v.grid(spark, sf))
    return full.select("file_name", "sheet_name", "header_row", F.size("header_cells").alias("width"))


# The first sheet's only row has two cells and is its own fullest row.
ALL["detect_header_fallback"] = (
    detect_header_fallback,
    in_duckdb(f"""SELECT {v.FILE} AS file_name, {v.SHEET} AS sheet_name, CAST({v.HEADER_ROW} AS BIGINT) AS header_row, 8 AS width FROM {SUPPLIERS}
 UNION ALL SELECT {v.FILE}, CASE WHEN s % 3 = 0 THEN 'Instructions' ELSE 'Notes' END, 1, 2 FROM {SUPPLIERS} WHERE s % 3 <> 2"""),
)


def choose_sheets(spark, sf):
    sheets = settled(gr.sheet_list(v.grid(spark, sf)))
    chosen = gr.choose_sheet(sheets, "REPORTED SALES DATA")
    usable = gr.first_usable_sheet(sheets).withColumnRenamed("sheet_name", "usable_sheet")
    return chosen.join(usable, "file_name")


ALL["choose_sheets"] = (
    choose_sheets,
    in_duckdb(f"""SELECT {v.FILE} AS file_name, {v.SHEET} AS sheet_name,
 CASE WHEN s % 3 = 1 THEN 'Notes' ELSE {v.SHEET} END AS usable_sheet FROM {SUPPLIERS}"""),
)


# Two of five files begin with a sheet without a row; a few files have nothing else.
EMPTY_SHEETS = f"""SELECT {v.FILE} AS file_name, CASE WHEN s % 5 = 0 THEN 'Cover' ELSE 'Sales of old' END AS sheet_name, -1 AS sheet_ordinal FROM {SUPPLIERS} WHERE s % 5 < 2
 UNION ALL SELECT 'none_' || {s('s')} || '.csv', 'Sample', 0 FROM {SUPPLIERS} WHERE s % 5 = 2"""


def choose_sheets_inventory(spark, sf):
    sheets = settled(gr.sheet_list(v.grid(spark, sf), in_spark(spark, sf, EMPTY_SHEETS)))
    usable = gr.first_usable_sheet(sheets).withColumnRenamed("sheet_name", "usable_sheet")
    return gr.choose_sheet(sheets, "REPORTED SALES DATA").join(usable, "file_name")


_FIRST = "CASE WHEN s % 5 = 0 THEN 'Cover' ELSE 'Sales of old' END"
ALL["choose_sheets_inventory"] = (
    choose_sheets_inventory,
    in_duckdb(f"""SELECT {v.FILE} AS file_name, CASE WHEN s % 3 = 0 THEN {v.SHEET} WHEN s % 5 = 1 THEN 'Sales of old' WHEN s % 3 = 1 THEN {v.SHEET}
 WHEN s % 5 = 0 THEN 'Cover' ELSE {v.SHEET} END AS sheet_name,
 CASE WHEN s % 5 < 2 THEN {_FIRST} WHEN s % 3 = 1 THEN 'Notes' ELSE {v.SHEET} END AS usable_sheet FROM {SUPPLIERS}
 UNION ALL SELECT 'none_' || {s('s')} || '.csv', 'Sample', NULL FROM {SUPPLIERS} WHERE s % 5 = 2"""),
)


def detect_header_density(spark, sf):
    found = densest_headers(row_density(v.grid(spark, sf)))
    return found.select("file_name", "sheet_name", "width", "header_row", F.array_join("headers", "|").alias("headers"))


_JOINED = "CASE " + " ".join(f"WHEN s % 4 = {k} THEN '" + "|".join(h) + "'" for k, h in v.HEADERS.items()) + " END"
ALL["detect_header_density"] = (
    detect_header_density,
    in_duckdb(f"""SELECT {v.FILE} AS file_name, {v.SHEET} AS sheet_name, 8 AS width, CAST({v.HEADER_ROW} AS BIGINT) AS header_row,
 {_JOINED} AS headers FROM {SUPPLIERS}
 UNION ALL SELECT {v.FILE}, CASE WHEN s % 3 = 0 THEN 'Instructions' ELSE 'Notes' END, 2, 1, 'How to fill this in|' || s_name FROM {SUPPLIERS} WHERE s % 3 <> 2"""),
)

# -- profiling -------------------------------------------------------------------

_FILLED = " + ".join(f"CASE WHEN {c} <> '' THEN 1 ELSE 0 END" for c in v._ORDER)
_DENSE = f"""SELECT s AS s1, count(*) AS n, min(idx) AS lo, max(idx) AS hi FROM (
 SELECT s, {v.DATA_ROW} AS idx FROM ({v.DIRTY}) d WHERE ({_FILLED}) >= 4) q GROUP BY s"""
_PROFILE_COLUMNS = ["file_name", "sheet_name", "headers", "data_range", "header_range", "use_header",
                    "rows_count", "vendor", "customer_name", "sales_order_number", "ordered_on",
                    "item_sku", "product_description", "unit_price", "ship_quantity", "uom", "extended_price"]


def _per_layout(texts):
    return "CASE " + " ".join(f"WHEN s % 4 = {k} THEN '{t}'" for k, t in enumerate(texts)) + " END"


def _profile_oracle(base: bool, words: dict[str, list[str]]) -> str:
    # The total row has four cells of eight, and the header eight; both are dense enough.
    top = v.HEADER_ROW if base else "1 + s % 6"
    extra = "1" if base else "1"
    fields = ", ".join(f"{_per_layout(t)} AS {n}" for n, t in words.items())
    sheet = f"""SELECT {v.FILE} AS file_name, {v.SHEET} AS sheet_name, {_JOINED} AS headers,
 'A' || CAST({top} AS VARCHAR) || ':H' || CAST(greatest(coalesce(hi, 8), 8) AS VARCHAR) AS data_range,
 'A' || CAST({v.HEADER_ROW} AS VARCHAR) || ':H' || CAST({v.HEADER_ROW} AS VARCHAR) AS header_range, 'TRUE' AS use_header,
 CAST(coalesce(n, 0) + {extra} AS VARCHAR) AS rows_count, {fields}
 FROM {SUPPLIERS} LEFT JOIN ({_DENSE}) dn ON s = s1"""
    nothing = ", ".join("'NULL'" for _ in words)
    first = f"""SELECT {v.FILE}, CASE WHEN s % 3 = 0 THEN 'Instructions' ELSE 'Notes' END, 'How to fill this in|' || s_name,
 {"''" if base else "'A1:B1'"}, 'A1:B1', 'TRUE', '0', {nothing} FROM {SUPPLIERS} WHERE s % 3 <> 2"""
    return in_duckdb(f"{sheet} UNION ALL {first}")


N = "NULL"
CREDIT_WORDS = {
    "vendor": [N, N, N, N], "customer_name": [N, N, N, N],
    "sales_order_number": ['"Order Number"', '"Invoice #"', '"Order Number"', N],
    "ordered_on": [N, '"Date"', N, N], "item_sku": [N, N, N, N],
    "product_description": ['"Description"', N, '"Description"', N],
    "unit_price": ['"Unit Price"', N, '"Unit Price"', N],
    "ship_quantity": ['"Qty"', '"QTY"', '"Qty"', N], "uom": ['"UOM"', '"UofM"', '"UOM"', N],
    "extended_price": [N, '"Ext Price"', N, N],
}
# The base profiler takes its dictionary as a parameter.
BASE_WORDS = {
    "vendor": ["vendor", "mfr"], "customer_name": ["customer"],
    "sales_order_number": ["invoice #", "order number"], "ordered_on": ["order date", "date", "h"],
    "item_sku": ["part number", "sku"], "product_description": ["item  description", "description"],
    "unit_price": ["price", "unit price"], "ship_quantity": ["qty"], "uom": ["uofm", "uom"],
    "extended_price": ["ext price", "extended price", "line value"],
}
BASE_RESULT = {
    "vendor": [N] * 4, "customer_name": [N] * 4,
    "sales_order_number": ['"Order Number"', '"Invoice #"', '"Order Number"', N],
    "ordered_on": ['"Order Date"', '"Date"', '"Order Date"', N],
    "item_sku": ['"SKU"', '"Part Number"', '"SKU"', N],
    "product_description": ['"Description"', '"Item  Description"', '"Description"', N],
    "unit_price": ['"Unit Price"', '"Price"', '"Unit Price"', N],
    "ship_quantity": ['"Qty"', '"QTY"', '"Qty"', N], "uom": ['"UOM"', '"UofM"', '"UOM"', N],
    "extended_price": ['"Extended Price"', '"Ext Price"', '"Line Value"', N],
}


def profile_base(spark, sf):
    from saleswright.config import BASE_PROFILE
    return profile_files(v.grid(spark, sf), BASE_WORDS, BASE_PROFILE).select(*_PROFILE_COLUMNS)


def profile_credit(spark, sf):
    return profile_files(v.grid(spark, sf)).select(*_PROFILE_COLUMNS)


CREDIT_WORDS["extended_price"] = [N, '"Ext Price"', N, N]
ALL["profile_files_base"] = (profile_base, _profile_oracle(True, BASE_RESULT))
ALL["profile_files_credit"] = (profile_credit, _profile_oracle(False, CREDIT_WORDS))

# -- rules on header lists made from customers -----------------------------------

_SETS = [r.triggers for r in LAYOUT_RULES] + [["Qty", "sales", "COGS GP"]]
RULE_HEADERS = "SELECT c_custkey, CASE " + " ".join(
    f"WHEN c_custkey % 12 = {i} THEN LIST(" + ", ".join(f"'{h}'" for h in [*reversed(t), "Extra"]) + ")"
    for i, t in enumerate(_SETS)
) + " END AS headers FROM {customer}"


def conditional_rules(spark, sf):
    rows = in_spark(spark, sf, RULE_HEADERS)
    forced = al.layout_overrides(F.col("headers"), LAYOUT_RULES)
    return rows.select(
        "c_custkey", al.rule_number(F.col("headers"), LAYOUT_RULES).alias("rule_no"),
        forced["unit_price"].alias("unit_price"), forced["extended_price"].alias("extended_price"),
    )


def _q(items):
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


_FIRES = " ".join(f"WHEN list_has_all(headers, {_q(r.triggers)}) THEN {i}" for i, r in enumerate(LAYOUT_RULES, 1))


def _forced(field):
    return "CASE rule_no " + " ".join(
        f"WHEN {i} THEN '{r.overrides[field]}'" for i, r in enumerate(LAYOUT_RULES, 1) if field in r.overrides
    ) + " END"


ALL["conditional_rules"] = (
    conditional_rules,
    in_duckdb(f"""SELECT c_custkey, rule_no, {_forced('unit_price')} AS unit_price, {_forced('extended_price')} AS extended_price
 FROM (SELECT *, CASE {_FIRES} END AS rule_no FROM ({RULE_HEADERS}) h) r"""),
)

# -- template conversion ---------------------------------------------------------

OVERRIDES = f"""SELECT upper({v.FILE}) AS filename, CASE WHEN s % 10 = 3 THEN '' ELSE ' Builder ' || {s('s')} END AS contractor,
 s_name AS wholesaler_name, '' AS wholesaler_address, '2024-05-01' AS date_of_this_report, s AS pos FROM {SUPPLIERS} WHERE s % 5 = 3"""
SAVED = [("c1|c2|c3|c4|c5|c6|c7|c8", f, h) for f, h in
         [("sales_order_number", "C1"), ("item_description", " c4"), ("ship_quantity", "c5"),
          ("extended_price", "C7"), ("unit_price", "not there")]]
_CONTRACTOR = f"CASE WHEN s % 5 = 3 AND s % 10 <> 3 THEN 'Builder ' || {s('s')} ELSE 'dist ' || {s('s')} END"


def _scan(spark, sf, **options):
    overrides = clean_overrides(in_spark(spark, sf, OVERRIDES))
    saved = spark.createDataFrame(SAVED, "signature string, field string, header string")
    return scan_files(v.grid(spark, sf), overrides=overrides, saved=saved, **options)


def template_files(spark, sf):
    return _scan(spark, sf).select(
        "file_name", "sheet_name", "status", "from_saved", "contractor", "header_row",
        F.array_join("missing", ",").alias("missing"), _positions(F.col("col_map")).alias("found"),
    )


_SAVED_FOUND = _FOUND.replace("WHEN s % 4 = 3 THEN ''", "WHEN s % 4 = 3 THEN 'extended_price=6,item_description=3,sales_order_number=0,ship_quantity=4'")
ALL["template_files"] = (
    template_files,
    in_duckdb(f"""SELECT {v.FILE} AS file_name, {v.SHEET} AS sheet_name, CASE WHEN s % 4 = 2 THEN 'needs_mapping' ELSE 'ready' END AS status,
 s % 4 = 3 AS from_saved, {_CONTRACTOR} AS contractor, CAST({v.HEADER_ROW} AS BIGINT) AS header_row,
 CASE WHEN s % 4 = 2 THEN 'extended_price' ELSE '' END AS missing, {_SAVED_FOUND} AS found FROM {SUPPLIERS}"""),
)


def _records(spark, sf, **options):
    files = settled(_scan(spark, sf, **options))
    return template_records(v.grid(spark, sf), files, computed=True)


def convert_template(spark, sf):
    return _records(spark, sf)


def convert_template_confirmed(spark, sf):
    """A person maps the unknown amount column, under the five-field rule."""
    confirmed = v.table(spark, sf, "supplier").select(
        F.concat(F.lit("dist_"), "s_suppkey", F.lit(".csv")).alias("file_name"),
        F.when(F.col("s_suppkey") % 4 == 2, F.create_map(F.lit("extended_price"), F.lit(6))).alias("confirmed_map"),
    ).filter("confirmed_map is not null")
    return _records(spark, sf, required=REQUIRED_FIVE, confirmed=confirmed)


_QTY, _EXT, _PRICE = v.d_number("qty_txt"), v.d_number("ext_txt"), v.d_number("price_txt")
_UNIT = f"""CASE WHEN s % 4 <> 3 AND price IS NOT NULL THEN price WHEN ext <> 0 AND q <> 0
 THEN CAST(round(CAST(CAST(ext / q AS VARCHAR) AS DECIMAL(38,20)), 4) AS DOUBLE) END"""


def _template_oracle(where: str) -> str:
    return in_duckdb(f"""SELECT {v.FILE} AS file_name, row_idx, {_CONTRACTOR} AS contractor_name, order_txt AS sales_order_number,
 CASE WHEN s % 4 = 3 THEN '' ELSE date_txt END AS order_date, CASE WHEN s % 4 = 3 THEN '' ELSE sku_txt END AS item_sku,
 '' AS item_sku_category, '' AS item_upc, desc_txt AS item_description, {_UNIT} AS unit_price, q AS ship_quantity, ext AS extended_price
FROM (SELECT s, {v.DATA_ROW} AS row_idx, order_txt, date_txt, sku_txt, desc_txt, {_FILLED} AS filled,
  {_QTY} AS q, {_EXT} AS ext, {_PRICE} AS price FROM ({v.DIRTY}) d) t
WHERE filled >= 2 AND {where} AND (order_txt <> '' OR desc_txt <> '' OR (s % 4 <> 3 AND sku_txt <> ''))
-- In layout 1 the label of the total row stands in the description.
""")


ALL["convert_template"] = (convert_template, _template_oracle("s % 4 <> 2"))
ALL["convert_template_confirmed"] = (convert_template_confirmed, _template_oracle("s % 4 <> 3"))


# -- ranges ----------------------------------------------------------------------


def range_scan(spark, sf):
    rows = read_range(v.grid(spark, sf), "C1:E4000")
    return rows.select("file_name", "sheet_name", "row_idx", F.concat_ws("|", F.transform("cells", lambda c: F.coalesce(c, F.lit("~")))).alias("cells"))


ALL["range_scan"] = (
    range_scan,
    in_duckdb(f"""SELECT file_name, sheet_name, row_idx, array_to_string(list_transform(cells[3:5], lambda c: coalesce(c, '~')), '|') AS cells
 FROM ({v.GRID}) g WHERE row_idx BETWEEN 1 AND 4000"""),
)


def merge_user_map(spark, sf):
    found = gr.alias_headers(v.grid(spark, sf), TEMPLATE_ALIASES)
    mine = F.create_map(F.lit("item_upc"), F.lit(7), F.lit("item_sku"), F.lit(0))
    return found.select("file_name", _positions(al.merge_maps(F.col("col_map"), mine)).alias("merged"))


_MERGED = "CASE " + " ".join(
    f"WHEN s % 4 = {k} THEN '" + ",".join(f"{a}={b}" for a, b in sorted({**f, "item_sku": 0, "item_upc": 7}.items())) + "'"
    for k, f in FOUND.items() if f
) + " END"
ALL["merge_user_map"] = (
    merge_user_map,
    in_duckdb(f"SELECT {v.FILE} AS file_name, {_MERGED} AS merged FROM {SUPPLIERS} WHERE s % 4 <> 3"),
)
