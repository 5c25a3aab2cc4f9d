"""Header search, profiling, template conversion and ledger loading on hand-made grids."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleswright import config as cf
from saleswright.operators import aliases as al
from saleswright.operators import grids as gr
from saleswright.operators.profile import profile_files
from saleswright.plans.payment_run import normalize_transactions, validate_ledger
from saleswright.plans.template_run import scan_files, template_records


def make_grid(spark, sheets):
    """{(file, sheet, ordinal): {row_idx: cells}} to a grid."""
    data = [
        (f, s, o, i, list(cells)) for (f, s, o), lines in sheets.items() for i, cells in lines.items()
    ]
    return spark.createDataFrame(data, cf.GRID_SCHEMA)


def numbered(*lines):
    return dict(enumerate(lines, start=1))


HEAD = ["Order #", "SKU", "Item  Description", "Qty", "Ext Price"]
TEMPLATE = {
    # Banner above the header, total rows, short rows and rows without identity.
    ("A_b-c.xlsx", "Instructions", 0): numbered(["sku", "qty"]),
    ("A_b-c.xlsx", " reported sales data", 1): numbered(
        ["Big sale", None], HEAD, ["S1", "K1", "pipe", "4", "$10.00"], ["Total", None, None, None, "10"],
        ["grand TOTAL", "x"], [None, None, None, "3", "9"], ["only one"], [" ", "K2", None, "", "(5)"],
    ),
    # The header is far below; a data-like sheet name wins over the first sheet.
    ("far.xlsx", "First", 0): numbered(["a", "b"]),
    ("far.xlsx", "My Sales", 1): {1: ["t", None], 450: ["item", "amount"], 451: ["pipe", "7"]},
    # No header words: the fullest row is the header, and a saved mapping knows it.
    ("saved.xlsx", "S", 0): numbered(["x"], ["c1", "C 2", "c3"], ["pipe", "5", "z"], ["rod", "6", "z"]),
    ("lost.xlsx", "S", 0): numbered(["p", "q"], ["r", "s"], ["t", "u"]),
}


def test_header_search(spark, rows):
    grid = make_grid(spark, TEMPLATE)
    found = gr.alias_headers(grid, {**cf.TEMPLATE_ALIASES, "item_sku": ["sku"], "extra": ["sku", "qty"]})
    got = {(r["file_name"], r["sheet_name"]): (r["header_row"], r["col_map"]) for r in found.collect()}
    assert got[("A_b-c.xlsx", " reported sales data")] == (
        2, {"item_sku": 1, "item_description": 2, "ship_quantity": 3, "extended_price": 4, "extra": 1})
    assert got[("far.xlsx", "My Sales")][0] == 450
    assert ("saved.xlsx", "S") not in got
    full = {r["file_name"]: r["header_row"] for r in gr.fullest_headers(grid).collect()}
    assert full["saved.xlsx"] == 2 and full["lost.xlsx"] == 1
    chosen = {r["file_name"]: r["sheet_name"] for r in gr.choose_sheet(gr.sheet_list(grid), "Reported Sales Data").collect()}
    assert chosen == {"A_b-c.xlsx": " reported sales data", "far.xlsx": "My Sales", "saved.xlsx": "S", "lost.xlsx": "S"}


def test_template(spark, rows):
    grid = make_grid(spark, TEMPLATE)
    saved = spark.createDataFrame(
        [("c 2|c1|c3", "item_description", "C1"), ("c 2|c1|c3", "extended_price", "c  2"), ("c 2|c1|c3", "item_upc", "gone")],
        "signature string, field string, header string")
    overrides = spark.createDataFrame([("FAR.xlsx", "Builder", "W")], "filename string, contractor string, wholesaler_name string")
    from saleswright.sources.files import clean_overrides
    broken = spark.createDataFrame([("bad.xlsx", "no zip")], "file_name string, error string")
    confirmed = spark.createDataFrame([("lost.xlsx", {"item_description": 0, "extended_price": 1})], "file_name string, confirmed_map map<string,int>")
    files = scan_files(grid, saved=saved, overrides=clean_overrides(overrides.withColumn("pos", F.lit(1))), unreadable=broken, confirmed=confirmed)
    status = {r["file_name"]: (r["status"], r["contractor"], r["from_saved"]) for r in files.collect()}
    assert status == {
        "A_b-c.xlsx": ("ready", "A b c", False), "far.xlsx": ("ready", "Builder", False),
        "saved.xlsx": ("ready", "saved", True), "lost.xlsx": ("ready", "lost", False), "bad.xlsx": ("error", None, None)}
    got = [tuple(r) for r in template_records(grid, files).orderBy("file_name", "row_idx").collect()]
    assert got == [
        ("A_b-c.xlsx", 3, "A b c", "", "", "K1", "", "", "pipe", 2.5, 4.0, 10.0),
        ("A_b-c.xlsx", 8, "A b c", "", "", "K2", "", "", "", None, None, -5.0),
        ("far.xlsx", 451, "Builder", "", "", "", "", "", "pipe", None, None, 7.0),
        # A map made by hand without a detected header starts below the first row.
        ("lost.xlsx", 2, "lost", "", "", "", "", "", "r", None, None, None),
        ("lost.xlsx", 3, "lost", "", "", "", "", "", "t", None, None, None),
        ("saved.xlsx", 3, "saved", "", "", "", "", "", "pipe", None, None, 5.0),
        ("saved.xlsx", 4, "saved", "", "", "", "", "", "rod", None, None, 6.0),
    ]
    strict = scan_files(grid, required=cf.REQUIRED_FIVE)
    by_name = {r["file_name"]: (r["status"], r["missing"]) for r in strict.collect()}
    assert by_name["A_b-c.xlsx"] == ("needs_mapping", ["order_date"])
    assert template_records(grid, strict.filter("file_name = 'A_b-c.xlsx'")).count() == 0


def test_merge_and_missing(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2}, {"b": 5, "c": 6}), ({"a": 1}, None)], "d map<string,int>, c map<string,int>")
    got = df.select(al.merge_maps(F.col("d"), F.col("c")).alias("m"), al.missing_fields(F.col("d"), ["b", "z"]).alias("x")).collect()
    assert [r["m"] for r in got] == [{"a": 1, "b": 5, "c": 6}, {"a": 1}]
    assert [r["x"] for r in got] == [["z"], ["b", "z"]]


def test_layout_rules(spark):
    df = spark.createDataFrame([(["Sum of Sales", "COGS", "ShipDate", "Qty", "Sales"],), (["sum of sales", "COGS"],), ([],)], "h array<string>")
    got = [tuple(r) for r in df.select(al.rule_number(F.col("h"), cf.LAYOUT_RULES), al.layout_overrides(F.col("h"), cf.LAYOUT_RULES)).collect()]
    assert got == [(1, {"extended_price": "COGS"}), (None, {}), (None, {})]


def test_header_for(spark):
    df = spark.createDataFrame([(["Qty", "b", " QTY ", "Vendor"],)], "h array<string>")
    pick = lambda words, skip: df.select(al.header_for(F.col("h"), words, skip)).first()[0]
    assert pick(["vendor", "qty"], True) == "Vendor"
    assert pick(["x", "qty"], True) == "QTY"
    assert pick(["b"], True) is None and pick(["B"], False) == "b"


def test_profile(spark):
    grid = make_grid(spark, {
        # Two rows tie: the first is the header. Rows are as wide as the sheet.
        ("a.xlsx", "One", 0): numbered(
            [None, "note"], ["Order Number", "Qty", "MG", "Description"], ["1", "2", None, "x"], ["1", None, None, None], ["3", "4", "5", "6"]),
        # The header is below the tenth row, so the density search does not see it.
        ("b.xlsx", "Two", 0): {**{i: ["x"] + [None] * 5 for i in range(1, 15)}, 15: list("abcdef")},
        ("c.xlsx", "Rule", 0): numbered(["ShipDate", "Qty", "Sales", "COGS"], ["1/1/24", "1", "2", "3"]),
    })
    errors = spark.createDataFrame([("d.xlsx", "broken")], "file_name string, error string")
    got = {r["file_name"]: r for r in profile_files(grid, unreadable=errors).collect()}
    a = got["a.xlsx"]
    assert (a["headers"], a["header_range"], a["data_range"], a["rows_count"]) == (
        "Order Number|Qty|MG|Description", "A2:D2", "A2:D5", "2")
    assert (a["sales_order_number"], a["material_group_number"], a["vendor"]) == ('"Order Number"', '"MG"', "NULL")
    b = got["b.xlsx"]
    assert (b["use_header"], b["header_range"], b["data_range"], b["rows_count"], b["uom"]) == ("FALSE", "", "", "0", "")
    assert got["c.xlsx"]["extended_price"] == '"COGS"'
    assert (got["d.xlsx"]["sheet_name"], got["d.xlsx"]["uom"], got["d.xlsx"]["use_header"]) == ("ERROR", "NULL", "FALSE")
    base = {r["file_name"]: r for r in profile_files(grid, {"uom": ["qty"], "vendor": ["a"]}, cf.BASE_PROFILE).collect()}
    # Half of the share of the header: one cell of four is enough only below 0.5.
    assert (base["a.xlsx"]["data_range"], base["a.xlsx"]["rows_count"], base["a.xlsx"]["uom"]) == ("A2:D5", "2", '"Qty"')
    assert "d.xlsx" not in base


LOAD = {
    ("f.xlsx", "S1", 0): numbered(
        ["skip me"], ["Cust", "Ship Date", "Item", "Price", "Qty", "Ext"],
        ["Ann", "3/5/24", "pipe", "1.50", "2 EA", "$3"], [None, None, "note only", None, None, None],
        ["Bob", "45000", "---", "1,000.5", "x", "#VALUE!"], [" ", None, None, None, None, None]),
    ("f.xlsx", "S2", 1): {5: ["q", "B1", "9"], 6: ["r", "B2", "8"], 7: ["s", None, "7"]},
    ("g.xlsx", "S", 0): numbered(["Cust"], ["Cid"]),
}


def mapping(spark):
    columns = ["file_name", "sheet_name", "data_range", "header_range", "use_header", "process", "customer_name",
               "ordered_on", "product_description", "unit_price", "ship_quantity", "extended_price", "vendor", "uom",
               "wholesaler_name", "filter"]
    data = [
        ("f.xlsx", "S1", "A3:F6", "A2:F2", "TRUE", "TRUE", '"cust"', '"Ship Date"', '"Item"', '"Price"', '"Qty"', '"Ext"', "$$Acme$$", "N/A", "HQ", ""),
        ("f.xlsx", "S2", "B5:C9", "", "no", "yes", "B", "", "c", "5", "", "", "", "", "", "where B = 'B1' or C in ('7')"),
        ("g.xlsx", "S", "A1:A9", "", "TRUE", "1", '"Nope"', "", "", "", "", "", "", "", "", ""),
        ("h.xlsx", "S", "A1:A9", "", "TRUE", "FALSE", '"Cust"', "", "", "", "", "", "", "", "", ""),
        ("", "S", "A1:A9", "", "TRUE", "TRUE", '"Cust"', "", "", "", "", "", "", "", "", ""),
    ]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))


@pytest.fixture(scope="module")
def run(spark):
    return normalize_transactions(make_grid(spark, LOAD), mapping(spark), run_id="r")


def test_ledger_rows(run):
    assert [f.dataType.simpleString() for f in run.ledger.schema] == [t for _, t in cf.BASE_FIELDS]
    picked = run.ledger.select("sheet_name", "row_id", "customer_name", "ordered_on", "item_description", "unit_price",
                               "ship_quantity", "extended_price", "vendor", "wholesaler_hq", "type", "archive_file_name")
    got = sorted(tuple(r) for r in picked.collect())
    tail = ("unspecified", "f.xlsx")
    assert got == [
        ("S1", 1, "Ann", dt.date(2024, 3, 5), "pipe", Decimal("1.50"), 2, None, "Acme", "HQ", *tail),
        ("S1", 2, "Bob", dt.date(2023, 3, 15), "---", Decimal("1000.50"), None, None, "Acme", "HQ", *tail),
        # A blank text cell counts as present.
        ("S1", 3, "", None, None, None, None, None, "Acme", "HQ", *tail),
        # The literal price makes every row of the range present; the condition drops one.
        ("S2", 1, "B1", None, "9", Decimal("5.00"), None, None, None, None, *tail),
        ("S2", 2, None, None, "7", Decimal("5.00"), None, None, None, None, *tail),
    ]
    keys = [r[0] for r in run.ledger.select("transaction_id").collect()]
    assert len(set(keys)) == len(keys) == 5


def test_ledger_metadata_and_checks(run, rows):
    assert rows(run.metadata.drop("condition_error")) == [
        ("f.xlsx", "S1", 4, 3, False, "loaded", ""),
        ("f.xlsx", "S2", 3, 2, True, "loaded", ""),
        ("g.xlsx", "S", 1, 0, False, "failed", "customer_name"),
    ]
    assert rows(run.bad_values) == [("f.xlsx", "extended_price", 1), ("f.xlsx", "ship_quantity", 1)]
    issues = {(r["archive_file_name"], r["check"]): (r["severity"], r["detail"], r["samples"])
              for r in validate_ledger(run).filter("check <> 'Sparse column'").collect()}
    assert issues == {
        ("f.xlsx", "Missing item_description"): ("FAIL", "1 row(s) with NULL or blank item_description", "3"),
        ("f.xlsx", "Junk values"): ("FAIL", "1 junk value(s) in 1 column(s)", "item_description: row 2='---'"),
        ("f.xlsx", "Skipped rows"): ("WARN", "'S1': 1 row(s) skipped (3 loaded from 4 rows in range)", None),
        ("g.xlsx", "Load failed"): ("LOAD", "missing column for: customer_name", None),
    }
    sparse = {r["detail"] for r in validate_ledger(run).filter("check = 'Sparse column'").collect()}
    assert "'customer_name': 4 rows have a value, 1 are NULL (20% NULL)" in sparse


def test_same_rows_with_few_and_many_partitions(spark, run, rows):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        again = normalize_transactions(make_grid(spark, LOAD), mapping(spark), run_id="r")
        assert rows(again.ledger) == rows(run.ledger)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
