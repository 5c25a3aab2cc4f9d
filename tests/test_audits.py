"""Audits, snapshots, documents, exports, reports and qualification on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from saleswright import config as cf
from saleswright.operators import audits, customers, documents, exports, metrics, qualification, snapshots
from saleswright.sources import files, records


def test_categories(spark):
    data = [
        (1, "PVC Elbow", "n", "n"), (2, "solid tee", "n", "Y"), (3, "Solid elbow", None, "n"), (4, "handcap", "n", "0"),
        (5, "hose", "TRUE", "n"), (6, "nothing", "n", "n"), (7, None, "n", "n"), (8, "tube elbow", "no", "no"), (9, "INC/RED", "1", "x"),
    ]
    df = spark.createDataFrame(data, "row_id int, item_description string, pipe string, fittings string")
    got = {r["row_id"]: (r["keywords_found"], r["final_category"], r["discrepancy_type"]) for r in audits.category_discrepancies(df).collect()}
    fitting = "Should be marked as fitting but fittings column is not true"
    pipe = "Should be marked as pipe but pipe column is not true"
    assert got == {
        1: ("elbow", "fitting", fitting), 2: ("solid, tee", "pipe", pipe), 4: ("cap", "fitting", fitting),
        8: ("elbow, tube", "pipe", pipe), 9: ("inc/red", "fitting", fitting),
    }


def test_exclusions(spark, rows):
    data = [("c", "f", "Nibco COPPER", "Y", None), ("c", "f", "jm EAGLE", "y", "0"), ("c", "f", "lasco", " Y ", " "),
            ("c", "f", "plain", "N", "5"), ("c", "f", None, "N", "5"), ("c", "f", "ipex", None, "")]
    df = spark.createDataFrame(data, "contractor_name string, file_name string, item_description string, exclude string, potential_earnings string")
    assert rows(audits.exclusion_report(df)) == [
        ("c", "f", "ipex", "", 'Found "ipex" but exclude is not "Y"'),
        ("c", "f", "jm EAGLE", "y", 'Found "JM eagle" but exclude is not "Y"'),
        ("c", "f", "jm EAGLE", "y", 'Found "JM eagle" but potential_earnings is not empty'),
    ]
    assert audits.exclusion_report(df.limit(0)).columns == ["contractor_name", "file_name", "item_description", "exclude", "issue_type"]


def test_reconcile(spark, rows):
    lines = spark.createDataFrame([(x,) for x in ["a.csv 2", "", "  b file.csv   9 ", "c.csv", "gone.csv 1", "a.csv 2"]], "value string")
    loaded = spark.createDataFrame([(x,) for x in ["a.csv", " a.csv ", "b file.csv", "c.csv", "extra", " ", None]], "file_name string")
    result = audits.reconcile_counts(files.pasted_counts(lines), audits.loaded_counts(loaded))
    assert rows(result) == sorted([
        ("a.csv", 2, 2, "found (count matches)"), ("a.csv", 2, 2, "found (count matches)"),
        ("b file.csv", 9, 1, "found (count mismatch: input=9, db=1)"), ("c.csv", None, 1, "found (no input count)"),
        ("extra", None, 1, "MISSING"), ("gone.csv", 1, None, "not found")], key=repr)
    assert dict(rows(audits.reconcile_summary(result)))["found (count mismatch)"] == 1


def test_file_totals(spark, rows):
    data = [
        ("a", "Sample", 0, 1, ["extended_price"]), ("a", "Data", 1, 1, ["x", None]), ("a", "Data", 1, 2, ["Q", " Extended_Price "]),
        ("a", "Data", 1, 3, ["1", "2.5"]), ("a", "Data", 1, 4, [None, "4"]), ("a", "Data", 1, 5, ["1", "n/a"]),
        ("b", "Instructions", 0, 1, ["x"]), ("c", "Data", 0, 1, ["x", "y"]),
    ]
    bad = spark.createDataFrame([("d",)], "file_name string")
    assert rows(audits.file_totals(spark.createDataFrame(data, cf.GRID_SCHEMA), unreadable=bad)) == [
        ("'a", 2, 6.5), ("'b", 0, 0.0), ("'c", 0, 0.0), ("'d", None, None)]


def snapshot(spark, data):
    rows = [(i, *r) for i, r in enumerate(data)]
    return snapshots.latest_by_key(spark.createDataFrame(rows, "pos int, key string, product_key string, superseded_by string"))


def test_sku_changes(spark, rows):
    old = snapshot(spark, [("k1", "p1", None), ("k2", "p1", ""), ("k9", "p9", None), ("n1", None, None), ("dup", "x", None), ("dup", "p5", None)])
    new = snapshot(spark, [("k3", "p1", None), ("k4", "p1", None), ("k9", "p9", "k10"), ("k10", "p9", None), ("n2", None, None), ("only", "p7", None), ("dup", "p5", None)])
    empty = ("", "", "")
    assert rows(snapshots.sku_changes(old, new)) == sorted([
        ("p1", "k3", "new", *empty), ("p1", "k4", "new", *empty), (None, "n2", "new", *empty), ("p7", "only", "new", *empty),
        ("p1", "k1", "removed", *empty), ("p1", "k2", "removed", *empty), (None, "n1", "removed", *empty),
        ("p1", "k3", "updated", "k1", "k3", ""), ("p1", "k4", "updated", "k1", "k4", ""), ("p1", "k3", "updated", "k2", "k3", ""),
        ("p1", "k4", "updated", "k2", "k4", ""), (None, "n2", "updated", "n1", "n2", ""),
        ("p9", "k9", "change", "k9", "k10", "superseded"),
    ], key=repr)
    kinds = {r[0] for r in snapshots.sku_changes(new, new).select("change_type").distinct().collect()}
    assert kinds == {"change"}
    assert ("p1", 2, 2) in rows(snapshots.product_changes(old, new))


FLAT = [
    (1, "P1", "E2", "t1", "sale", "s", "EA", "2", "3.5", "3/5/24", "b", None),
    (2, "P1", "E1", "t2", "sale", "s", "EA", "1", "1", "12/31/99", "", "x"),
    (3, "P2", "E1", "t3", "sale", "s", "EA", "1", "1", "1/1/00", None, ""),
    (4, "P1", "E2", "t4", "sale", "s", "EA", "1", "1", "1/1/00", None, ""),
]


@pytest.mark.parametrize("size", [1, 2, 100])
def test_documents_round_trip(spark, rows, size):
    flat = spark.createDataFrame(FLAT, "row_idx int, " + ", ".join(f"{c} string" for c in documents.FLAT_COLUMNS))
    nested = documents.nest_transactions(flat, page_rows=size)
    if size == 100:
        first = nested.filter("participant_key = 'P1'").first()
        assert [e["id"] for e in first["entities"]] == ["E2", "E1"]
        assert [t["transaction_id"] for t in first["entities"][0]["transactions"]] == ["t1", "t4"]
        assert first["entities"][0]["transactions"][0]["seller"] is None
    got = documents.flatten_transactions(nested)
    assert rows(got)[0] == ("P1", "E1", "t2", "sale", "s", "EA", "1.0", "1.0", "1999-12-31", "", "x")
    assert got.count() == 4


def export_frame(spark):
    base = dict.fromkeys(exports.EXPORT_COLUMNS)
    data = [
        {**base, "row_idx": 2, "request_id": " R1", "transaction_id": "1", "quantity": "$1,5", "amount": "2.50", "invoice_date": "3/5/2024", "offer_key": "o", "earnings": "1.5", "status": "Pending", "participant_key": "P"},
        {**base, "row_idx": 3, "request_id": "R2", "transaction_id": "2", "offer_key": "o", "earnings": "0", "status": " pending "},
        {**base, "row_idx": 4},
        {**base, "row_idx": 5, "request_id": "R1", "transaction_id": "3", "earnings": "4", "status": "pending"},
        {**base, "row_idx": 6, "request_id": "R1", "status": "skip"},
        {**base, "row_idx": 7, "request_id": "R3", "status": None},
    ]
    columns = ["row_idx", *exports.EXPORT_COLUMNS]
    return spark.createDataFrame([tuple(d[c] for c in columns) for d in data], "row_idx int, " + ", ".join(f"{c} string" for c in columns[1:]))


def test_exports(spark, rows):
    df = export_frame(spark)
    pending = exports.pending_rows(df)
    assert [r[0] for r in pending.select("row_idx").orderBy("row_idx").collect()] == [2, 3, 5]
    assert exports.count_requests(pending).first()[0] == 2
    assert exports.rows_of_requests(df, " R3,,R2 ").count() == 2
    blocks = exports.request_text(pending).orderBy("first_row").collect()
    assert [b["request_id"] for b in blocks] == ["R1", "R2"]
    lines = blocks[0]["block"].split("\n")
    assert lines[:5] == ["{", '    "request_id": "R1"', '    "participant_key": "P"', '    "transactions": [', "        {"]
    assert '            "quantity": 15' in lines and '            "invoice_date": "2024-03-05"' in lines
    assert '                        "o": 1.5' in lines and '            "expected_incentives": []' in lines
    made = exports.request_documents(pending).collect()
    assert [(m["request_id"], m["participant_key"], len(m["entities"][0]["transactions"])) for m in made] == [("R1", "P", 3)]
    parts = exports.request_documents(pending, page_rows=2).collect()
    assert sum(len(m["entities"][0]["transactions"]) for m in parts) == 3 and len(parts) > 1
    after = {r["row_idx"]: r["status"] for r in exports.mark_exported(df).collect()}
    assert (after[2], after[3], after[6], after[7]) == ("exported", "exported", "skip", None)
    dotted = df.withColumnsRenamed({"purchaser_id": "purchaser.id", "seller_key": "seller.key"})
    assert exports.undotted(dotted).columns == df.columns


def test_hot_keys_are_paged_without_being_told(spark, rows):
    """A request, participant or test with many rows is never one array."""
    from saleswright import scale

    size = scale.PAGE_ROWS
    n = size + 3
    base = {c: F.lit(None).cast("string") for c in exports.EXPORT_COLUMNS}
    hot = spark.range(n).select(
        F.col("id").alias("row_idx"),
        *[v.alias(c) for c, v in {**base, "request_id": F.lit("R"), "participant_key": F.lit("P"), "transaction_id": F.col("id").cast("string"), "status": F.lit("pending")}.items()],
    )
    want = [(0, size), (1, 3)]
    made = exports.request_documents(exports.pending_rows(hot))
    assert rows(made.select("part_no", F.size(F.col("entities")[0]["transactions"]))) == want
    blocks = exports.request_text(exports.pending_rows(hot))
    lines = F.regexp_count("block", F.lit('"transaction_id"'))
    assert rows(blocks.select("part_no", lines)) == want
    flat = hot.withColumns({"entity_id": F.lit("E"), "invoice_date": F.lit("1/1/00")})
    nested = documents.nest_transactions(flat)
    assert rows(nested.select("part_no", F.size(F.col("entities")[0]["transactions"]))) == want
    # A test without a scenario is a key like any other.
    test = hot.select(
        F.lit(None).cast("string").alias("scenario_id"), F.lit("T").alias("test_id"), "row_idx", "transaction_id",
        *[F.lit("").alias(c) for c in ("transaction_type", "uom", "txn_id", "seller", "offer_key", "sku", "quantity", "total", "date")],
        F.lit(0.0).alias("earnings"),
    )
    text = exports.scenario_text(test, "P")
    assert rows(text.select("part_no", F.regexp_count("block", F.lit('"transaction_id"')))) == want


def test_reports(spark):
    data = [("A", "Earned Amount to Date", 1.0, 1), ("A", "Earned Amount to Date", 2.5, 2), ("B", "Earned Amount to Date", -4.0, 3),
            ("B", "Remaining Earnable Amount to Date", 10.0, 4), ("", "Earned Amount to Date", 99.0, 5), ("Z", "Earned Amount to Date", 99.0, 6)]
    df = spark.createDataFrame(data, "program_label string, metric_key string, metric_value double, row_idx int")
    got = {r["line_no"]: r for r in metrics.program_report(df, metrics.two_program_lines("A", "B")).collect()}
    assert len(got) == 7
    assert (got[5]["a"], got[5]["b"], got[5]["total"], got[5]["b_text"], got[5]["total_text"]) == (2.5, -4.0, -1.5, "-$4.00", "-$1.50")
    assert (got[7]["a"], got[7]["b"], got[7]["total"]) == (2.5, 6.0, 8.5)
    assert (got[1]["a"], got[1]["a_text"]) == (0.0, "0")
    keys = spark.createDataFrame([("# Growers with Net Positive Invoiced Seed Acres", 3.0, 1), ("# Growers with Net Negative Invoiced Seed Acres", 2.0, 2), ("Earned Amount to Date", 7.0, 3)],
                                 "metric_key string, metric_value double, row_idx int")
    matched = {r["line_no"]: r for r in metrics.program_report(keys, metrics.matched_lines("Seed", "Spray")).collect()}
    assert (matched[3]["a"], matched[3]["b"], matched[3]["matched"]) == (5.0, 0.0, 0.0)
    assert (matched[5]["a"], matched[5]["b"]) == (7.0, None)


def test_qualification(spark):
    scenarios = spark.createDataFrame([
        ("y", "yoy", "A, B", "B", "", "10", "", ""), ("z", "yoy", "A", "A", "50%", "10", "", ""), ("m", "minQual", "A", "A", "", "", "99", "2"),
        ("e", "earningsOnly", "A", "A", "", "", "", "x"), ("n", "yoy", "A", "A", "", "10", "", "")],
        "scenario_id string, test_type string, qualifying_skus string, earning_skus string, target_percent string, current_rate string, min_percent string, earning_percent string")
    frames = spark.createDataFrame([(s, o, l, c, a, b) for s in "yzn" for o, l, c, a, b in [
        (0, "p0", False, "2021-01-01", "2021-12-31"), (1, "p1", False, "2022-01-01", "2022-12-31"), (2, "now", True, "2023-01-01", "2023-12-31")]],
        "scenario_id string, ordinal int, label string, is_current boolean, start_date string, end_date string")
    sales = spark.createDataFrame([
        ("y", "1", "2021-05-01", "A", "999"), ("y", "1", "2022-12-31", "A", "100"), ("y", "1", "2023-01-01", "B", "95.00"), ("y", "1", "", "A", "5"), ("y", "1", "2023-02-01", "C", "7"),
        ("y", "2", "2022-01-01", "A", "100"), ("y", "2", "2023-01-01", "A", "94.99"),
        ("z", "1", "2022-06-01", "A", "100"), ("z", "1", "2023-06-01", "A", "50x"),
        ("m", "1", "", "A", "50"), ("m", "1", "2020-01-01", "A", ""), ("e", "1", "2020-01-01", "A", "50"), ("n", "1", "2023-01-01", "A", "50")],
        "scenario_id string, test_id string, date string, sku string, total string")
    got = {(r["scenario_id"], r["test_id"]): r for r in qualification.qualify(scenarios, frames, sales).collect()}
    assert (got["y", "1"]["qualified"], got["y", "1"]["earnings"], got["y", "1"]["achieved_percent"]) == (True, 9.5, 95.0)
    assert (got["y", "1"]["qualifying_transactions"], got["y", "1"]["earning_transactions"]) == (4, 1)
    assert (got["y", "2"]["qualified"], got["y", "2"]["earnings"]) == (False, 0.0)
    assert (got["z", "1"]["qualified"], got["z", "1"]["earnings"]) == (True, 5.0)
    assert (got["m", "1"]["qualified"], got["m", "1"]["earnings"], got["m", "1"]["qualifying_transactions"]) == (True, 1.0, 2)
    assert (got["e", "1"]["qualified"], got["e", "1"]["earnings"], got["e", "1"]["qualifying_transactions"]) == (True, 0.0, 0)
    assert (got["n", "1"]["qualified"], got["n", "1"]["achieved_percent"]) == (False, 0.0)
    totals = {(r["scenario_id"], r["test_id"], r["label"]): r["total"] for r in qualification.frame_totals(scenarios, frames, sales).collect()}
    assert (totals["y", "1", "p0"], totals["y", "1", "p1"], totals["y", "1", "now"], totals["n", "1", "p0"]) == (999.0, 100.0, 95.0, 0.0)
    tally = {r["scenario_id"]: (r["qualified"], r["not_qualified"]) for r in qualification.qualification_tally(qualification.qualify(scenarios, frames, sales)).collect()}
    assert tally["y"] == (1, 1)


def test_tests_without_a_sale(spark, rows):
    from workload import programs

    scenarios = spark.createDataFrame(
        [("m", "minQual", "A", "A", "", "", "99", "2"), ("y", "yoy", "A", "A", "", "10", "", "")],
        "scenario_id string, test_type string, qualifying_skus string, earning_skus string, target_percent string, current_rate string, min_percent string, earning_percent string")
    frames = spark.createDataFrame([("y", 0, "old", False, "2022-01-01", "2022-12-31"), ("y", 1, "now", True, "2023-01-01", "2023-12-31")],
        "scenario_id string, ordinal int, label string, is_current boolean, start_date string, end_date string")
    sales = spark.createDataFrame([("m", "1", "", "A", "50"), ("y", "9", "2023-01-01", "A", "5")], "scenario_id string, test_id string, date string, sku string, total string")
    tests = spark.createDataFrame([("m", "1"), ("m", "2"), ("y", "1")], "scenario_id string, test_id string")
    got = qualification.qualify(scenarios, frames, sales, tests)
    picked = got.select("scenario_id", "test_id", "qualified", "earnings", "current_total", "qualifying_transactions", "earning_transactions")
    assert rows(picked) == [
        ("m", "1", True, 1.0, None, 1, 1), ("m", "2", True, 0.0, None, 0, 0),
        ("y", "1", False, 0.0, 0.0, 0, 0), ("y", "9", False, 0.0, 5.0, 1, 1),
    ]
    assert rows(qualification.qualification_tally(got)) == [("m", 2, 0), ("y", 0, 2)]
    totals = qualification.frame_totals(scenarios, frames, sales, tests)
    assert rows(totals.select("test_id", "label", "total")) == [("1", "now", 0.0), ("1", "old", 0.0), ("9", "now", 5.0), ("9", "old", 0.0)]
    # Every customer of the tables is a test.
    folder = "/root/testdata/sf0.001"
    tally = programs.ALL["qualification_tally"][0](spark, folder)
    no_sales = list(programs._inputs(spark, folder))
    no_sales[2] = no_sales[2].limit(0)
    assert tally.agg(F.sum(F.col("qualified") + F.col("not_qualified"))).first()[0] == qualification.qualify(*no_sales).count() == 150


def test_customers(spark, rows):
    grid = spark.createDataFrame([
        ("f", "S", 0, 1, ["title", None, None]), ("f", "S", 0, 2, [None, "Cust", "Other"]), ("f", "S", 0, 3, ["x", " Ann ", "1"]),
        ("f", "S", 0, 4, ["x", "Bob", "UPC"]), ("f", "S", 0, 5, ["x", "Ann", "2"]), ("f", "S", 0, 6, ["x", None, "3"]), ("f", "S", 0, 7, ["x", "Late", "4"])], cf.GRID_SCHEMA)
    mapping = spark.createDataFrame([
        (1, "f", "S", '"Cust"', "A1:C2", "A2:C6"), (2, "f", "S", '"Cust"', "A1:C2", "A2:C7"), (3, "f", "S", "c", "", "A3:C5"),
        (4, "g", "", "$$ Zed $$", "", ""), (5, "g", "", "$$Zed$$", "", ""), (6, "f", "S", " ", "", "A1:C9"), (7, "f", "S", "Gone", "A1:C2", "A2:C9"), (8, "f", "S", "Cust", "A1:C2", "oops")],
        "pos int, `File_Name ` string, Sheet_name string, CUSTOMER_NAME string, header_range string, data_range string")
    split = customers.customer_name_mapping(mapping)
    assert split.count() == 7 and split.filter("static_value = 'Zed' and customer_name = ''").count() == 2
    assert rows(customers.customer_values(split, grid).select("file_name", "customer_name")) == sorted([
        ("f", "Ann"), ("f", "Bob"), ("f", "1"), ("f", "2"), ("f", "UPC"), ("g", "Zed"), ("g", "Zed")])


def test_records(spark, rows):
    payloads = ['[{"a":1,"b":null},{"a":"x"}]', '{"data":5,"items":[{"c":true,"d":{"e":[1]}}]}', '{"b":2.5}', "not json", '{"it\'s":"q"}']
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    table = records.tabulate(records.unpack_envelope(df, "payload"))
    assert table.columns == ["a", "b", "c", "d", "it's"]
    assert rows(table) == sorted([("1", "", "", "", ""), ("x", "", "", "", ""), ("", "", "TRUE", '{"e":[1]}', ""), ("", "2.5", "", "", ""), ("", "", "", "", "q")])


def test_defaults(spark):
    df = spark.createDataFrame([("s", "1", 5, None, "", None), ("s", "1", 9, "own", "gal", "t")], "scenario_id string, test_id string, row_idx int, txn_id string, uom string, transaction_type string")
    filled = exports.fill_defaults(df.withColumns({"seller": F.lit(None).cast("string"), "offer_key": F.lit("")}))
    got = [tuple(r) for r in filled.select("txn_id", "uom", "transaction_type", "seller").orderBy("row_idx").collect()]
    assert got == [("01", "oz", cf.DEFAULT_TRANSACTION_TYPE, ""), ("own", "gal", "t", "")]
