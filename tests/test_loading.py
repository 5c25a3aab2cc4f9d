"""Conditions that fail alone, envelopes, file order, key checks, versions and the product log."""

import json
import random

import pytest
from pyspark.sql import functions as F

from saleswright import config as cf
from saleswright.operators import conditions, keys, projection, reports, snapshots
from saleswright.plans.payment_run import normalize_transactions
from saleswright.sources import envelopes, files, records, sinks, versions


def test_casts_are_found():
    text = "((CAST(`a ) AS x` AS INT) > 5) AND (CAST(concat('it\\'s AS (', CAST(b AS DOUBLE)) AS DATE) IS NULL)) AND TRY_CAST(c AS INT) = 1"
    assert conditions.casts_in(text) == [
        ("`a ) AS x`", "INT"), ("b", "DOUBLE"), ("concat('it\\'s AS (', CAST(b AS DOUBLE))", "DATE")]


def test_conditions_are_checked_alone(spark):
    check = lambda text: conditions.check_condition(spark, text)
    good = check("\"Unit Price\" > 5 AND Qty IS NOT NULL AND qty <> 'x \"y\"'")
    assert good.error is None and sorted(n.lower() for n in good.names) == ["qty", "unit price"]
    assert [c[0].strip("`") for c in good.casts] == ["Unit Price"]
    assert check("Qty IS NOT").error == conditions.SYNTAX
    assert check("no_such_function(Qty)").error == conditions.INVALID
    assert check("Qty").error == conditions.INVALID
    assert check("sum(Qty) > 1").error == conditions.INVALID
    assert spark.conf.get(conditions.ANSI) == "true"


LOAD = [
    ("f", [["Order", "Qty"], ["o1", "5"], ["o2", "x"], ["o3", "7"], [None, None]]),
    ("g", [["Order", "Qty"], ["o1", "5"], ["o2", "0"], ["o3", None]]),
    ("h", [["Order", "Number"], ["o1", "5"]]),
]


def load(spark, filters):
    grid = [(f, "S", 0, i, cells) for f, rows in LOAD for i, cells in enumerate(rows, 1)]
    mapped = {"f": '"Qty"', "g": '"Qty"', "h": '"Number"'}
    mapping = [(f, "S", "A1:B9", "A1:B1", '"Order"', mapped[f], filters.get(f, "")) for f in mapped]
    names = ["file_name", "sheet_name", "data_range", "header_range", "sales_order_number", "ship_quantity", "filter"]
    return normalize_transactions(
        spark.createDataFrame(grid, cf.GRID_SCHEMA), spark.createDataFrame(mapping, names), run_id="r")


@pytest.mark.parametrize("store_first", [True, False])
def test_bad_conditions_fail_their_mapping_rows(spark, store_first):
    # Of one text, f has a cell that the cast does not bear, h no such column, and g is fine.
    run = load(spark, dict.fromkeys("fgh", "WHERE \"Qty\" > 0 AND 10 / \"Qty\" > 1"))
    if store_first:
        assert [r["row_id"] for r in run.ledger.collect()] == [1]
    meta = {r["archive_file_name"]: r for r in run.metadata.collect()}
    assert {f: (r["status"], r["condition_error"], r["raw_rows"], r["loaded_rows"]) for f, r in meta.items()} == {
        "f": ("failed", "cast failed", 4, 0), "g": ("loaded", "", 3, 1),
        "h": ("failed", "unknown column: Qty", 1, 0)}
    assert {tuple(r)[:1] for r in run.ledger.select("archive_file_name").collect()} == {("g",)}
    assert run.bad_values.count() == 0


def test_a_syntax_error_leaves_the_others(spark):
    run = load(spark, {"f": "\"Qty\" >", "g": "upper(\"Order\") = 'O2'"})
    got = {(r["archive_file_name"], r["row_id"], r["sales_order_number"]) for r in run.ledger.collect()}
    assert got == {("g", 1, "o2"), ("h", 1, "o1")}
    assert {r["condition_error"] for r in run.metadata.collect()} == {"", "syntax error"}


def test_numbers_over_blocks(spark):
    rows = [(m, "f", "s", i, i % (m + 2) > 0, m == 3) for m in (1, 2, 3) for i in range(1, 700)]
    staged = spark.createDataFrame(rows, "mapping_row int, file_name string, sheet_name string, row_idx long, loaded boolean, cast_failed boolean").repartition(5)
    made = {f: F.lit(None).cast("string") for f in projection.field_order(cf.BASE_LEDGER)}
    staged = staged.withColumns(made).withColumn("vendor", F.col("mapping_row").cast("string"))
    staged = staged.withColumn("customer_name", F.col("row_idx").cast("string")).withColumn("bad_fields", F.array().cast("array<string>"))
    staged = projection.placed_rows(staged, 100).cache()
    numbered = projection.number_and_label(staged, cf.BASE_LEDGER).collect()
    for m in (1, 2):
        got = sorted((int(r["customer_name"]), r["row_id"]) for r in numbered if r["vendor"] == str(m))
        assert got == [(i, n) for n, i in enumerate((i for i in range(1, 700) if i % (m + 2)), 1)]
    assert {r["vendor"] for r in numbered} == {"1", "2"}
    staged.unpersist()


def nasty(pick, depth=0):
    kind = pick.randrange(8 if depth < 3 else 4)
    if kind < 3:
        return "".join(pick.choice('ab{}[]":,\\ é\n') for _ in range(pick.randrange(8)))
    if kind == 3:
        return pick.choice([None, True, 1.5, -3])
    if kind < 6:
        return {nasty_key(pick): nasty(pick, depth + 1) for _ in range(pick.randrange(3))}
    return [nasty(pick, depth + 1) for _ in range(pick.randrange(3))]


def nasty_key(pick):
    return "".join(pick.choice('xyz{}[]" \\') for _ in range(3))


@pytest.mark.parametrize("block", ["97", "128m"])
def test_envelopes(spark, tmp_path, block):
    pick, want = random.Random(8), []
    for n in range(4):
        records = [{"key": f"{n}-{i}", "more": nasty(pick), "product_key": None if i % 3 else nasty_key(pick)} for i in range(40)]
        document = {"a": nasty(pick), "list": [1, "]", [2]], "skip": [{"key": "no"}], "o": {"p": {"q": []}}, "data": records, "z": [{"key": "no"}], "end": nasty(pick)}
        if n == 3:
            document = {"data": records}
        text = json.dumps(document, ensure_ascii=n % 2 == 0, indent=2 if n == 2 else None)
        (tmp_path / f"d{n}.json").write_text(text + ("\n" if n == 1 else ""))
        want += [(r["key"], r["product_key"]) for r in records]
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text('{"data": []}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = envelopes.read_envelope(spark, str(tmp_path), "key string, product_key string").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r["key"], r["product_key"]) for r in sorted(got, key=lambda r: r["pos"])] == want


def test_lines_are_numbered_in_file_order(spark, tmp_path):
    for n in range(12):
        (tmp_path / f"f{n:02}.json").write_text("".join(f'{{"key": "k{i % 5}", "product_key": "{n}-{i}"}}\n' for i in range(n * 3)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for block in ("60", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        got = files.read_snapshot_lines(spark, str(tmp_path)).collect()
        order = [r["product_key"] for r in sorted(got, key=lambda r: r["pos"])]
        assert order == [f"{n}-{i}" for n in range(12) for i in range(n * 3)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_overrides_of_many_files(spark, tmp_path):
    for n in range(5):
        (tmp_path / f"o{n}.csv").write_text("filename,contractor\n" + "".join(f"F{i}.csv,c{n}-{i}\n" for i in range(n, 6)))
    got = {r["file_key"]: r["contractor"] for r in files.read_overrides(spark, str(tmp_path)).collect()}
    assert got == {f"f{i}.csv": f"c{min(i, 4)}-{i}" for i in range(6)}


def test_key_faults(spark, monkeypatch):
    ledger = spark.range(0, 5000, 2).select(F.concat(F.lit("k"), "id").alias("key"))
    batch = spark.createDataFrame([(None, 1), (None, 2), ("k4", 3), ("k5", 4), ("d", 5), ("d", 6), ("k6", 7), ("k6", 8)], "key string, n int")
    want = {1: "missing key", 2: "missing key", 3: "known key", 4: None, 5: "repeated key", 6: "repeated key", 7: "repeated key", 8: "repeated key"}
    for rows in (500_000, 0):
        monkeypatch.setattr("saleswright.scale.BROADCAST_ROWS", rows)
        assert {r["n"]: r["key_fault"] for r in keys.with_key_faults(batch, ledger, "key").collect()} == want
    assert keys.with_key_faults(batch, ledger.limit(0), "key").filter("key_fault = 'known key'").count() == 0
    assert keys.with_key_faults(batch.limit(0), ledger, "key").count() == 0


def test_the_filter_loses_no_key_and_drops_most(spark):
    held = spark.range(2000).select(F.concat(F.lit("a"), "id").alias("key"))
    others = spark.range(20_000).select(F.concat(F.lit("b"), "id").alias("key"))
    table = keys.key_filter(held, "key", 8).cache()
    assert keys.may_hold(held, "key", table, 8).count() == 2000
    assert keys.may_hold(others, "key", table, 8).count() < 2000


def test_appends_keep_bad_keys_apart(spark, tmp_path):
    path, apart = str(tmp_path / "l"), str(tmp_path / "q")
    row = lambda k: tuple(k if n == "transaction_id" else None for n in cf.BASE_LEDGER.names)
    schema = ", ".join(f"{n} {cf.BASE_LEDGER.schema[n].dataType.simpleString()}" for n in cf.BASE_LEDGER.names)
    for batch in (["a", "b"], ["b", "c", None], ["d", "d"]):
        sinks.append_checked(spark.createDataFrame([row(k) for k in batch], schema), path, apart, cf.BASE_LEDGER)
    assert sorted(r[0] for r in sinks.read_ledger_files(spark, path, cf.BASE_LEDGER).select("transaction_id").collect()) == ["a", "b", "c"]
    assert spark.read.parquet(apart).count() == 4


def test_a_failed_write_loses_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "n long"
    assert versions.read_current(spark, path, schema).count() == 0
    versions.replace(spark.range(3).select(F.col("id").alias("n")), path)
    bad = spark.range(100).select(F.when(F.col("id") == 50, F.raise_error(F.lit("half-way")).cast("long")).otherwise(F.col("id")).alias("n"))
    with pytest.raises(Exception, match="half-way"):
        versions.replace(bad, path)
    assert versions.read_current(spark, path, schema).count() == 3
    now = versions.read_current(spark, path, schema)
    versions.replace(now.unionByName(now), path)
    assert versions.read_current(spark, path, schema).count() == 6


def test_profiles_of_both_variants(spark, tmp_path):
    path = str(tmp_path / "p")
    base = spark.createDataFrame([("f", "v", None)], "file_name string, vendor string, uom string")
    credit = spark.createDataFrame([("g", "m", "u")], "file_name string, material_group_number string, uom string")
    sinks.append_profile_table(base, path)
    sinks.append_profile_table(credit, path)
    got = {r["file_name"]: r.asDict() for r in sinks.read_profile_table(spark, path).collect()}
    assert got["f"] == {"file_name": "f", "vendor": "v", "uom": "", "material_group_number": ""}
    assert got["g"] == {"file_name": "g", "vendor": "", "uom": "u", "material_group_number": "m"}
    sinks.append_profile(base, str(tmp_path / "csv"))
    with pytest.raises(ValueError):
        sinks.append_profile(credit, str(tmp_path / "csv"))


def test_log_without_pairs(spark):
    schema = "key string, product_key string, superseded_by string, pos int"
    old = spark.createDataFrame([(f"o{i}", None, None, i) for i in range(40)] + [(None, "p", None, 1)], schema)
    new = spark.createDataFrame([(f"n{i}", None, "n1", i) for i in range(30)] + [(None, "q", None, 1)], schema)
    log = snapshots.change_log(old, new).cache()
    count = {r["change_type"]: r["count"] for r in log.groupBy("change_type").count().collect()}
    assert count == {"new": 29, "removed": 40, "lost": 40, "gained": 30, "change": 30}
    for part in (1, 7, 1000):
        pairs = snapshots.expand_updates(log, part).filter("change_type = 'updated'")
        assert pairs.distinct().count() == pairs.count() == 1200
    plan = snapshots.sku_changes(old, new)
    assert plan.count() == 29 + 40 + 30 + 1200
    log.unpersist()


def test_record_texts_are_those_of_the_payload(spark):
    payloads = [
        '{"data":[{"z":10.0,"a":1e3,"n":12345678901234567890,"o":{"b":[1,2.50],"a":null},"s":"é\\ud800","t":true,"e":null}, 5, [1]]}',
        '{"items":5,"k":-0.0}', "not json", None, "[]", '"text"', '[{"a":1,"a":2}]',
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, payload string")
    made = records.record_cells(df, "payload")
    got = {(r["i"], r["record_no"]): r["cells"] for r in made.collect()}
    assert got == {
        (0, 0): {"z": "10.0", "a": "1000.0", "n": "12345678901234567890", "o": '{"b": [1, 2.5], "a": null}', "s": "é?", "t": "TRUE", "e": ""},
        (0, 1): {}, (0, 2): {}, (1, 0): {"items": "5", "k": "-0.0"}, (6, 0): {"a": "2"}}
    assert {r["name"]: r["records"] for r in records.cell_names(made).collect()}["a"] == 2
    assert {tuple(r) for r in records.cell_columns(made, ["a", "k"], ["i"]).collect()} == {
        (0, 0, "1000.0", ""), (0, 1, "", ""), (0, 2, "", ""), (1, 0, "", "-0.0"), (6, 0, "2", "")}
    many = spark.range(3000).select(F.concat(F.lit('{"n'), "id", F.lit('":1}')).alias("payload"))
    assert records.cell_names(records.record_cells(many, "payload")).count() == 3000
    with pytest.raises(ValueError, match="names"):
        records.tabulate(records.unpack_envelope(many, "payload"))


def test_reports_are_in_order(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), F.lit("x").alias("row_no")).repartition(5)
    got = reports.in_order(rows, [F.col("a").desc()]).collect()
    assert sorted((r["row_number"], r["a"]) for r in got) == [(i + 1, 999 - i) for i in range(1000)]
    assert reports.in_order(rows.limit(0), [F.col("a")]).count() == 0
    reports.write_in_order(rows, [F.col("a")], str(tmp_path / "r"))
    lines = []
    for name in sorted((tmp_path / "r").glob("*.csv")):
        lines += name.read_text().split()[1:]
    assert [int(line.split(",")[0]) for line in lines] == list(range(1000))
