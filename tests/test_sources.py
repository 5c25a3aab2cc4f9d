"""Files and tables: readers, writers and the folder stream."""

import datetime as dt
import glob

import pytest

from saleswright import config as cf
from saleswright.sources import files, grids, sinks
from saleswright.streaming.folder_drop import ingest_drops


def test_delimited_grid(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("﻿a,b\n\n\"x\ny\",é\n".encode())
    (tmp_path / "win.csv").write_bytes("caf\xe9,5\" pipe\n".encode("cp1252"))
    (tmp_path / "latin.csv").write_bytes(b"\x81,1\n")
    (tmp_path / "~$lock.csv").write_bytes(b"no\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    got = [(r["file_name"], r["row_idx"], r["cells"]) for r in grids.read_delimited_grid(spark, str(tmp_path)).orderBy("file_name", "row_idx").collect()]
    assert got == [("bom.csv", 1, ["a", "b"]), ("bom.csv", 2, []), ("bom.csv", 3, ["x\ny", "é"]),
                   ("latin.csv", 1, ["\x81", "1"]), ("win.csv", 1, ["café", '5" pipe'])]


def test_large_files_are_read_by_line(spark, tmp_path, monkeypatch):
    lines = [f'{i},"a, {i}",caf\xe9' for i in range(5000)]
    (tmp_path / "big.csv").write_bytes("\n".join(lines).encode("cp1252"))
    (tmp_path / "utf.csv").write_bytes(("﻿" + "\n".join(lines)).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        by_line = grids.read_delimited_grid(spark, str(tmp_path), whole_file_bytes=0)
        whole = grids.read_delimited_grid(spark, str(tmp_path))
        pick = lambda df: sorted((r["file_name"], r["row_idx"], tuple(r["cells"])) for r in df.collect())
        got = pick(by_line)
        assert by_line.rdd.getNumPartitions() >= 1 and len(got) == 10000
        assert got == pick(whole)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_are_the_same_for_all_file_sizes(spark, tmp_path):
    """Quoted line breaks, very long cells and odd quotes, against the csv module alone."""
    import csv
    import io
    import random
    import sys

    pick = random.Random(5)
    texts = {f"odd{i}.csv": "".join(pick.choices(['"', '""', ",", "\n", "\r\n", "\r", "a", "é", ',"'], k=400)) for i in range(12)}
    texts["long.csv"] = 'a,"' + "x\n" * 100_000 + '",b\n' + "y" * 200_000 + ",1\n" + 'c,"d\r\ne"\n' * 2000
    texts["open.csv"] = 'a\n"never closed\n,b'
    texts["open_closed.csv"] = 'a\n"never closed\n,b\n'
    for name, text in texts.items():
        (tmp_path / name).write_bytes((b"\xef\xbb\xbf" if name == "odd1.csv" else b"") + text.encode())
    csv.field_size_limit(sys.maxsize)
    want = sorted(
        (name, i + 1, tuple(c or None for c in cells))
        for name, text in texts.items()
        for i, cells in enumerate(csv.reader(io.StringIO(text, newline="")))
    )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    try:
        for size in (0, 300, 1 << 26):
            got = grids.read_delimited_grid(spark, str(tmp_path), name_glob="o*.csv", whole_file_bytes=size)
            assert sorted((r["file_name"], r["row_idx"], tuple(r["cells"])) for r in got.collect()) == [w for w in want if w[0] != "long.csv"]
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        for size in (0, 1 << 26):
            got = grids.read_delimited_grid(spark, str(tmp_path), name_glob="long.csv", whole_file_bytes=size)
            assert sorted((r["file_name"], r["row_idx"], tuple(r["cells"])) for r in got.collect()) == [w for w in want if w[0] == "long.csv"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sheets_without_a_row(spark, tmp_path, rows):
    from saleswright.operators.audits import file_totals
    from saleswright.operators.grids import choose_sheet, sheet_list
    from saleswright.operators.profile import profile_files
    from saleswright.plans.template_run import scan_files

    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "full.csv").write_bytes(b"sku,extended_price\n1,2.5\n")
    grid, listed = grids.read_delimited_grid(spark, str(tmp_path)), grids.delimited_sheets(spark, str(tmp_path))
    assert rows(listed) == [("empty.csv", "empty.csv", 0, None), ("full.csv", "full.csv", 0, None)]
    assert rows(file_totals(grid, sheets=listed)) == [("'empty.csv", 0, 0.0), ("'full.csv", 1, 2.5)]
    # The first sheet is empty: it is chosen all the same.
    book = spark.createDataFrame([("b", "Second", 1, 1, ["sku", "extended_price"]), ("b", "Second", 1, 2, ["1", "2"])], cf.GRID_SCHEMA)
    sheets = spark.createDataFrame([("b", "First", 0), ("b", "Second", 1)], "file_name string, sheet_name string, sheet_ordinal int")
    assert rows(choose_sheet(sheet_list(book, sheets), "none")) == [("b", "First")]
    assert rows(file_totals(book, sheets=sheets)) == [("'b", 0, 0.0)]
    assert rows(scan_files(book, sheets=sheets).select("file_name", "sheet_name", "status")) == [("b", "First", "needs_mapping")]
    for words, variant in ((None, cf.CREDIT_PROFILE), ({"uom": ["uom"]}, cf.BASE_PROFILE)):
        before = {r["sheet_name"]: r for r in profile_files(book, words, variant).collect()}
        got = {r["sheet_name"]: r for r in profile_files(book, words, variant, sheets=sheets).collect()}
        assert got["Second"] == before["Second"] and set(got) == {"First", "Second"}
        first = got["First"]
        assert (first["headers"], first["data_range"], first["header_range"], first["use_header"], first["rows_count"]) == ("", "", "", "FALSE", "0")


def test_list_files(spark, tmp_path):
    for name in ["b.XLSX", "a.xlsm", "~$a.xlsx", "notes.txt", "sub/run_info.xlsx"]:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    names = lambda **o: [r["file_name"] for r in grids.list_files(spark, str(tmp_path), [".xlsx", ".xlsm"], **o).collect()]
    assert names() == ["a.xlsm", "b.XLSX"]
    assert names(recursive=True, contains="info") == ["run_info.xlsx"]
    assert names(keep_lock_files=True) == ["a.xlsm", "b.XLSX", "~$a.xlsx"]


def test_tables_and_config(spark, tmp_path, rows):
    (tmp_path / "t.csv").write_bytes("﻿name,n\n\"x, y\",5\n".encode())
    assert rows(files.read_transactions(spark, str(tmp_path / "t.csv"))) == [("x, y", 5)]
    with pytest.raises(ValueError):
        files.read_transactions(spark, "x.xlsx")
    (tmp_path / "m.csv").write_text(" File ,b\n a &amp; b , \n , \n")
    assert files.read_mapping(spark, str(tmp_path / "m.csv"), True).collect()[0].asDict() == {"File": "a & b", "b": ""}
    assert files.read_mapping(spark, str(tmp_path / "m.csv")).count() == 1
    (tmp_path / "o.csv").write_text("filename,contractor,wholesaler_name\nA.xlsx,x,w\n a.XLSX ,y,\n ,z,\n")
    assert rows(files.read_overrides(spark, str(tmp_path / "o.csv"))) == [("a.xlsx", "y", "", "", "")]
    assert files.read_overrides(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "c.txt").write_text("a b.csv 12\n\nc\n")
    assert rows(files.read_pasted_counts(spark, str(tmp_path / "c.txt"))) == [("a b.csv", 12), ("c", None)]
    (tmp_path / "al.csv").write_text("field,alias\nsku,Item\nsku,Part #\n")
    assert files.read_aliases(spark, str(tmp_path / "al.csv")) == {"sku": ["Item", "Part #"]}
    assert files.read_saved_mappings(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "s.json").write_text('{"a|b": {"sku": "A", "qty": "B"}}')
    assert files.read_saved_mapping_file(spark, str(tmp_path / "s.json")).count() == 2


def test_snapshots(spark, tmp_path, rows):
    (tmp_path / "s.json").write_text('{"data": [{"key": "k", "product_key": "p"},\n {"key": "k", "product_key": "q", "superseded_by": "z"}]}')
    got = files.read_snapshot(spark, str(tmp_path / "s.json"))
    assert rows(got) == [(0, "k", "p", None), (1, "k", "q", "z")]


def test_documents_with_missing_parts(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"participant_key": "P", "entities": [{"id": "E", "transactions": [{"transaction_id": "1"}]}, {"id": "F", "transactions": []}]}, {"participant_key": "Q"}]')
    from saleswright.operators.documents import flatten_transactions
    flat = flatten_transactions(files.read_documents(spark, str(tmp_path / "d.json"), multi_line=True)).collect()
    assert [tuple(r) for r in flat] == [("P", "E", "1", "", "", "", "", "", "", "", "")]


def test_reports_and_ledger(spark, tmp_path):
    empty = spark.createDataFrame([], "a string, b int")
    sinks.write_report(empty, str(tmp_path / "r"))
    assert any(open(f).read().strip() == "a,b" for f in glob.glob(str(tmp_path / "r" / "*.csv")))
    one = sinks.write_dated_report(empty, str(tmp_path / "d"), dt.date(2024, 5, 1))
    two = sinks.write_dated_report(empty, str(tmp_path / "d"), dt.date(2024, 5, 1))
    assert one != two and "run_date=2024-05-01" in one
    schema = cf.CREDIT_LEDGER.schema
    assert not schema["transaction_id"].nullable and len(schema) == 22 and len(cf.BASE_LEDGER.schema) == 23
    assert (len(cf.BASE_LEDGER.data_columns), len(cf.BASE_LEDGER.text_columns)) == (13, 9)
    assert (len(cf.CREDIT_LEDGER.data_columns), len(cf.CREDIT_LEDGER.text_columns)) == (14, 10)
    profile = spark.createDataFrame([("f", None)], "file_name string, vendor string")
    sinks.append_profile(profile, str(tmp_path / "p"))
    sinks.append_profile(profile, str(tmp_path / "p"))
    assert files.read_mapping(spark, str(tmp_path / "p")).count() == 2


def test_ledger_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS ledgers_test LOCATION '{tmp_path}/db'")
    table = "ledgers_test.base"
    sinks.create_ledger(spark, table, cf.BASE_LEDGER)
    sinks.create_ledger(spark, table, cf.BASE_LEDGER)
    row = tuple("k" if n == "transaction_id" else None for n in cf.BASE_LEDGER.names)
    df = spark.createDataFrame([row], cf.BASE_LEDGER.schema)
    sinks.append_ledger(df, table, cf.BASE_LEDGER)
    sinks.append_ledger(df, table, cf.BASE_LEDGER)
    assert spark.table(table).count() == 2
    from saleswright.operators.ledger_checks import key_violations
    assert [tuple(r) for r in key_violations(spark.table(table)).collect()] == [("k", 2)]
    sinks.replace_table(df, table)
    assert spark.table(table).count() == 1


def test_stream_does_not_repeat(spark, tmp_path):
    folder, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    for i in range(2):
        spark.createDataFrame([(i,)], "n int").write.mode("append").json(folder)
        ingest_drops(spark, folder, "n int", target, marks)
        ingest_drops(spark, folder, "n int", target, marks)
    got = spark.read.parquet(target)
    assert sorted(r["n"] for r in got.collect()) == [0, 1] and "source_file" in got.columns
