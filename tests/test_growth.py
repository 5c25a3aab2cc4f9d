"""What steps cost as tables grow: shuffles, sorts and memory, with the same results."""

import random
import re
import sys
import tracemalloc

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright import config as cf
from saleswright import scale
from saleswright.operators import ledger_checks, profile, projection
from saleswright.plans.payment_run import normalize_transactions
from saleswright.sources import envelopes, grids
from workload import ledgers, views

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(scale, "BROADCAST_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_views_are_not_dealt_out_again(spark, monkeypatch):
    for name in ("repartition", "repartitionByRange"):
        monkeypatch.setattr(DataFrame, name, lambda *a: pytest.fail("shuffled once more"))
    rows = views.landed(spark, DATA, "growth", "SELECT s_suppkey AS s FROM {supplier}")
    assert rows.count() == views.table(spark, DATA, "supplier").count()
    text = "SELECT l_orderkey FROM {lineitem} WHERE l_orderkey % 2 = 1"
    assert views.raw_table(spark, DATA, text).count() == views.in_spark(spark, DATA, text).count()


def test_many_rows_are_not_sorted_for_their_facts(spark, rows, no_broadcast):
    big = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    small = spark.createDataFrame([(k, f"f{k}") for k in range(5)], "k long, fact string")
    met = scale.attach(big, small, ["k"])
    assert "Sort" not in plan(met)
    assert rows(met) == [(i % 7, i, f"f{i % 7}") for i in sorted(range(100), key=lambda i: repr((i % 7, i))) if i % 7 < 5]


def test_rows_are_shuffled_once_for_a_ledger(spark, rows, no_broadcast):
    run = ledgers._run(spark, DATA)
    staged = projection.placed_rows(run.rows(by_block=True))
    above = plan(staged).split("ShuffledHashJoin")[0]
    assert "Window" in above and "Exchange" not in above
    want = rows(ledgers.shown(run.ledger))
    scale.BROADCAST_BYTES = 1 << 26
    again = normalize_transactions(views.grid(spark, DATA), views.in_spark(spark, DATA, ledgers.BASE_MAPPING), cf.BASE_LEDGER)
    assert rows(ledgers.shown(again.ledger)) == want


def test_checks_look_at_one_run(spark, monkeypatch):
    made = []
    run = ledgers._run
    monkeypatch.setattr(ledgers, "_run", lambda *a: made.append(a) or run(*a))
    folder = f"{DATA}/"
    ledgers.qc_issues(spark, folder)
    assert len(made) == 1


def test_records_of_a_file_are_not_held_all_at_once():
    content = ("é,b,c,d,e,f\r\n" * 300_000).encode()
    frames = grids._whole_files(iter([pd.DataFrame({"file_name": ["f"], "content": [content]})]))
    tracemalloc.start()
    got = [(f["row_idx"].min(), f["row_idx"].max()) for f in frames]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [(i * 10_000 + 1, (i + 1) * 10_000) for i in range(30)]
    assert peak < 5 * sys.getsizeof(content)


def test_an_envelope_is_walked_where_it_is_read(spark, tmp_path):
    records = ",".join(f'{{"key": "{i}", "more": {{"n": 1}}, "note": "a }} {{ b"}}' for i in range(2000))
    (tmp_path / "d.json").write_text(f'{{"data": [{records}], "end": 1}}')
    blocks = envelopes._block_facts(envelopes._pieces(spark, str(tmp_path)).mapInArrow(envelopes._facts_only, envelopes._schema(envelopes.WALKED)))
    assert blocks.count() == 1
    united = envelopes._pieces(spark, str(tmp_path)).mapInArrow(
        envelopes._unite({(r["file"], r["start"]): (r["inside"], r["objects"], r["arrays"], r["units"]) for r in blocks.collect()}, True),
        envelopes._schema(list(envelopes.UNITED)))
    assert "Exchange" not in plan(united) and "Sort" not in plan(united)
    got = envelopes.read_envelope(spark, str(tmp_path), "key string").orderBy("pos").collect()
    assert [r["key"] for r in got] == [str(i) for i in range(2000)]


def test_marks_of_an_envelope_are_counted_in_bytes():
    pick = random.Random(1)
    texts = ["".join(pick.choice('"\\{}[]a é🙂\n,') for _ in range(pick.randrange(30))) + "}" for _ in range(400)]
    got = envelopes._opened(pa.array(["cut off", *texts])[1:])
    for i, text in enumerate(texts):
        bare = re.sub(r"(?s)\\.", "__", text)
        assert got["flips"][i] == bare.count('"') % 2
        for q in (0, 1):
            outside = "".join(('"' * q + bare).split('"')[::2])
            assert got[f"objects{q}"][i] == outside.count("{") - outside.count("}")
            assert got[f"arrays{q}"][i] == outside.count("[") - outside.count("]")


def test_units_of_an_envelope_are_made_in_one_walk(spark, tmp_path):
    records = ",".join(f'{{"key": "{i}", "more": {{"n": 1}}}}' for i in range(500))
    (tmp_path / "d.json").write_text(f'{{"x": [{{"key": "no"}}], "data": [ {records}\n , {{"key": "last"}}], "end": 1}}')
    pieces = envelopes._pieces(spark, str(tmp_path))
    blocks = envelopes._block_facts(pieces.mapInArrow(envelopes._facts_only, envelopes._schema(envelopes.WALKED)))
    facts = {(r["file"], r["start"]): (r["inside"], r["objects"], r["arrays"], r["units"]) for r in blocks.collect()}
    flags = pieces.mapInArrow(envelopes._unite(facts), envelopes._schema(list(envelopes.UNITED))).select("whole").collect()
    assert {r[0] for r in flags} == {0, 1}
    got = envelopes.read_envelope(spark, str(tmp_path), "key string").orderBy("pos").collect()
    assert [r["key"] for r in got] == [*map(str, range(500)), "last"]


def test_the_many_rows_of_sheets_are_not_sorted_to_profile_them(spark):
    density = profile.row_density(views.grid(spark, DATA))
    # Only the first rows of the sheets pass the one aggregate that sorts.
    assert len(re.findall(r"HashAggregate\(", plan(density))) == 2
    whole = views.grid(spark, DATA)
    assert density.agg(F.sum("n")).first()[0] == whole.count()
    assert density.filter("head_row IS NOT NULL AND head_cells IS NULL").isEmpty()


def test_landed_files_are_written_by_compiled_code(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(name), []
    views.landed_path(spark, DATA, "compiled", lambda path: seen.append(int(spark.conf.get(name))))
    assert seen[0] <= 8000
    assert spark.conf.get(name) == before


def test_failed_checks_are_exploded_from_a_column(spark, rows):
    ledger = views.stored(spark, DATA, "growth_ledger", lambda: ledgers._run(spark, DATA).ledger)
    failed = ledger_checks.failing_rows(ledger)
    generators = re.findall(r"Generate explode\((.*?)\), \[", plan(failed))
    assert generators and all(re.fullmatch(r"h#\d+", g) for g in generators)
    empty = spark.createDataFrame([{n: None for n in cf.BASE_LEDGER.names}], ledger.schema)
    assert ledger_checks.failing_rows(empty).count() == 2
    full = empty.withColumns({"item_description": F.lit("--"), "uom": F.lit("EA")})
    assert [(r["check"], r["column_name"]) for r in ledger_checks.failing_rows(full).collect()] == [("Junk values", "item_description")]


def test_blocks_are_as_many_as_the_rows_need(spark):
    """Sheets whose row numbers reach far have one block, large ones few, and none is too large."""
    def sheet(name, numbers):
        return spark.createDataFrame([(name, "s", n) for n in numbers], "file_name string, sheet_name string, row_idx long")

    grid = sheet("sparse", range(1, 10**9, 10**8)).union(sheet("even", range(0, 100_000, 1000)))
    grid = grid.union(sheet("uneven", [*range(1, 81), 10**6]))
    widths = projection.block_widths(grid, 10)
    blocks = projection.with_blocks(grid, widths).groupBy("file_name", "block").count().collect()
    sizes = {f: [r["count"] for r in blocks if r["file_name"] == f] for f in ("sparse", "even", "uneven")}
    assert sizes["sparse"] == [10]
    assert len(sizes["even"]) == 10 and max(sizes["even"]) <= 20
    assert max(sizes["uneven"]) <= 10
    last = {r["file_name"]: r["last"] for r in widths.collect()}
    assert last == {f: max(r["block"] for r in blocks if r["file_name"] == f) for f in ("even", "uneven")}


def test_a_ledger_of_many_blocks_is_numbered_alike(spark, rows, no_broadcast, monkeypatch):
    want = rows(ledgers.shown(ledgers._run(spark, DATA).ledger))
    monkeypatch.setattr(projection.block_widths, "__defaults__", (50,))
    run = ledgers._run(spark, DATA)
    assert run.staged.filter("block > 0").count() > 0
    assert rows(ledgers.shown(run.ledger)) == want
    scale.BROADCAST_BYTES = 1 << 26
    assert rows(ledgers.shown(ledgers._run(spark, DATA).ledger)) == want


def test_fields_are_resolved_without_a_row_for_each(spark):
    mapping = projection.with_ranges(projection.active_mapping(views.in_spark(spark, DATA, ledgers.BASE_MAPPING), cf.BASE_LEDGER))
    header = F.array(*[F.lit(h) for h in views.HEADERS[0]])
    prepared = projection.resolve_fields(scale.settled(mapping.withColumn("header_cells", header)), cf.BASE_LEDGER)
    assert "Generate" not in plan(prepared) and "Exchange" not in plan(prepared)
    assert prepared.count() == mapping.count()
