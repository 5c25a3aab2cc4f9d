"""Customer lookups, and files that are written and read back."""

from __future__ import annotations

import datetime as dt
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from saleswright.config import BASE_LEDGER
from saleswright.functions.text import file_stem
from saleswright.operators import customers as cu
from saleswright.operators import documents as docs
from saleswright.operators import snapshots as sn
from saleswright.plans.template_run import template_records, with_contractor
from saleswright.scale import scratch_path, settled
from saleswright.sources import files, sinks
from saleswright.sources.grids import read_delimited_grid
from saleswright.streaming.folder_drop import ingest_drops
from workload import audits, documents, ledgers, sheets
from workload import views as v
from workload.views import in_duckdb, in_spark, money, s

ALL = {}

# -- customers ---------------------------------------------------------------------

_HEADER = "CASE " + " ".join(
    f"WHEN s % 4 = {k} THEN '\"{ledgers.QUOTED[k]['desc_txt']}\"'" for k in (0, 1, 2)
) + " ELSE 'd' END"
_ROWS = f"""SELECT s * 2 AS pos, 'Credits' AS `Source_File`, {v.FILE} AS `File_Name `, {v.SHEET} AS sheet_name,
 CASE WHEN s % 9 = 8 THEN ' ' WHEN s % 6 = 0 THEN ' $$ Acme ' || {s('s')} || ' $$' ELSE {_HEADER} END AS customer_name,
 CASE WHEN s % 4 = 3 THEN '' ELSE 'A' || {s(v.HEADER_ROW)} || ':H' || {s(v.HEADER_ROW)} END AS header_range,
 CASE WHEN s % 10 = 7 THEN 'none' ELSE 'A' || {s(v.HEADER_ROW)} || ':H{ledgers.LAST_ROW}' END AS data_range FROM {sheets.SUPPLIERS}"""
CUSTOMERS = f"{_ROWS} UNION ALL " + _ROWS.replace("s * 2 AS pos", "s * 2 + 1 AS pos") + " WHERE s % 5 = 0"


def _mapping(spark, sf):
    return cu.customer_name_mapping(in_spark(spark, sf, CUSTOMERS))


ALL["customer_mapping_split"] = (
    lambda spark, sf: _mapping(spark, sf),
    in_duckdb(f"""SELECT pos, Source_File AS source_file, "File_Name " AS file_name, sheet_name, header_range, data_range,
 CASE WHEN customer_name LIKE '%$$%' THEN '' ELSE customer_name END AS customer_name,
 CASE WHEN customer_name LIKE '%$$%' THEN trim(replace(customer_name, '$', '')) ELSE '' END AS static_value
 FROM ({CUSTOMERS.replace('`', '"')}) c WHERE trim(customer_name) <> ''""".replace("trim(replace(customer_name, '$', ''))", "trim(replace(trim(customer_name), '$', ''))")),
)


def customer_values(spark, sf):
    return cu.customer_values(_mapping(spark, sf), v.grid(spark, sf)).select("file_name", "customer_name")


_LOOKUP = "s % 9 <> 8 AND s % 6 <> 0 AND s % 10 <> 7"
ALL["customer_values"] = (
    customer_values,
    in_duckdb(f"""SELECT "File_Name " AS file_name, trim(replace(trim(customer_name), '$', '')) AS customer_name
 FROM ({CUSTOMERS.replace('`', '"')}) c WHERE customer_name LIKE '%$$%' UNION ALL
SELECT * FROM (SELECT DISTINCT {v.FILE} AS file_name, trim(desc_txt) AS customer_name FROM ({v.DIRTY}) d WHERE desc_txt <> '' AND {_LOOKUP}
 UNION SELECT {v.FILE}, 'Total' FROM {sheets.SUPPLIERS} WHERE s % 4 = 1 AND {_LOOKUP}
 UNION SELECT {v.FILE}, 'c4' FROM {sheets.SUPPLIERS} WHERE s % 4 = 3 AND {_LOOKUP}) u"""),
)

# -- overrides and file names --------------------------------------------------------


def override_fallback(spark, sf):
    names = v.table(spark, sf, "supplier").select(F.concat(F.lit("dist_"), "s_suppkey", F.lit(".csv")).alias("file_name"))
    overrides = files.clean_overrides(in_spark(spark, sf, sheets.OVERRIDES))
    found = with_contractor(names, overrides)
    banner = sinks.template_banner(found)
    return found.select("file_name", "contractor").join(banner, "file_name").withColumn("stem", file_stem(F.col("file_name")))


ALL["override_fallback"] = (
    override_fallback,
    in_duckdb(f"""SELECT {v.FILE} AS file_name, {sheets._CONTRACTOR} AS contractor, 'POS Transactional Detail Report' AS title,
 'Submitted by: ' || CASE WHEN s % 5 = 3 THEN s_name ELSE '' END AS submitted_by, '' AS address,
 CASE WHEN s % 5 = 3 THEN '2024-05-01' ELSE '' END AS report_date, 'dist ' || CAST(s AS VARCHAR) AS stem FROM {sheets.SUPPLIERS}"""),
)

# -- files written and read back -----------------------------------------------------


def source_delimited(spark, sf):
    """A report with a header, read by name."""
    path = scratch_path(spark, "report") + ".csv"
    sinks.write_report(in_spark(spark, sf, f"SELECT p_partkey, p_name || ', \"' || p_brand || '\"' AS description, {money('p_retailprice')} AS price FROM {{part}}"), path)
    return files.read_transactions(spark, path).withColumn("price", F.col("price").cast("double"))


ALL["source_delimited"] = (
    source_delimited,
    in_duckdb("SELECT CAST(p_partkey AS INT) AS p_partkey, p_name || ', \"' || p_brand || '\"' AS description, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price FROM {part}"),
)


def _grid_of_files(whole_file_bytes):
    def query(spark, sf):
        path = scratch_path(spark, "grids")
        rows = in_spark(spark, sf, f"SELECT {s('o_orderkey')} AS a, '' AS b, o_orderpriority || ', é \"x\"' AS c, {money('o_totalprice')} AS d FROM {{orders}}")
        rows.write.option("escape", '"').option("emptyValue", "").csv(path)
        grid = read_delimited_grid(spark, path, whole_file_bytes=whole_file_bytes)
        per_file = grid.groupBy("file_name").agg(F.max("row_idx").alias("last"), F.count(F.lit(1)).alias("n"))
        # Numbers run from 1 to the number of rows in every file.
        dense = per_file.select("file_name", (F.col("last") == F.col("n")).alias("dense"))
        return grid.join(dense, "file_name").select(
            F.get("cells", F.lit(0)).alias("a"), F.get("cells", F.lit(1)).alias("b"), F.get("cells", F.lit(2)).alias("c"),
            F.get("cells", F.lit(3)).alias("d"), "dense",
        )
    return query


_GRID_ORACLE = in_duckdb(f"SELECT {s('o_orderkey')} AS a, CAST(NULL AS VARCHAR) AS b, o_orderpriority || ', é \"x\"' AS c, {money('o_totalprice')} AS d, TRUE AS dense FROM {{orders}}")
ALL["source_grid_whole_files"] = (_grid_of_files(1 << 26), _GRID_ORACLE)
ALL["source_grid_by_line"] = (_grid_of_files(0), _GRID_ORACLE)


def source_snapshot(spark, sf):
    path = scratch_path(spark, "snapshot")
    sinks.write_documents(documents._records(spark, sf, documents.NEW).drop("pos"), path)
    return files.read_snapshot_lines(spark, path).drop("pos").distinct()


ALL["source_snapshot"] = (
    source_snapshot,
    in_duckdb(f"SELECT DISTINCT key, product_key, superseded_by FROM ({documents.NEW}) x"),
)


# All line items in the order in which a snapshot lists them; a key is listed many times.
_LISTED = f"SELECT key, product_key, superseded_by, pos FROM ({documents._snapshot('TRUE')}) x"
_ORDER = "pos, key, coalesce(superseded_by, '')"


def _record_texts(rows):
    """JSON texts with braces and quotes inside of values, in order."""
    odd = F.lit('a "quoted" } brace { and [ a \\ in "')
    return F.to_json(F.struct("key", "product_key", "superseded_by", odd.alias("note"), F.struct(F.lit(1).alias("n")).alias("more")))


def source_envelope(spark, sf):
    """One JSON document in one file without a line break, its records in order."""
    def stretches(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict({"value": [" ".join(batch.column("value").to_pylist())]})

    def write(path):
        rows = in_spark(spark, sf, f"SELECT *, coalesce(superseded_by, '') AS last FROM ({_LISTED}) y")
        first = v.table(spark, sf, "region").limit(1).select(F.lit('{"version":{"n":1,"tags":["a}","{"]},"skipped":[{"key":"no","list":[{"k":1}]}],"data":[').alias("value"), F.lit(0).alias("at"), F.lit(0).alias("pos"), F.lit("").alias("key"), F.lit("").alias("last"))
        last = first.withColumn("value", F.lit('{"key":"end"}],"more":[{"key":"no"}],"total":{"n":5}}')).withColumn("at", F.lit(2))
        texts = rows.select(F.concat(_record_texts(rows), F.lit(",")).alias("value"), F.lit(1).alias("at"), "pos", "key", "last")
        lines = first.unionByName(texts).unionByName(last).orderBy("at", "pos", "key", "last").select("value")
        # Many tasks sort the lines and join them to stretches; the one that writes the file only copies those.
        joined = settled(lines.mapInArrow(stretches, "value string").withColumn("no", F.monotonically_increasing_id()))
        joined.orderBy("no").select("value").coalesce(1).write.option("lineSep", " ").text(path)

    path = v.landed_path(spark, sf, "envelope", write)
    return files.read_snapshot(spark, path)


ALL["source_envelope"] = (
    source_envelope,
    in_duckdb(f"""SELECT row_number() OVER (ORDER BY {_ORDER}) + 1 AS pos, key, product_key, superseded_by FROM ({_LISTED}) x
 UNION ALL SELECT (SELECT count(*) FROM ({_LISTED}) n) + 2, 'end', NULL, NULL"""),
)


def _many_files(spark, sf, name, text, per_file, kind):
    """Rows dealt to files by ``pos``: a folder for each stretch, named so that names sort."""
    def write(path):
        rows = in_spark(spark, sf, text).withColumn("part", F.lpad(F.floor(F.col("pos") / per_file).cast("string"), 9, "0"))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ordered = rows.repartition(parts, "part").sortWithinPartitions("part", "pos", "key", F.coalesce("superseded_by", F.lit("")))
        ordered.drop("pos").write.partitionBy("part").option("header", True).format(kind).save(path)

    return v.landed_path(spark, sf, name, write)


def snapshot_line_order(spark, sf):
    """Many files of lines repeat the keys; the last line of a key wins."""
    path = _many_files(spark, sf, "snapshot-lines", _LISTED, 50_000, "json")
    return sn.latest_by_key(files.read_snapshot_lines(spark, path))


ALL["snapshot_line_order"] = (
    snapshot_line_order,
    in_duckdb(f"""SELECT key, product_key, superseded_by FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos DESC, coalesce(superseded_by, '') DESC) AS r FROM ({_LISTED}) x) y WHERE r = 1"""),
)
_OVERRIDES = f"""SELECT 'Dist_' || {s('o_custkey % 500')} || '.csv' AS filename, o_orderpriority || {s('o_orderkey')} AS contractor,
 o_orderkey AS pos, '' AS key, '' AS superseded_by FROM {{orders}}"""


def overrides_file_order(spark, sf):
    """Many override files repeat the names; the last listed wins."""
    path = _many_files(spark, sf, "overrides", _OVERRIDES, 5_000, "csv")
    return files.read_overrides(spark, path).select("file_key", "contractor", "wholesaler_name")


ALL["overrides_file_order"] = (
    overrides_file_order,
    in_duckdb(f"""SELECT lower(filename) AS file_key, arg_max(contractor, pos) AS contractor, '' AS wholesaler_name FROM ({_OVERRIDES}) x GROUP BY filename"""),
)


def source_documents(spark, sf):
    path = scratch_path(spark, "documents")
    sinks.write_documents(docs.nest_transactions(v.raw_table(spark, sf, documents.FLAT)), path)
    return docs.flatten_transactions(files.read_documents(spark, path)).withColumns(
        {c: F.col(c).cast("double") for c in ("quantity", "amount")}
    )


ALL["source_documents"] = (source_documents, documents.ALL["flatten_transactions"][1])


def sink_ledger(spark, sf):
    """Two runs appended to one ledger; keys of different runs differ."""
    path = scratch_path(spark, "ledger")
    for run_id in ("first", "second"):
        run = ledgers.normalize_transactions(v.grid(spark, sf), in_spark(spark, sf, ledgers.BASE_MAPPING), run_id=run_id)
        sinks.append_ledger_files(run.ledger, path, BASE_LEDGER)
    ledger = sinks.read_ledger_files(spark, path, BASE_LEDGER)
    return ledger.groupBy("archive_file_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("transaction_id").alias("n_keys"), F.max("row_id").alias("last_row")
    )


ALL["sink_ledger"] = (
    sink_ledger,
    in_duckdb(f"SELECT archive_file_name, count(*) * 2 AS n, count(*) * 2 AS n_keys, CAST(count(*) AS INT) AS last_row FROM {ledgers.LOADED} l GROUP BY archive_file_name"),
)


_BATCH = f"""SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'dup' || {s('o_orderkey % 5')}
 ELSE 'k' || {s('o_orderkey')} END AS transaction_id FROM {{orders}}"""


def sink_checked_ledger(spark, sf):
    """A third of the orders, then all of them with missing and repeated keys among them."""
    path, quarantine = scratch_path(spark, "ledger"), scratch_path(spark, "quarantine")

    def batch(text):
        rows = in_spark(spark, sf, text).withColumn("row_id", F.col("row_id").cast("int"))
        others = {n: F.lit(None).cast(BASE_LEDGER.schema[n].dataType) for n in BASE_LEDGER.names if n not in rows.columns}
        return rows.withColumns(others)

    first = f"SELECT o_orderkey AS row_id, 'k' || {s('o_orderkey')} AS transaction_id FROM {{orders}} WHERE o_orderkey % 3 = 0"
    for text in (first, _BATCH):
        sinks.append_checked(batch(text), path, quarantine, BASE_LEDGER)
    kept = sinks.read_ledger_files(spark, path, BASE_LEDGER).withColumn("key_fault", F.lit(""))
    names = ["row_id", "transaction_id", "key_fault"]
    return kept.select(names).unionByName(spark.read.parquet(quarantine).select(names))


ALL["sink_checked_ledger"] = (
    sink_checked_ledger,
    in_duckdb(f"""SELECT CAST(o_orderkey AS INT) AS row_id, 'k' || {s('o_orderkey')} AS transaction_id, '' AS key_fault FROM {{orders}} WHERE o_orderkey % 3 = 0 UNION ALL
SELECT CAST(row_id AS INT), transaction_id, CASE WHEN transaction_id IS NULL THEN 'missing key' WHEN count(*) OVER (PARTITION BY transaction_id) > 1 THEN 'repeated key'
 WHEN row_id % 3 = 0 AND transaction_id LIKE 'k%' THEN 'known key' ELSE '' END FROM ({_BATCH}) b"""),
)


def sink_profiles(spark, sf):
    """Profiles of both variants in one mapping table; their columns meet by name."""
    path = scratch_path(spark, "profiles")
    sinks.append_profile_table(sheets.profile_base(spark, sf), path)
    credit = sheets.profile_credit(spark, sf)
    sinks.append_profile_table(credit.withColumn("material_group_number", F.lit("g")), path)
    return sinks.read_profile_table(spark, path)


def _profile_text(query, group):
    names = ", ".join(f"coalesce({c}, '') AS {c}" for c in sheets._PROFILE_COLUMNS)
    return f"SELECT {names}, '{group}' AS material_group_number FROM ({query}) p{group}"


ALL["sink_profiles"] = (
    sink_profiles,
    _profile_text(sheets.ALL["profile_files_base"][1], "") + " UNION ALL " + _profile_text(sheets.ALL["profile_files_credit"][1], "g"),
)


def sink_saved_mappings(spark, sf):
    """Mappings of every part brand and type, then new ones for some sizes."""
    path = scratch_path(spark, "mappings")
    old = in_spark(spark, sf, "SELECT DISTINCT p_brand || p_type AS signature, 'field_' || CAST(p_size % 3 AS STRING) AS field, 'old' AS header, TIMESTAMP '2024-01-01 00:00:00' AS saved_at FROM {part}")
    new = in_spark(spark, sf, "SELECT DISTINCT p_brand || p_type AS signature, 'field_9' AS field, 'new' AS header, TIMESTAMP '2024-02-01 00:00:00' AS saved_at FROM {part} WHERE p_type = 'PROMO'")
    sinks.save_mappings(old, old.limit(0), path)
    sinks.save_mappings(files.read_saved_mappings(spark, path), new, path)
    return files.read_saved_mappings(spark, path).drop("saved_at")


ALL["sink_saved_mappings"] = (
    sink_saved_mappings,
    in_duckdb("""SELECT DISTINCT p_brand || p_type AS signature, 'field_' || CAST(p_size % 3 AS VARCHAR) AS field, 'old' AS header FROM {part} WHERE p_type <> 'PROMO'
 UNION SELECT DISTINCT p_brand || p_type, 'field_9', 'new' FROM {part} WHERE p_type = 'PROMO'"""),
)


def sink_reports(spark, sf):
    """Flattened transactions as dated reports of two runs, which do not replace one another."""
    path = scratch_path(spark, "reports")
    flat = docs.flatten_transactions(docs.nest_transactions(v.raw_table(spark, sf, documents.FLAT)))
    for day, run_id in ((1, "a"), (2, "b")):
        sinks.write_dated_report(flat.filter(F.col("quantity").cast("double") % 2 == day % 2), path, dt.date(2024, 5, day), run_id)
    rows = files.read_delimited(spark, path)
    return rows.select(
        "participant_key", "entity_id", "transaction_id", "invoice_date", F.col("amount").cast("double").alias("amount"), "run_id",
        F.col("run_date").cast("string").alias("run_date"),
    )


ALL["sink_reports"] = (
    sink_reports,
    in_duckdb(f"""SELECT participant_key, entity_id, transaction_id, CAST(d AS VARCHAR) AS invoice_date, CAST(amount AS DOUBLE) AS amount,
 CASE WHEN CAST(quantity AS INT) % 2 = 1 THEN 'a' ELSE 'b' END AS run_id, CASE WHEN CAST(quantity AS INT) % 2 = 1 THEN '2024-05-01' ELSE '2024-05-02' END AS run_date
 FROM ({documents._FLAT_D}) f"""),
)


def sink_tables(spark, sf):
    """File totals as a table, which a later run replaces."""
    table = f"totals_{uuid.uuid4().hex}"
    totals = settled(audits.file_totals(spark, sf))
    sinks.replace_table(totals.filter("transaction_count > 3").withColumn("run", F.lit(1)), table)
    sinks.replace_table(totals.withColumn("run", F.lit("second")), table)
    return spark.table(table)


ALL["sink_tables"] = (sink_tables, f"SELECT *, 'second' AS run FROM ({audits.ALL['file_totals'][1]}) t")


def sink_conversion(spark, sf):
    """Converted records and the lines above them as two tables, read back together."""
    path = scratch_path(spark, "conversion")
    found = settled(sheets._scan(spark, sf))
    sinks.write_conversion(template_records(v.grid(spark, sf), found, computed=True), found, path)
    banner = spark.read.parquet(f"{path}/banner")
    return spark.read.parquet(f"{path}/records").join(banner, "file_name").drop("address")


ALL["sink_conversion"] = (
    sink_conversion,
    f"""SELECT t.* EXCLUDE (row_idx), 'POS Transactional Detail Report' AS title, 'Submitted by: ' || CASE WHEN s % 5 = 3 THEN s_name ELSE '' END AS submitted_by,
 CASE WHEN s % 5 = 3 THEN '2024-05-01' ELSE '' END AS report_date FROM ({sheets.ALL['convert_template'][1]}) t JOIN {in_duckdb(sheets.SUPPLIERS)} ON t.file_name = {in_duckdb(v.FILE)}""",
)


def source_mapping(spark, sf):
    """Mapping rows with padded names, entities, and rows without any text."""
    path = scratch_path(spark, "mapping")
    rows = in_spark(spark, sf, f"""SELECT CASE WHEN s_suppkey % 5 = 0 THEN '  ' ELSE ' a &amp; ' || s_name || ' &lt;' || {s('s_suppkey')} || '&gt; ' END AS ` File name `,
 CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 3 = 0 THEN NULL ELSE '"Q&eacute;ty"' END AS ship_quantity FROM {{supplier}}""")
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.read_mapping(spark, path, decode_entities=True).withColumnRenamed("File name", "file_name")


ALL["source_mapping"] = (
    source_mapping,
    in_duckdb(f"""SELECT 'a & ' || s_name || ' <' || {s('s_suppkey')} || '>' AS file_name, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '"Qéty"' END AS ship_quantity
 FROM {{supplier}} WHERE s_suppkey % 5 <> 0"""),
)


def stream_folder_drop(spark, sf):
    """Events land as files in two drops; each drop is cleaned and stored once."""
    folder, target, marks = (scratch_path(spark, n) for n in ("drop", "stored", "marks"))
    events = v.table(spark, sf, "events").select("event_id", "event_type", F.concat(F.lit("$"), F.col("value").cast("decimal(18,2)")).alias("amount"))
    schema = "event_id bigint, event_type string, amount string"

    def clean(batch):
        from saleswright.functions.cleaning import number
        return batch.withColumn("amount", number(F.col("amount"))).drop("source_file")

    for is_error in (True, False):
        part = events.filter((F.col("event_type") == "error") == F.lit(is_error))
        part.write.mode("append").json(folder)
        ingest_drops(spark, folder, schema, target, marks, clean, max_files=4)
    return spark.read.parquet(target).drop("batch_id")


ALL["stream_folder_drop"] = (
    stream_folder_drop,
    in_duckdb("SELECT event_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM {events}"),
)
