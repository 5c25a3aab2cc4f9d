"""Snapshots, nested documents, exports and open records."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswright.operators import documents as docs
from saleswright.operators import exports as ex
from saleswright.operators import snapshots as sn
from saleswright.scale import PAGE_ROWS
from saleswright.sources.records import (
    cell_columns,
    cell_rows,
    record_cells,
    tabulate,
    unpack_envelope,
)
from workload import views as v
from workload.views import in_duckdb, in_spark, money, s

ALL = {}

# -- product snapshots: what was shipped before 1999, and since --------------------

# A product is a part, a key is a part, return flag and half of the line numbers. The first
# parts have no product key and so count as one product.
_KEY = f"{s('l_partkey')} || '-' || l_returnflag || {s('l_linenumber % 2')}"


def _snapshot(when: str) -> str:
    return f"""SELECT {_KEY} AS key, CASE WHEN l_partkey < 40 THEN NULL ELSE 'brand-' || {s('l_partkey')} END AS product_key,
 CASE WHEN l_linestatus = 'F' AND l_partkey % 3 = 0 THEN {s('l_partkey')} || '-R1' WHEN l_partkey % 3 = 1 THEN '' END AS superseded_by,
 l_orderkey * 8 + l_linenumber AS pos FROM {{lineitem}} WHERE {when}"""


OLD = _snapshot("year(l_shipdate) < 1999")
NEW = _snapshot("year(l_shipdate) >= 1999")
_LATEST = """SELECT key, any_value(product_key) AS product_key,
 max(superseded_by) AS superseded_by FROM ({}) x GROUP BY key"""


def _records(spark, sf, text):
    rows = in_spark(spark, sf, text)
    # The highest position wins; equal positions are told apart by the successor.
    return rows.withColumn("pos", F.struct(F.coalesce("superseded_by", F.lit("")), "pos"))


def snapshot_latest(spark, sf):
    return sn.latest_by_key(_records(spark, sf, NEW))


def sku_changes(spark, sf):
    return sn.sku_changes(
        sn.latest_by_key(_records(spark, sf, OLD)), sn.latest_by_key(_records(spark, sf, NEW))
    )


def product_changes(spark, sf):
    return sn.product_changes(
        sn.latest_by_key(_records(spark, sf, OLD)), sn.latest_by_key(_records(spark, sf, NEW))
    )


_SIDES = f"""WITH old AS ({_LATEST.format(OLD)}), new AS ({_LATEST.format(NEW)}),
lost AS (SELECT product_key, key FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.key = old.key AND new.product_key IS NOT DISTINCT FROM old.product_key)),
gained AS (SELECT product_key, key FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE new.key = old.key AND new.product_key IS NOT DISTINCT FROM old.product_key))"""
ALL["snapshot_latest"] = (snapshot_latest, in_duckdb(_LATEST.format(NEW)))
ALL["sku_changes"] = (
    sku_changes,
    in_duckdb(f"""{_SIDES}
SELECT product_key, key, 'new' AS change_type, '' AS old_sku_key, '' AS new_sku_key, '' AS note FROM new
 WHERE key NOT IN (SELECT key FROM old) AND key NOT IN (SELECT superseded_by FROM new WHERE superseded_by <> '') UNION ALL
SELECT product_key, key, 'removed', '', '', '' FROM old WHERE key NOT IN (SELECT key FROM new) UNION ALL
SELECT lost.product_key, gained.key, 'updated', lost.key, gained.key, '' FROM lost JOIN gained ON lost.product_key IS NOT DISTINCT FROM gained.product_key UNION ALL
SELECT product_key, key, 'change', key, superseded_by, 'superseded' FROM new WHERE superseded_by <> ''"""),
)
ALL["product_changes"] = (
    product_changes,
    in_duckdb(f"""{_SIDES} SELECT product_key, CAST(sum(l) AS BIGINT) AS lost, CAST(sum(g) AS BIGINT) AS gained FROM (SELECT product_key, 1 AS l, 0 AS g FROM lost
 UNION ALL SELECT product_key, 0, 1 FROM gained) x GROUP BY product_key"""),
)



def sku_change_log(spark, sf):
    """The same log without pairs: a row for each key that a product lost or gained."""
    return sn.change_log(_records(spark, sf, OLD), _records(spark, sf, NEW))


ALL["sku_change_log"] = (
    sku_change_log,
    in_duckdb(f"""{_SIDES},
n_lost AS (SELECT product_key AS p, count(*) AS lost_keys FROM lost GROUP BY product_key),
n_gained AS (SELECT product_key AS p, count(*) AS gained_keys FROM gained GROUP BY product_key),
classes AS (SELECT n_lost.p, lost_keys, gained_keys FROM n_lost JOIN n_gained ON n_lost.p IS NOT DISTINCT FROM n_gained.p)
SELECT product_key, key, 'new' AS change_type, '' AS old_sku_key, '' AS new_sku_key, '' AS note, CAST(NULL AS BIGINT) AS lost_keys, CAST(NULL AS BIGINT) AS gained_keys FROM new
 WHERE key NOT IN (SELECT key FROM old) AND key NOT IN (SELECT superseded_by FROM new WHERE superseded_by <> '') UNION ALL
SELECT product_key, key, 'removed', '', '', '', NULL, NULL FROM old WHERE key NOT IN (SELECT key FROM new) UNION ALL
SELECT product_key, key, 'change', key, superseded_by, 'superseded', NULL, NULL FROM new WHERE superseded_by <> '' UNION ALL
SELECT product_key, key, 'lost', key, '', '', lost_keys, gained_keys FROM lost JOIN classes ON product_key IS NOT DISTINCT FROM p UNION ALL
SELECT product_key, key, 'gained', '', key, '', lost_keys, gained_keys FROM gained JOIN classes ON product_key IS NOT DISTINCT FROM p"""),
)

# -- nested documents: customers, their orders' priorities, their orders ------------

_D = "(SELECT *, CAST(o_orderdate AS DATE) AS d FROM {orders}) o"
FLAT = f"""SELECT o_orderkey AS row_idx, 'cust-' || {s('o_custkey')} AS participant_key, o_orderpriority AS entity_id,
 {s('o_orderkey')} AS transaction_id, 'sale' AS transaction_type, 'sku-' || o_orderstatus AS sku_key, 'EA' AS uom_key,
 {s('o_orderkey % 50')} AS quantity, {money('o_totalprice')} AS amount, {v.US_DATE} || {v.SHORT_YEAR} AS invoice_date,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '' ELSE 'buyer-' || {s('o_custkey % 7')} END AS purchaser_id,
 CASE WHEN o_orderkey % 4 > 0 THEN 'seller-' || {s('o_orderkey % 4')} END AS seller_key FROM {_D}"""


def nest_transactions(spark, sf, page_rows=PAGE_ROWS):
    nested = docs.nest_transactions(v.raw_table(spark, sf, FLAT), page_rows=page_rows)
    entity = F.explode("entities").alias("e")
    return nested.select("participant_key", "part_no", entity).select(
        "participant_key", "part_no", F.col("e.id").alias("entity_id"),
        F.size("e.transactions").alias("n"),
        F.array_join(F.transform("e.transactions", lambda t: t["transaction_id"]), ",").alias("ids"),
        F.to_json(F.get("e.transactions", F.lit(0))).alias("first_transaction"),
    )


_JSON = f"""'{{{{"transaction_id":"' || transaction_id || '","transaction_type":"sale","sku_key":"' || sku_key || '","uom_key":"EA","quantity":' || quantity || '.0,"amount":'
 || regexp_replace(amount, '([.][0-9])0$', '\\1') || ',"invoice_date":"' || CAST(d AS VARCHAR) || '","properties":[]'
 || CASE WHEN purchaser_id <> '' THEN ',"purchaser":{{{{"id":"' || purchaser_id || '"}}}}' ELSE '' END
 || CASE WHEN seller_key <> '' THEN ',"seller":{{{{"key":"' || seller_key || '"}}}}' ELSE '' END || '}}}}'""".replace("{{", "{").replace("}}", "}")
_FLAT_D = FLAT.replace("AS seller_key FROM", "AS seller_key, d FROM")


def _page(key, page_rows):
    """The page of a row among the rows of its key."""
    return f"(row_number() OVER (PARTITION BY {key} ORDER BY row_idx) - 1) // {page_rows} AS part_no"


def _nested_sql(page_rows):
    return in_duckdb(f"""SELECT participant_key, part_no, entity_id, CAST(count(*) AS INT) AS n,
 string_agg(transaction_id, ',' ORDER BY row_idx) AS ids, first(j ORDER BY row_idx) AS first_transaction
 FROM (SELECT *, {_JSON} AS j, {_page('participant_key', page_rows)} FROM ({_FLAT_D}) f) t GROUP BY participant_key, part_no, entity_id""")


ALL["nest_transactions"] = (
    nest_transactions,
    _nested_sql(PAGE_ROWS),
)
ALL["nest_transactions_paged"] = (lambda spark, sf: nest_transactions(spark, sf, 4), _nested_sql(4))


def flatten_transactions(spark, sf):
    """Nest, cut hot participants into parts of 8 rows, and flatten again."""
    nested = docs.nest_transactions(v.raw_table(spark, sf, FLAT), page_rows=8)
    return docs.flatten_transactions(nested).withColumns(
        {c: F.col(c).cast("double") for c in ("quantity", "amount")}
    )


ALL["flatten_transactions"] = (
    flatten_transactions,
    in_duckdb(f"""SELECT participant_key, entity_id, transaction_id, transaction_type, sku_key, uom_key, CAST(quantity AS DOUBLE) AS quantity,
 CAST(amount AS DOUBLE) AS amount, CAST(d AS VARCHAR) AS invoice_date, coalesce(purchaser_id, '') AS purchaser_id, coalesce(seller_key, '') AS seller_key FROM ({_FLAT_D}) f"""),
)

# -- exports: one row per event -----------------------------------------------------

_STATUS = """CASE WHEN event_id % 6 = 0 THEN 'pending' WHEN event_id % 6 = 1 THEN ' Pending ' WHEN event_id % 6 = 2 THEN 'skip'
 WHEN event_id % 6 = 3 THEN 'exported' END"""
EXPORT = f"""SELECT event_id AS row_idx, CASE WHEN event_id % 30 = 29 THEN NULL ELSE ' R' || {s('user_id')} END AS request_id,
 CASE WHEN event_id % 30 = 29 THEN '' ELSE {s('event_id')} END AS transaction_id,
 CASE WHEN event_id % 30 = 29 THEN NULL ELSE {s('month(d)')} || '/' || {s('day(d)')} || '/' || {s('year(d)')} END AS invoice_date,
 CASE WHEN event_id % 30 = 29 THEN NULL ELSE event_type END AS sku_key, CASE WHEN event_id % 30 = 29 THEN NULL ELSE 'oz' END AS uom_key,
 CASE WHEN event_id % 30 = 29 THEN NULL ELSE {s('event_id % 40')} || ' units' END AS quantity,
 CASE WHEN event_id % 30 = 29 THEN NULL ELSE '$' || {money('value')} END AS amount, CASE WHEN event_id % 30 = 29 THEN NULL ELSE 'sale' END AS transaction_type,
 CASE WHEN event_id % 30 = 29 THEN NULL WHEN event_id % 5 = 0 THEN '0' ELSE {s('event_id % 9')} || '.5' END AS earnings,
 CASE WHEN event_id % 30 = 29 THEN NULL ELSE 'b' || {s('user_id % 3')} END AS purchaser_id, CASE WHEN event_id % 30 = 29 THEN NULL ELSE 's1' END AS seller_key,
 CASE WHEN event_id % 30 = 29 OR event_id % 4 = 0 THEN NULL ELSE 'offer_' || {s('event_id % 4')} END AS offer_key,
 CASE WHEN event_id % 30 = 29 THEN NULL ELSE 'P' || {s('user_id % 10')} END AS participant_key,
 CASE WHEN event_id % 30 = 29 THEN NULL ELSE {_STATUS} END AS status
FROM (SELECT *, CAST(ts AS DATE) AS d FROM {{events}}) e"""
_PENDING = f"(SELECT * FROM ({EXPORT}) e WHERE lower(trim(status)) = 'pending')"
_CLEAN = f"""(SELECT row_idx, trim(request_id) AS request_id, transaction_id, sku_key, CAST(replace(quantity, ' units', '') AS DOUBLE) AS quantity,
 CAST(replace(amount, '$', '') AS DOUBLE) AS amount, CAST(earnings AS DOUBLE) AS earnings, purchaser_id, coalesce(offer_key, '') AS offer_key, participant_key,
 strftime(strptime(invoice_date, '%m/%d/%Y'), '%Y-%m-%d') AS invoice_date FROM {_PENDING} p)"""


def export_fields(spark, sf):
    rows = ex.clean_transactions(ex.pending_rows(v.raw_table(spark, sf, EXPORT)))
    return rows.select(
        "row_idx", "request_id", "transaction_id", "sku_key", "quantity", "amount", "earnings",
        "purchaser_id", "offer_key", "participant_key", "invoice_date",
    )


ALL["export_fields"] = (export_fields, in_duckdb(f"SELECT * FROM {_CLEAN} c"))


def export_request_text(spark, sf, page_rows=PAGE_ROWS):
    return ex.request_text(ex.pending_rows(v.raw_table(spark, sf, EXPORT)), page_rows)


def _num(x):
    return f"regexp_replace(regexp_replace(CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR), '0+$', ''), '[.]$', '')"


_NL = "chr(10)"
_PAD = " " * 12
_BLOCK = f"""'        {{' || {_NL} || '{_PAD}"transaction_id": "' || transaction_id || '"' || {_NL} || '{_PAD}"transaction_type": "sale"' || {_NL}
 || '{_PAD}"sku_key": "' || sku_key || '"' || {_NL} || '{_PAD}"uom_key": "oz"' || {_NL} || '{_PAD}"quantity": ' || {_num('quantity')} || {_NL}
 || '{_PAD}"amount": ' || {_num('amount')} || {_NL} || '{_PAD}"invoice_date": "' || invoice_date || '"' || {_NL}
 || '{_PAD}"seller": {{' || {_NL} || '{_PAD}    "key": "s1"' || {_NL} || '{_PAD}}}' || {_NL}
 || '{_PAD}"purchaser": {{' || {_NL} || '{_PAD}    "id": "' || purchaser_id || '"' || {_NL} || '{_PAD}}}' || {_NL}
 || '{_PAD}"expected_incentives": ' || CASE WHEN offer_key <> '' AND earnings > 0 THEN '[' || {_NL} || '{" " * 20}{{' || {_NL}
 || '{" " * 24}"' || offer_key || '": ' || {_num('earnings')} || {_NL} || '{" " * 20}}}' || {_NL} || '{" " * 16}]' ELSE '[]' END || {_NL} || '        }}'"""


def _request_sql(page_rows):
    return in_duckdb(f"""SELECT request_id, part_no, min(row_idx) AS first_row, first(participant_key ORDER BY row_idx) AS participant_key,
 '{{' || {_NL} || '    "request_id": "' || request_id || '"' || {_NL} || '    "participant_key": "' || first(participant_key ORDER BY row_idx) || '"' || {_NL}
 || '    "transactions": [' || {_NL} || string_agg({_BLOCK}, {_NL} ORDER BY row_idx) || {_NL} || '    ]' || {_NL} || '}}' AS block
 FROM (SELECT *, {_page('request_id', page_rows)} FROM {_CLEAN} c) p GROUP BY request_id, part_no""".replace("{{", "{").replace("}}", "}"))


ALL["export_request_text"] = (export_request_text, _request_sql(PAGE_ROWS))
ALL["export_request_text_paged"] = (lambda spark, sf: export_request_text(spark, sf, 3), _request_sql(3))


def export_documents(spark, sf, page_rows=PAGE_ROWS):
    made = ex.request_documents(ex.pending_rows(v.raw_table(spark, sf, EXPORT)), page_rows)
    rows = made.select("participant_key", "request_id", "part_no", F.explode(F.col("entities")[0]["transactions"]).alias("t"))
    return rows.select(
        "participant_key", "request_id", "part_no", "t.transaction_id", "t.quantity", "t.amount",
        "t.invoice_date", F.col("t.purchaser.id").alias("purchaser_id"),
    )




def _documents_sql(page_rows):
    return in_duckdb(f"""SELECT (SELECT first(participant_key ORDER BY row_idx) FROM {_CLEAN} a) AS participant_key,
 (SELECT first(request_id ORDER BY row_idx) FROM {_CLEAN} b) AS request_id, (row_number() OVER (ORDER BY row_idx) - 1) // {page_rows} AS part_no,
 transaction_id, quantity, amount, invoice_date, purchaser_id FROM {_CLEAN} c""")


ALL["export_documents"] = (export_documents, _documents_sql(PAGE_ROWS))
ALL["export_documents_paged"] = (lambda spark, sf: export_documents(spark, sf, 100), _documents_sql(100))
ALL["count_requests"] = (
    lambda spark, sf: ex.count_requests(ex.pending_rows(v.raw_table(spark, sf, EXPORT))),
    in_duckdb(f"SELECT count(DISTINCT request_id) AS n_requests FROM {_CLEAN} c"),
)


def export_by_request(spark, sf):
    """Rows of the requests that a table of comma lists names: those of each user's first event type."""
    wanted = in_spark(spark, sf, f"SELECT ' R' || {s('c_custkey')} || ' ,, R' || {s('c_custkey + 1')} || 'x' AS request_id FROM {{customer}} WHERE c_mktsegment = 'BUILDING'")
    rows = ex.rows_of_request_table(v.raw_table(spark, sf, EXPORT), wanted)
    return rows.select("row_idx", "request_id", "status")


ALL["export_by_request"] = (
    export_by_request,
    in_duckdb(f"""SELECT row_idx, request_id, status FROM ({EXPORT}) e WHERE coalesce(lower(trim(status)), '') <> 'skip'
 AND trim(request_id) IN (SELECT 'R' || CAST(c_custkey AS VARCHAR) FROM {{customer}} WHERE c_mktsegment = 'BUILDING')"""),
)


def set_status(spark, sf):
    rows = v.raw_table(spark, sf, EXPORT)
    exported = ex.mark_exported(rows)
    failed = v.table(spark, sf, "events").filter("event_type = 'error'").select(F.col("event_id").alias("row_idx"))
    reset = ex.set_status_of(exported, failed, "row_idx", "")
    return reset.select("row_idx", F.coalesce("status", F.lit("~")).alias("status"))


ALL["set_status"] = (
    set_status,
    in_duckdb(f"""SELECT row_idx, CASE WHEN row_idx IN (SELECT event_id FROM {{events}} WHERE event_type = 'error') THEN ''
 WHEN lower(trim(status)) = 'pending' THEN 'exported' ELSE coalesce(status, '~') END AS status FROM ({EXPORT}) e"""),
)

# -- open records -------------------------------------------------------------------

PAYLOADS = """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN '[' || props || ',{"flag":true,"k":null}]'
 WHEN event_id % 4 = 1 THEN '{"items":[' || props || '],"data":5}' WHEN event_id % 4 = 2 THEN '{"data":[{"list":[1,2],"kind":"' || event_type || '"}]}'
 ELSE props END AS payload FROM {events}""".replace("{", "{{").replace("}", "}}").replace("{{events}}", "{events}")


def tabulate_records(spark, sf):
    records = unpack_envelope(v.raw_table(spark, sf, PAYLOADS), "payload")
    return tabulate(records, keep=["event_id"])


ALL["tabulate_records"] = (
    tabulate_records,
    in_duckdb("""SELECT event_id, CASE WHEN event_id % 4 = 2 THEN '' ELSE json_extract_string(props, '$.k') END AS k, '' AS flag,
 CASE WHEN event_id % 4 = 2 THEN event_type ELSE '' END AS kind, CASE WHEN event_id % 4 = 2 THEN '[1,2]' ELSE '' END AS list FROM {events}
 UNION ALL SELECT event_id, '', 'TRUE', '', '' FROM {events} WHERE event_id % 4 = 0"""),
)

WRITTEN = """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '{"items":[{"z":' || @I || '.0,"a":' || @K || 'e3,"o":{"b":[1,2.50,"x"],"a":null}},{"s":"q","t":false}]}'
 WHEN event_id % 3 = 1 THEN '[{"n":-' || @I || ',"b":true,"e":null,"deep":[{"y":' || @K || '.5,"x":{}}]}, 5]' ELSE '{"kind":"' || event_type || '","big":12345678901234567890}' END AS payload FROM {events}"""
WRITTEN = WRITTEN.replace("{", "{{").replace("}", "}}").replace("{{events}}", "{events}").replace("@I", s("event_id")).replace("@K", s("1 + event_id % 7"))


def record_texts(spark, sf):
    """Names and texts of records as data, as they were written."""
    return cell_rows(record_cells(v.raw_table(spark, sf, WRITTEN), "payload"), ["event_id"])


def record_columns(spark, sf):
    """Some names as columns."""
    return cell_columns(record_cells(v.raw_table(spark, sf, WRITTEN), "payload"), ["z", "kind", "none"], ["event_id"])


_I, _K = "CAST(event_id AS VARCHAR)", "CAST(1 + event_id % 7 AS VARCHAR)"
_CELLS = [
    (0, 0, "z", f"{_I} || '.0'"), (0, 0, "a", f"{_K} || '000.0'"), (0, 0, "o", """'{"b": [1, 2.5, "x"], "a": null}'"""),
    (0, 1, "s", "'q'"), (0, 1, "t", "'FALSE'"), (1, 0, "n", f"CASE WHEN event_id = 0 THEN '0' ELSE '-' || {_I} END"),
    (1, 0, "b", "'TRUE'"), (1, 0, "e", "''"), (1, 0, "deep", f"""'[{{{{"y": ' || {_K} || '.5, "x": {{{{}}}}}}}}]'"""),
    (2, 0, "kind", "event_type"), (2, 0, "big", "'12345678901234567890'"),
]
ALL["record_texts"] = (
    record_texts,
    " UNION ALL ".join(
        f"SELECT event_id, {no} AS record_no, '{name}' AS name, {text} AS text FROM events WHERE event_id % 3 = {kind}" for kind, no, name, text in _CELLS
    ).replace("{{", "{").replace("}}", "}"),
)
ALL["record_columns"] = (
    record_columns,
    f"""SELECT event_id, no AS record_no, CASE WHEN event_id % 3 = 0 AND no = 0 THEN {_I} || '.0' ELSE '' END AS z,
 CASE WHEN event_id % 3 = 2 THEN event_type ELSE '' END AS kind, '' AS none FROM events JOIN (SELECT unnest([0, 1]) AS no) n ON no = 0 OR event_id % 3 < 2""",
)
