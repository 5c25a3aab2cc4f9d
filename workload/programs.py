"""Program reports and incentive qualification over all orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswright.operators import exports as ex
from saleswright.operators import metrics as me
from saleswright.operators import qualification as qu
from saleswright.scale import settled
from workload import views as v
from workload.views import in_duckdb, in_spark, s

ALL = {}

# -- reports: one per customer nation, metrics reported by every order ----------------

TWO = me.two_program_lines("HOUSEHOLD", "MACHINERY")
_KEYS_TWO = ["# Growers with Bookings or Invoices", "Booked Gallons to Date", "Booked Gallons Pre-Deadline",
             "Net Positive Invoiced Gallons to Date", "Earned Amount to Date", "Remaining Earnable Amount to Date",
             "Not reported", ""]
MATCHED = me.matched_lines("Seed", "Spray")
_KEYS_MATCHED = sorted({k for line in MATCHED for _, ks in line.columns.values() for k in ks}) + ["Other", ""]


def _metric(keys: list[str]) -> str:
    n = len(keys)
    names = " ".join(f"WHEN (o_orderkey + o_custkey) % {n} = {i} THEN '{k}'" for i, k in enumerate(keys))
    return f"""SELECT c_nationkey, c_mktsegment AS program_label, CASE {names} END AS metric_key,
 CAST(o_custkey % 1000 + o_orderkey % 100 - 300 AS DOUBLE) + 0.25 AS metric_value, o_orderkey AS row_idx
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey"""


METRICS_TWO, METRICS_MATCHED = _metric(_KEYS_TWO), _metric(_KEYS_MATCHED)


def program_report_two(spark, sf):
    return me.program_report(in_spark(spark, sf, METRICS_TWO), TWO, by=["c_nationkey"])


def program_report_matched(spark, sf):
    rows = in_spark(spark, sf, METRICS_MATCHED).drop("program_label")
    return me.program_report(rows, MATCHED, by=["c_nationkey"])


def _text(column: str, pattern: str) -> str:
    digits = {me.COUNT: 0, me.VOLUME: 3, me.MONEY: 2}[pattern]
    size = f"round(CAST(abs({column}) AS DECIMAL(18,3)), {digits})"
    whole = f"format('{{:,}}', CAST(floor({size}) AS BIGINT))"
    places = f" || '.' || lpad(CAST(CAST(({size} - floor({size})) * {10 ** digits} AS INT) AS VARCHAR), {digits}, '0')" if digits else ""
    dollar = "'$' || " if pattern == me.MONEY else ""
    return f"CASE WHEN {column} < 0 THEN '-' ELSE '' END || {dollar}{whole}{places}"


def _report_oracle(view: str, lines: list[me.ReportLine], labelled: bool) -> str:
    names = list(dict.fromkeys(c for line in lines for c in line.columns))
    key = "c_nationkey, program_label, metric_key" if labelled else "c_nationkey, metric_key"
    parts = []
    for no, line in enumerate(lines, 1):
        values = []
        for name in names:
            if name not in line.columns:
                values.append(f"CAST(NULL AS DOUBLE) AS {name}, CAST(NULL AS VARCHAR) AS {name}_text")
                continue
            program, keys = line.columns[name]
            test = "metric_key IN (" + ", ".join(f"'{k}'" for k in keys) + ")"
            if labelled:
                test += f" AND program_label = '{program}'"
            value = f"coalesce(sum(metric_value) FILTER ({test}), 0.0)"
            values.append(f"{value} AS {name}, {_text(value, line.pattern)} AS {name}_text")
        if line.total:
            tests = []
            for name in ("a", "b"):
                program, keys = line.columns[name]
                tests.append("metric_key IN (" + ", ".join(f"'{k}'" for k in keys) + f") AND program_label = '{program}'")
            value = " + ".join(f"coalesce(sum(metric_value) FILTER ({t}), 0.0)" for t in tests)
            values.append(f"({value}) AS total, {_text(f'({value})', line.pattern)} AS total_text")
        label = line.label.replace("'", "''")
        parts.append(f"SELECT c_nationkey, {no} AS line_no, '{label}' AS label, {', '.join(values)} FROM last GROUP BY c_nationkey")
    return in_duckdb(
        f"WITH m AS ({view}), last AS (SELECT {key}, arg_max(metric_value, row_idx) AS metric_value FROM m GROUP BY {key}) "
        + " UNION ALL ".join(parts)
    )


ALL["program_report_two"] = (program_report_two, _report_oracle(METRICS_TWO, TWO, True))
ALL["program_report_matched"] = (program_report_matched, _report_oracle(METRICS_MATCHED, MATCHED, False))

# -- qualification: a scenario per nation, a test per customer, every order a sale -----

SKUS = "o_orderstatus || '-' || substr(o_orderpriority, 1, 1)"
SCENARIOS = f"""SELECT 'S' || {s('n_nationkey')} AS scenario_id,
 CASE WHEN n_nationkey % 3 = 0 THEN 'yoy' WHEN n_nationkey % 3 = 1 THEN 'minQual' ELSE 'earningsOnly' END AS test_type,
 'F-1, O-2 ,,P-3, F-4,O-5' AS qualifying_skus, CASE WHEN n_nationkey % 2 = 0 THEN 'F-1,P-3' ELSE 'O-2, O-5' END AS earning_skus,
 CASE WHEN n_nationkey % 5 = 0 THEN '' WHEN n_nationkey % 5 = 1 THEN '0' ELSE {s('60 + n_nationkey')} || '%' END AS target_percent,
 '2.5' AS current_rate, '10' AS min_percent, CASE WHEN n_nationkey % 4 = 0 THEN 'x' ELSE '1.25%' END AS earning_percent FROM {{nation}}"""
_FRAME_ROWS = [(0, "Y1996", "1996", "FALSE"), (1, "Y1997", "1997", "FALSE"), (2, "Y1998", "1998", "FALSE"), (3, "Now", "1999", "TRUE")]
FRAMES = " UNION ALL ".join(
    f"SELECT 'S' || {s('n_nationkey')} AS scenario_id, {i} AS ordinal, '{label}' AS label, {current} AS is_current,"
    f" '{year}-01-01' AS start_date, '{year}-12-31' AS end_date FROM {{nation}}"
    for i, label, year, current in _FRAME_ROWS
)
SALES = f"""SELECT 'S' || {s('c_nationkey')} AS scenario_id, {s('c_custkey')} AS test_id, o_orderkey AS row_idx,
 CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE {s('CAST(o_orderdate AS DATE)')} END AS date, {SKUS} AS sku,
 CASE WHEN o_orderkey % 20 = 0 THEN '' ELSE {s('CAST(o_totalprice AS DECIMAL(18,2))')} || CASE WHEN o_orderkey % 20 = 1 THEN ' USD' ELSE '' END END AS total
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey"""
_BASE = f"""WITH sc AS ({SCENARIOS}), fr AS ({FRAMES}), tx AS (SELECT *, TRY_CAST(nullif(replace(total, ' USD', ''), '') AS DECIMAL(18,4)) AS amt,
 TRY_CAST(nullif(date, '') AS DATE) AS d, sku IN ('F-1','O-2','P-3','F-4','O-5') AS q,
 CASE WHEN CAST(substr(scenario_id, 2) AS INT) % 2 = 0 THEN sku IN ('F-1','P-3') ELSE sku IN ('O-2','O-5') END AS e FROM ({SALES}) t),
"""
# Every customer is a test, with an order or not; in MORE_TESTS one in ten has another without a sale.
TESTS = f"SELECT 'S' || {s('c_nationkey')} AS scenario_id, {s('c_custkey')} AS test_id FROM {{customer}}"
MORE_TESTS = f"""{TESTS}
 UNION ALL SELECT 'S' || {s('c_nationkey')}, 'none-' || {s('c_custkey')} FROM {{customer}} WHERE c_custkey % 10 = 0"""


def _results(tests):
    return f"""{_BASE} tests AS ({tests}), sums AS (SELECT scenario_id, test_id, coalesce(CAST(sum(amt) FILTER (q AND d BETWEEN DATE '1999-01-01' AND DATE '1999-12-31') AS DOUBLE), 0.0) AS cur,
 coalesce(CAST(sum(amt) FILTER (q AND d BETWEEN DATE '1998-01-01' AND DATE '1998-12-31') AS DOUBLE), 0.0) AS base,
 coalesce(CAST(sum(amt) FILTER (e AND d BETWEEN DATE '1999-01-01' AND DATE '1999-12-31') AS DOUBLE), 0.0) AS cur_e,
 coalesce(CAST(sum(amt) FILTER (e) AS DOUBLE), 0.0) AS all_e, count(*) FILTER (q) AS nq, count(*) FILTER (e) AS ne FROM tests LEFT JOIN tx USING (scenario_id, test_id) GROUP BY scenario_id, test_id),
r AS (SELECT sums.*, test_type, CASE WHEN base > 0 THEN cur / base * 100 ELSE 0.0 END AS pct,
 CASE WHEN target_percent IN ('', '0') THEN 95.0 ELSE CAST(replace(target_percent, '%', '') AS DOUBLE) END AS target,
 CASE WHEN earning_percent = 'x' THEN 0.0 ELSE 1.25 END AS rate FROM sums JOIN sc USING (scenario_id)),
results AS (SELECT scenario_id, test_id, test_type, test_type <> 'yoy' OR pct >= target AS qualified,
 CASE WHEN test_type <> 'yoy' THEN all_e * rate / 100 WHEN pct >= target THEN cur_e * 2.5 / 100 ELSE 0.0 END AS earnings,
 CASE WHEN test_type = 'yoy' THEN cur END AS current_total, CASE WHEN test_type = 'yoy' THEN base END AS base_total,
 CASE WHEN test_type = 'yoy' THEN pct END AS achieved_percent, CASE WHEN test_type = 'earningsOnly' THEN 0 ELSE nq END AS qualifying_transactions,
 ne AS earning_transactions FROM r)"""


RESULTS = _results(TESTS)


def _inputs(spark, sf, tests=TESTS):
    return tuple(in_spark(spark, sf, t) for t in (SCENARIOS, FRAMES, SALES, tests))


def _qualified(kind):
    def query(spark, sf):
        # All kinds are computed together; each query reports one of them.
        return qu.qualify(*_inputs(spark, sf)).filter(F.col("test_type") == kind)
    return query


for _name, _kind in (("qualify_yoy", "yoy"), ("qualify_minimum", "minQual"), ("qualify_earnings_only", "earningsOnly")):
    ALL[_name] = (_qualified(_kind), in_duckdb(f"{RESULTS} SELECT * FROM results WHERE test_type = '{_kind}'"))
ALL["qualify_without_sales"] = (
    lambda spark, sf: qu.qualify(*_inputs(spark, sf, MORE_TESTS)),
    in_duckdb(f"{_results(MORE_TESTS)} SELECT * FROM results"),
)
ALL["qualification_tally"] = (
    lambda spark, sf: qu.qualification_tally(qu.qualify(*_inputs(spark, sf))),
    in_duckdb(f"""{RESULTS} SELECT scenario_id, count(*) FILTER (qualified) AS qualified,
 count(*) FILTER (NOT qualified) AS not_qualified FROM results GROUP BY scenario_id"""),
)
ALL["frame_totals"] = (
    lambda spark, sf: qu.frame_totals(*_inputs(spark, sf)),
    in_duckdb(f"""{_BASE} tests AS ({TESTS}) SELECT t.scenario_id, t.test_id, ordinal, label, is_current,
 coalesce(CAST(sum(amt) FILTER (q AND d BETWEEN CAST(start_date AS DATE) AND CAST(end_date AS DATE)) AS DOUBLE), 0.0) AS total
 FROM tests t JOIN fr ON t.scenario_id = fr.scenario_id LEFT JOIN tx ON tx.scenario_id = t.scenario_id AND tx.test_id = t.test_id
 GROUP BY t.scenario_id, t.test_id, ordinal, label, is_current"""),
)

# -- scenario text ------------------------------------------------------------------


def scenario_defaults(spark, sf):
    rows = in_spark(spark, sf, SALES).withColumns(
        {
            "transaction_type": F.lit(None).cast("string"),
            "uom": F.when(F.col("row_idx") % 2 == 0, F.lit("")).otherwise("gal"),
            "txn_id": F.when(F.col("row_idx") % 3 == 0, F.col("row_idx").cast("string")),
            "seller": F.lit(None).cast("string"),
            "offer_key": F.lit("offer"),
        }
    )
    return ex.fill_defaults(rows)


ALL["scenario_defaults"] = (
    scenario_defaults,
    in_duckdb(f"""SELECT scenario_id, test_id, row_idx, date, sku, total, 'retailer_purchases_from_distribution' AS transaction_type,
 CASE WHEN row_idx % 2 = 0 THEN 'oz' ELSE 'gal' END AS uom, CASE WHEN row_idx % 3 = 0 THEN CAST(row_idx AS VARCHAR) ELSE
 CASE WHEN rn < 10 THEN '0' ELSE '' END || CAST(rn AS VARCHAR) END AS txn_id, '' AS seller, 'offer' AS offer_key
 FROM (SELECT *, row_number() OVER (PARTITION BY scenario_id, test_id ORDER BY row_idx) AS rn FROM ({SALES}) t) x"""),
)


def scenario_text(spark, sf):
    results = qu.qualify(*_inputs(spark, sf)).select(
        "scenario_id", "test_id", F.round("earnings", 2).alias("earnings")
    )
    rows = settled(scenario_defaults(spark, sf)).withColumn("quantity", F.lit(""))
    return ex.scenario_text(rows.join(results, ["scenario_id", "test_id"]), "participant_000")


_NL = "chr(10)"


def _line(pad: int, text: str) -> str:
    return f"'{' ' * pad}' || {text}"


_TXN = f" || {_NL} || ".join([
    _line(12, "'{'"),
    _line(16, "'\"transaction_id\": \"' || txn_id || '\"'"),
    _line(16, "'\"transaction_type\": \"retailer_purchases_from_distribution\"'"),
    _line(16, "'\"sku_key\": \"' || sku || '\"'"),
    _line(16, "'\"uom_key\": \"' || uom || '\"'"),
    _line(16, "'\"quantity\": 0'"),
    _line(16, "'\"amount\": ' || CASE WHEN total = '' THEN '0' ELSE total END"),
    _line(16, "'\"invoice_date\": \"' || date || '\"'"),
    _line(16, "'\"seller\": {'"),
    _line(20, "'\"key\": \"\"'"),
    _line(16, "'}'"),
    _line(16, "'\"expected_incentives\": ['"),
    _line(20, "'{'"),
    _line(24, "'\"offer\": ' || regexp_replace(regexp_replace(CAST(CAST(earnings AS DECIMAL(18,2)) AS VARCHAR), '0+$', ''), '[.]$', '')"),
    _line(20, "'}'"),
    _line(16, "']'"),
    _line(12, "'}'"),
])
ALL["scenario_text"] = (
    scenario_text,
    in_duckdb(f"""{RESULTS}, filled AS ({ALL["scenario_defaults"][1]})
SELECT scenario_id, test_id, CAST(0 AS BIGINT) AS part_no, '    {{' || {_NL} || '        "request_id": "' || test_id || '"' || {_NL}
 || '        "participant_key": "participant_000"' || {_NL} || '        "transactions": [' || {_NL}
 || string_agg({_TXN}, {_NL} ORDER BY row_idx) || {_NL} || '        ]' || {_NL} || '    }}' AS block
FROM filled JOIN (SELECT scenario_id, test_id, round(CAST(CAST(earnings AS VARCHAR) AS DECIMAL(38,12)), 2) AS earnings FROM results) r USING (scenario_id, test_id) GROUP BY scenario_id, test_id""")
)
