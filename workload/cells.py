"""Cleaning functions on dirty text, over all line items or orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswright.functions import cleaning as cl
from saleswright.functions import text as tx
from saleswright.functions.display import display_number, long_date, padded, short_number
from workload import views as v
from workload.views import in_duckdb, in_spark, money, s

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_KEYS = ", ".join(KEYS)
k = "(l_orderkey + l_linenumber + l_partkey)"
ext = money("l_extendedprice")
qty = s("CAST(l_quantity AS BIGINT)")

AMOUNTS = f"""SELECT {LINE_KEYS}, CASE
 WHEN {k} % 9 = 0 THEN '*' || {ext} WHEN {k} % 9 = 1 THEN '' WHEN {k} % 9 = 2 THEN '#VALUE!'
 WHEN {k} % 9 = 3 THEN {s('1 + l_partkey % 99')} || ',' || lpad({s('l_suppkey % 1000')}, 3, '0') || '.5'
 WHEN {k} % 9 = 4 THEN '$' || {ext} WHEN {k} % 9 = 5 THEN {ext} || '5' WHEN {k} % 9 = 6 THEN {qty} || 'e2'
 WHEN {k} % 9 = 7 THEN ' ' || {ext} || ' ' WHEN l_linenumber = 7 THEN '99999999999' ELSE {ext} END AS raw
FROM {{lineitem}}"""
QUANTITIES = f"""SELECT {LINE_KEYS}, CASE
 WHEN {k} % 9 = 0 THEN {qty} || ' EA' WHEN {k} % 9 = 1 THEN '' WHEN {k} % 9 = 2 THEN {qty} || '.7'
 WHEN {k} % 9 = 3 THEN '1,' || lpad({qty}, 3, '0') || 'ft' WHEN {k} % 9 = 4 THEN '*' || {qty}
 WHEN {k} % 9 = 5 THEN {qty} || 'pc' WHEN {k} % 9 = 6 THEN 'x' || {qty} WHEN {k} % 9 = 7 THEN '-' || {qty}
 ELSE {qty} END AS raw FROM {{lineitem}}"""
DATES = f"""SELECT {LINE_KEYS}, CASE
 WHEN {k} % 9 = 0 THEN {s('SERIAL(d)')} WHEN {k} % 9 = 1 THEN '' WHEN {k} % 9 = 2 THEN {v.US_DATE} || {v.SHORT_YEAR}
 WHEN {k} % 9 = 3 THEN {v.US_DATE} || {s('year(d)')} WHEN {k} % 9 = 4 THEN {s('d')}
 WHEN {k} % 9 = 5 THEN 'n/a' WHEN {k} % 9 = 6 THEN {s('SERIAL(d)')} || '.5'
 WHEN {k} % 9 = 7 THEN '13/45/' || {s('year(d)')} ELSE ' ' || {s('d')} || ' ' END AS raw
FROM (SELECT *, CAST(l_shipdate AS DATE) AS d FROM {{lineitem}}) l"""
NUMBERS = f"""SELECT {LINE_KEYS}, CASE
 WHEN {k} % 8 = 0 THEN '$' || {ext} WHEN {k} % 8 = 1 THEN '(' || {ext} || ')' WHEN {k} % 8 = 2 THEN '($' || {qty} || ')'
 WHEN {k} % 8 = 3 THEN '' WHEN {k} % 8 = 4 THEN 'abc' WHEN {k} % 8 = 5 THEN {qty} || 'd'
 WHEN {k} % 8 = 6 THEN '1,' || lpad({qty}, 3, '0') || '.50' ELSE {ext} END AS raw FROM {{lineitem}}"""
LENIENT = f"""SELECT {LINE_KEYS}, CASE
 WHEN {k} % 7 = 0 THEN '$' || {qty} || 'abc' WHEN {k} % 7 = 1 THEN '' WHEN {k} % 7 = 2 THEN 'abc'
 WHEN {k} % 7 = 3 THEN '-' || {ext} WHEN {k} % 7 = 4 THEN '1,' || lpad({qty}, 3, '0') || ' each'
 WHEN {k} % 7 = 5 THEN '.' || {qty} ELSE {ext} END AS raw FROM {{lineitem}}"""
ORDER_DATES = f"""SELECT o_orderkey, CASE
 WHEN o_orderkey % 6 = 0 THEN {s('month(d)')} || '-' || {s('day(d)')} || '-' || {s('year(d)')}
 WHEN o_orderkey % 6 = 1 THEN {s('d')} WHEN o_orderkey % 6 = 2 THEN 'March' WHEN o_orderkey % 6 = 3 THEN ''
 WHEN o_orderkey % 6 = 4 THEN {v.US_DATE} || {s('year(d)')} ELSE {v.US_DATE} || {v.SHORT_YEAR} END AS raw
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM {{orders}}) o"""


def cleaned(view, keys, columns):
    return lambda spark, sf: v.raw_table(spark, sf, view).select(
        *keys, *[c.alias(n) for n, c in columns(F.col("raw")).items()]
    )


def oracle(view, keys, columns):
    picked = ", ".join([*keys, *[f"{e} AS {n}" for n, e in columns.items()]])
    return in_duckdb(f"SELECT {picked} FROM ({view}) t")


ALL = {
    "clean_amount": (
        cleaned(AMOUNTS, KEYS, lambda raw: {"amount": cl.amount(raw).cast("double"), "bad": cl.bad_amount(raw)}),
        oracle(AMOUNTS, KEYS, {
            "amount": f"CAST({v.d_amount('raw')} AS DOUBLE)",
            "bad": f"trim(raw) <> '' AND raw <> '#VALUE!' AND {v.d_amount('raw')} IS NULL",
        }),
    ),
    "clean_quantity": (
        cleaned(QUANTITIES, KEYS, lambda raw: {"quantity": cl.quantity(raw), "bad": cl.bad_quantity(raw)}),
        oracle(QUANTITIES, KEYS, {
            "quantity": v.d_quantity("raw"),
            "bad": f"trim(raw) <> '' AND {v.d_quantity('raw')} IS NULL",
        }),
    ),
    "clean_date": (
        cleaned(DATES, KEYS, lambda raw: {"sold_on": cl.sales_date(raw).cast("string"), "bad": cl.bad_date(raw)}),
        oracle(DATES, KEYS, {
            "sold_on": f"CAST({v.d_date('raw')} AS VARCHAR)",
            "bad": f"trim(raw) <> '' AND ({v.d_date('raw')}) IS NULL",
        }),
    ),
    "clean_number": (
        cleaned(NUMBERS, KEYS, lambda raw: {"number": cl.number(raw)}),
        oracle(NUMBERS, KEYS, {"number": v.d_number("raw")}),
    ),
    "lenient_number": (
        cleaned(LENIENT, KEYS, lambda raw: {"number": cl.leading_number(raw)}),
        oracle(LENIENT, KEYS, {
            "number": "coalesce(TRY_CAST(nullif(regexp_extract(regexp_replace(raw, '[$,]', '', 'g'), "
            "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'), '') AS DOUBLE), 0.0)",
        }),
    ),
    "iso_date": (
        cleaned(ORDER_DATES, ["o_orderkey"], lambda raw: {"iso": cl.iso_text(raw)}),
        oracle(ORDER_DATES, ["o_orderkey"], {
            "iso": "CASE WHEN len(regexp_split_to_array(raw, '[/-]')) = 3 AND length(regexp_split_to_array(raw, '[/-]')[1]) <> 4 "
            "THEN regexp_split_to_array(raw, '[/-]')[3] || '-' || lpad(regexp_split_to_array(raw, '[/-]')[1], 2, '0') || '-' "
            "|| lpad(regexp_split_to_array(raw, '[/-]')[2], 2, '0') ELSE raw END",
        }),
    ),
}

STRICT = f"""SELECT o_orderkey, {v.US_DATE} || {v.SHORT_YEAR} AS raw
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM {{orders}}) o"""
ALL["strict_us_date"] = (
    cleaned(STRICT, ["o_orderkey"], lambda raw: {"iso": cl.strict_us_date(raw).cast("string")}),
    in_duckdb("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS iso FROM {orders}"),
)

# Text, header and address functions on part and supplier names.
TEXTS = f"""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '  ' || p_name || ' ' WHEN p_partkey % 5 = 1 THEN 'n/a'
 WHEN p_partkey % 5 = 2 THEN upper(p_name) || '   ' || p_brand WHEN p_partkey % 5 = 3 THEN '--- ==' ELSE '$$' || p_name || '$$' END AS raw,
 p_name || '_' || {s('p_size')} || '-list.csv' AS file_name,
 p_type || ' , ' || p_brand || ',,' || p_name AS listed
FROM {{part}}"""
ALL["clean_texts"] = (
    cleaned(TEXTS, ["p_partkey"], lambda raw: {
        "cleaned": cl.clean_text(raw),
        "header": tx.normal_header(raw),
        "no_value": cl.is_no_value(raw),
        "junk": cl.is_junk(raw),
        "literal": tx.dollar_literal(raw),
        "quoted": tx.quote_or_null(tx.dollar_literal(raw)),
        "stem": tx.file_stem(F.col("file_name")),
        "items": F.array_join(tx.comma_list(F.col("listed")), "|"),
    }),
    oracle(TEXTS, ["p_partkey"], {
        "cleaned": "trim(raw)",
        "header": "lower(trim(regexp_replace(raw, '\\s+', ' ', 'g')))",
        "no_value": "upper(trim(raw)) IN ('', 'NULL', 'N/A', 'NA')",
        "junk": "regexp_full_match(raw, '[-=*\\s]+')",
        "literal": "CASE WHEN raw LIKE '$$%$$' THEN replace(raw, '$', '') END",
        "quoted": "CASE WHEN raw LIKE '$$%$$' THEN '\"' || replace(raw, '$', '') || '\"' ELSE 'NULL' END",
        "stem": "replace(replace(replace(file_name, '.csv', ''), '_', ' '), '-', ' ')",
        "items": "array_to_string(list_filter(list_transform(string_split(listed, ','), lambda x: trim(x)), lambda x: x <> ''), '|')",
    }),
)

ADDRESSES = f"""SELECT p_partkey, p_size, 'A' || {s('1 + p_size')} || ':' || chr(CAST(65 + p_partkey % 26 AS INT)) || chr(CAST(65 + p_size % 26 AS INT)) || {s('100 + p_partkey')} AS address
FROM {{part}}"""


def column_addresses(spark, sf):
    rows = in_spark(spark, sf, ADDRESSES)
    r = tx.parse_range(F.col("address"))
    return rows.select(
        "p_partkey",
        *[r[c].alias(c) for c in ("start_row", "end_row", "start_col", "end_col")],
        tx.number_to_letters(F.col("p_partkey") % 18000 + 1).alias("letters"),
        tx.letters_to_number(tx.number_to_letters(F.col("p_partkey") % 18000 + 1)).cast("long").alias("number"),
    )


_n = "(p_partkey % 18000)"
ALL["column_addresses"] = (
    column_addresses,
    in_duckdb(f"""SELECT p_partkey, CAST(1 + p_size AS BIGINT) AS start_row, 100 + p_partkey AS end_row, 1 AS start_col,
 CAST((1 + p_partkey % 26) * 26 + 1 + p_size % 26 AS INT) AS end_col,
 CASE WHEN {_n} < 26 THEN chr(CAST(65 + {_n} AS INT))
  WHEN {_n} < 702 THEN chr(CAST(65 + ({_n} - 26) // 26 AS INT)) || chr(CAST(65 + ({_n} - 26) % 26 AS INT))
  ELSE chr(CAST(65 + ({_n} - 702) // 676 AS INT)) || chr(CAST(65 + ({_n} - 702) // 26 % 26 AS INT))
   || chr(CAST(65 + ({_n} - 702) % 26 AS INT)) END AS letters,
 {_n} + 1 AS number FROM {{part}}"""),
)


def unit_prices(spark, sf):
    line = v.table(spark, sf, "lineitem")
    unit = F.when(F.col("l_linenumber") == 1, F.col("l_tax"))
    return line.select(
        *KEYS, cl.derived_unit_price(unit, F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        cl.line_total(F.col("l_quantity").cast("string"), F.col("l_discount").cast("string")).alias("line_total"),
        cl.percent(F.col("l_tax"), F.col("l_discount")).alias("pct"),
    )


ALL["unit_price_and_totals"] = (
    unit_prices,
    in_duckdb(f"""SELECT {LINE_KEYS}, CASE WHEN l_linenumber = 1 THEN l_tax WHEN l_extendedprice <> 0 AND l_quantity <> 0
 THEN CAST(round(CAST(CAST(l_extendedprice / l_quantity AS VARCHAR) AS DECIMAL(38,20)), 4) AS DOUBLE) END AS unit_price,
 CAST(round(CAST(l_quantity AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(18,4)), 2) AS DOUBLE) AS line_total,
 CASE WHEN l_discount > 0 THEN l_tax / l_discount * 100 ELSE 0.0 END AS pct FROM {{lineitem}}"""),
)


def displays(spark, sf):
    orders = v.table(spark, sf, "orders")
    price = F.col("o_totalprice").cast("decimal(18,3)")
    return orders.select(
        "o_orderkey",
        *[display_number(price, F.lit(p)).alias(n)
          for n, p in (("counted", "#,##0"), ("volume", "#,##0.000"), ("money", "$#,##0.00"))],
        long_date(F.col("o_orderdate")).alias("day"),
        short_number(price).alias("short"),
        padded(F.col("o_orderkey"), 6).alias("ordinal"),
    )


ALL["display_texts"] = (
    displays,
    in_duckdb("""SELECT o_orderkey, format('{{:,}}', CAST(round(CAST(o_totalprice AS DECIMAL(18,3)), 0) AS BIGINT)) AS counted,
 format('{{:,}}', CAST(floor(CAST(o_totalprice AS DECIMAL(18,3))) AS BIGINT)) || '.' || lpad(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,3)) * 1000 AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS volume,
 '$' || format('{{:,}}', CAST(floor(CAST(o_totalprice AS DECIMAL(18,2))) AS BIGINT)) || '.' || lpad(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) % 100 AS VARCHAR), 2, '0') AS money,
 strftime(o_orderdate, '%B %d, %Y') AS day,
 regexp_replace(regexp_replace(CAST(CAST(o_totalprice AS DECIMAL(18,3)) AS VARCHAR), '0+$', ''), '\\.$', '') AS short,
 CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 6 THEN lpad(CAST(o_orderkey AS VARCHAR), 6, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS ordinal
FROM {orders}""".replace("{{", "{").replace("}}", "}")),
)
