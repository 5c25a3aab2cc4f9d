import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleswright.functions import cleaning as cl
from saleswright.functions import text as tx
from saleswright.functions.display import display_number, long_date, padded, short_number


def apply(spark, function, texts):
    data = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "i int, t string")
    return [r[0] for r in df.select(function(F.col("t")).alias("v"), "i").orderBy("i").collect()]


def test_amount(spark):
    cases = {
        None: None, "": None, "  ": None, "12.345": Decimal("12.35"), "1,234.5": Decimal("1234.50"),
        "*5.00": Decimal("5.00"), "#VALUE!": None, "#DIV/0!": None, "$5": None,
        "1e2": Decimal("100.00"), "99999999999": None, " 7 ": Decimal("7.00"), "1d": None, "(5)": None,
    }
    assert apply(spark, cl.amount, list(cases)) == list(cases.values())
    assert apply(spark, cl.bad_amount, ["$5", "", "#VALUE!", None, "5", "x"]) == [
        True, False, False, False, False, True]


def test_quantity(spark):
    cases = {
        None: None, "": None, "12": 12, "12.7": 13, "12.5": 13, "-12.5": -13, "12 EA": 12, "1,200ft": 1200,
        "3pc": 3, "*4": 4, "x": None, "1d": None, "1e2": 100, "99999999999": None,
    }
    assert apply(spark, cl.quantity, list(cases)) == list(cases.values())
    assert apply(spark, cl.bad_quantity, ["x", "", None, "3pc"]) == [True, False, False, False]


def test_sales_date(spark):
    day = dt.date
    cases = {
        None: None, "": None, "45000": day(2023, 3, 15), "45000.5": day(2023, 3, 16), "2024": day(1905, 7, 16),
        "3/5/24": day(2024, 3, 5), "3/5/2024": day(2024, 3, 5), "03/05/24": day(2024, 3, 5),
        "3/5/68": day(2068, 3, 5), "3/5/69": day(1969, 3, 5), "3/5/99": day(1999, 3, 5),
        "2024-01-05": day(2024, 1, 5), "2024/1/5": day(2024, 1, 5), "2024-01-05 10:00:00": day(2024, 1, 5),
        "13/45/2024": None, "n/a": None, "12-05-24": None, "3/5/204": None, "2/30/24": None, "a/b/cd": None,
        "1/2/3/24": None, "//24": None,
    }
    assert apply(spark, cl.sales_date, list(cases)) == list(cases.values())


def test_number(spark):
    cases = {"$1,234.50": 1234.5, "(5.00)": -5.0, "($5)": -5.0, "": None, "abc": None, "1d": None,
             None: None, " 7 ": 7.0, "(x)": None, "()": None}
    assert apply(spark, cl.number, list(cases)) == list(cases.values())


def test_leading_and_prefix_number(spark):
    assert apply(spark, cl.leading_number, ["$12abc", "", "abc", "-3", "1,234 each", ".5x", None]) == [
        12.0, 0.0, 0.0, -3.0, 1234.0, 0.5, 0.0]
    assert apply(spark, cl.prefix_number, ["$12", "1,234", "12abc"]) == [0.0, 1.0, 12.0]


def test_iso_text(spark):
    cases = {"3/5/2024": "2024-03-05", "2024-03-05": "2024-03-05", "3-5-2024": "2024-03-05", "March": "March",
             "": "", None: "", " 12/11/24 ": "24-12-11", "1/2": "1/2"}
    assert apply(spark, cl.iso_text, list(cases)) == list(cases.values())


def test_strict_us_date(spark):
    assert apply(spark, cl.strict_us_date, ["3/5/24", None]) == [dt.date(2024, 3, 5), None]
    for bad in ("2024-03-05", "13/45/24"):
        with pytest.raises(Exception, match="not a m/d/yy date"):
            apply(spark, cl.strict_us_date, [bad])


def test_small_functions(spark):
    assert apply(spark, cl.is_no_value, [None, " ", "null", "N/A", "na", "x"]) == [True] * 5 + [False]
    assert apply(spark, cl.is_junk, ["---", "= =", "***", "", None, "a-b"]) == [True, True, True, False, False, False]
    assert apply(spark, tx.normal_header, ["  Item \t  No  "]) == ["item no"]
    assert apply(spark, tx.is_quoted, ['"Ship Date"', '""', '"a"', "B", None]) == [True, False, True, False, False]
    assert apply(spark, tx.is_letters, ["B", "ab", "UPC", "", None]) == [True, True, False, False, False]
    assert apply(spark, tx.dollar_literal, ["$$ Acme $$", "$$$$", "Acme", None]) == ["Acme", None, None, None]
    assert apply(spark, tx.file_stem, ["a_b-c.tar.csv", "plain"]) == ["a b c.tar", "plain"]
    assert apply(spark, tx.comma_list, [" a, ,b", "", None]) == [["a", "b"], [], []]
    assert apply(spark, tx.strip_quotes, [" \"'x'\" "]) == ["x"]
    assert apply(spark, tx.unescape_entities, ["A &amp; B &#39;x&#39; &eacute;", None]) == ["A & B 'x' é", None]


def test_addresses(spark):
    letters = ["A", "z", "AA", "AZ", "ZZ", "AAA", "XFD", "A1", ""]
    assert apply(spark, tx.letters_to_number, letters) == [1, 26, 27, 52, 702, 703, 16384, None, None]
    numbers = spark.createDataFrame([(n,) for n in (1, 26, 27, 52, 702, 703, 16384)], "n int")
    assert [r[0] for r in numbers.select(tx.number_to_letters(F.col("n"))).collect()] == [
        "A", "Z", "AA", "AZ", "ZZ", "AAA", "XFD"]
    ranges = apply(spark, tx.parse_range, ["A5:K900", "a1:b2 ", "A:K", None])
    assert [tuple(r) if r else None for r in ranges] == [(5, 900, 1, 11), (1, 2, 1, 2), None, None]


def test_prices_and_display(spark):
    df = spark.createDataFrame([(None, 10.0, 4.0), (1.0, 10.0, 4.0), (None, 10.0, 0.0), (None, None, 4.0)],
                               "u double, e double, q double")
    assert [r[0] for r in df.select(cl.derived_unit_price(F.col("u"), F.col("e"), F.col("q"))).collect()] == [
        2.5, 1.0, None, None]
    one = spark.range(1)
    shown = one.select(
        display_number(F.lit(1234.5), F.lit("#,##0")), display_number(F.lit(-3.25), F.lit("$#,##0.00")),
        display_number(F.lit(0.5), F.lit("#,##0.000")), long_date(F.lit(dt.date(2026, 2, 13))),
        short_number(F.lit(5.0)), short_number(F.lit(12345678.5)), padded(F.lit(7), 2), padded(F.lit(1234567), 6),
        cl.line_total(F.lit("3"), F.lit("2.005x")), cl.percent(F.lit(1.0), F.lit(0.0)),
    ).first()
    assert tuple(shown) == ("1,235", "-$3.25", "0.500", "February 13, 2026", "5", "12345678.5", "07", "1234567", 6.02, 0.0)
