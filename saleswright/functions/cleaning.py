"""Typed values from dirty cell text, as Column -> Column functions.

Everything here is built from JVM expressions. A value that cannot be read is
NULL; ``bad_*`` functions tell such a value from a blank one.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain number as text; characters and words dropped from amounts
# and quantities; day zero of spreadsheet date serials; texts that mean "no value";
# cells that hold only rule characters.
NUMBER = r"^\s*([+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"
AMOUNT_NOISE = r"([*]|,|#VALUE!|#DIV/0!)"
QUANTITY_NOISE = r"(?i)([*]|,|ea|ft|pc)"
SERIAL_DAY_ZERO = "1899-12-30"
NO_VALUE = ("", "NULL", "N/A", "NA")
JUNK = r"^[\-=\*\s]+$"
WHITESPACE = " \t\n\r\x0b\x0c"


def strip(text: Column) -> Column:
    """Trim all whitespace, not only spaces."""
    return F.btrim(text, F.lit(WHITESPACE))


def filled(text: Column) -> Column:
    """NULL instead of text that is empty after trimming spaces."""
    return F.when(F.trim(text) != "", text)


def clean_text(text: Column) -> Column:
    """Trimmed text; NULL becomes the empty text."""
    return F.coalesce(strip(text), F.lit(""))


def blank(text: Column) -> Column:
    return clean_text(text) == ""


def _number_text(text: Column) -> Column:
    """The number the text consists of, else NULL.

    A cast never sees other text, because a failed parse is slow.
    """
    return F.nullif(F.regexp_extract(text, NUMBER, 1), F.lit(""))


def _whole(text: Column) -> Column:
    return F.round(_number_text(text).try_cast("double")).try_cast("int")


def _money(text: Column) -> Column:
    return _number_text(text).try_cast("decimal(10,2)")


def amount(text: Column) -> Column:
    """Text to decimal(10,2); stars, commas and two spreadsheet errors are dropped.

    A text that is a number already has nothing to drop.
    """
    return _money(F.regexp_replace(text, AMOUNT_NOISE, ""))


def unread(text: Column, value: Column) -> Column:
    """True when text that is not blank gave no value."""
    return F.coalesce((F.trim(text) != "") & value.isNull(), F.lit(False))


def bad_amount(text: Column, value: Column | None = None) -> Column:
    """True for text that is neither blank, nor noise only, nor an amount.

    ``value`` is the amount when it is already at hand.
    """
    left = F.regexp_replace(text, AMOUNT_NOISE, "")
    return unread(text, amount(text) if value is None else value) & (left != "")


def quantity(text: Column) -> Column:
    """Text to int, rounded; stars, commas and the units ea, ft, pc are dropped."""
    return _whole(F.regexp_replace(text, QUANTITY_NOISE, ""))


def bad_quantity(text: Column, value: Column | None = None) -> Column:
    return unread(text, quantity(text) if value is None else value)


def _year_first(parts: Column) -> Column:
    """Month, day and year texts to year-first text; years 69 to 99 are 1969 to 1999."""
    month, day, year = (F.get(parts, F.lit(i)) for i in range(3))
    century = F.when(year >= "69", F.lit("19")).otherwise(F.lit("20"))
    full = F.when(F.length(year) == 2, F.concat(century, year)).when(F.length(year) == 4, year)
    shaped = (F.size(parts) == 3) & (F.length(month) <= 2) & (F.length(day) <= 2)
    return F.when(shaped, F.concat_ws("-", full, month, day))


def sales_date(text: Column) -> Column:
    """Text to date: spreadsheet serial, then m/d/yy, then m/d/yyyy, then year first."""
    trimmed = F.trim(text)
    serial = F.date_add(F.lit(SERIAL_DAY_ZERO).cast("date"), _whole(text))
    # A one-element array names the split text, which is used several times.
    turned = F.get(F.transform(F.array(F.split(trimmed, "/")), _year_first), F.lit(0))
    # A year alone is a serial, so text must start with all three parts.
    dated = F.regexp_extract(
        F.coalesce(turned, F.translate(trimmed, "/", "-")),
        r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[ T].*)?$",
        0,
    )
    return F.coalesce(serial, F.nullif(dated, F.lit("")).try_cast("date"))


def bad_date(text: Column) -> Column:
    return unread(text, sales_date(text))


def number(text: Column) -> Column:
    """Text to double: ``$`` and ``,`` dropped, ``(x)`` is ``-x``, else NULL."""
    bare = F.regexp_replace(strip(text), r"[$,]", "")
    signed = F.regexp_replace(bare, r"(?s)^[(](.*)[)]$", "-$1")
    return _number_text(signed).try_cast("double")


def plain_number(text: Column) -> Column:
    """Text to double without any clean-up, else NULL."""
    return _number_text(text).try_cast("double")


def prefix_number(text: Column) -> Column:
    """The number the text starts with, else 0."""
    prefix = F.regexp_extract(
        text, r"^\s*([+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?)", 1
    )
    return F.coalesce(F.nullif(prefix, F.lit("")).try_cast("double"), F.lit(0.0))


def leading_number(text: Column) -> Column:
    """The number the text starts with after ``$`` and ``,`` are dropped, else 0."""
    return prefix_number(F.regexp_replace(text, r"[$,]", ""))


def iso_text(text: Column) -> Column:
    """``m/d/y`` or ``m-d-y`` to ``y-mm-dd``; year-first and other text stays."""
    trimmed = clean_text(text)
    parts = F.split(trimmed, r"[/\-]")

    def two(part: Column) -> Column:
        return F.when(F.length(part) < 2, F.lpad(part, 2, "0")).otherwise(part)

    month, day, year = F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)
    turned = F.concat_ws("-", year, two(month), two(day))
    return F.when((F.size(parts) == 3) & (F.length(month) != 4), turned).otherwise(trimmed)


def strict_us_date(text: Column) -> Column:
    """``m/d/yy`` to date; any other text stops the job, NULL stays NULL."""
    shaped = F.regexp_extract(text, r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$", 0)
    refused = F.raise_error(F.concat(F.lit("not a m/d/yy date: "), text)).cast("date")
    return F.coalesce(sales_date(shaped), F.when(text.isNotNull(), refused))


def is_no_value(text: Column) -> Column:
    """True for NULL, blank, NULL, N/A and NA."""
    return F.coalesce(F.upper(strip(text)).isin(*NO_VALUE), F.lit(True))


def is_junk(text: Column) -> Column:
    """True when a value is made of dashes, equals signs, stars and blanks only."""
    return F.coalesce(text.rlike(JUNK), F.lit(False))


def derived_unit_price(unit: Column, extended: Column, qty: Column) -> Column:
    """The given price, else extended / quantity to 4 places when both are not zero."""
    possible = unit.isNull() & (extended != 0) & (qty != 0)
    return F.when(possible, F.round(F.try_divide(extended, qty), 4)).otherwise(unit)


def line_total(qty: Column, price: Column) -> Column:
    """Quantity times price to 2 places; text without a number counts as 0."""
    return F.round(prefix_number(qty) * prefix_number(price), 2)


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, and 0 when whole is not above 0."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))
