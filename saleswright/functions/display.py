"""Number and date text for reports and exports."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_number(value: Column, pattern: Column) -> Column:
    """Text by display pattern: ``#,##0``, ``#,##0.000`` or ``$#,##0.00``."""
    def fixed(places: int) -> Column:
        # format_number alone rounds halves to even.
        return F.format_number(F.round(value, places), places)

    cents = F.round(value, 2)
    money = F.when(
        cents < 0, F.concat(F.lit("-$"), F.format_number(-cents, 2))
    ).otherwise(F.concat(F.lit("$"), fixed(2)))
    return (
        F.when(pattern == "#,##0", fixed(0))
        .when(pattern == "#,##0.000", fixed(3))
        .when(pattern == "$#,##0.00", money)
        .otherwise(value.cast("string"))
    )


def long_date(day: Column) -> Column:
    """February 13, 2026."""
    return F.date_format(day, "MMMM dd, yyyy")


def short_number(value: Column) -> Column:
    """A number with no needless zeros: 5, 5.5, -3."""
    plain = value.try_cast("decimal(38,17)").cast("string")
    # Numbers of more digits than a decimal holds keep their own text.
    text = F.coalesce(plain, value.cast("string"))
    return F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def padded(number: Column, width: int) -> Column:
    """An ordinal with leading zeros; longer ordinals keep all digits."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
