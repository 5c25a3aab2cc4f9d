"""Header, cell-address, file-name and list text functions."""

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.functions.cleaning import clean_text, strip


def normal_header(text: Column) -> Column:
    """Lower case with single spaces."""
    return F.lower(strip(F.regexp_replace(text, r"(?U)\s+", " ")))


def header_signature(cells: Column) -> Column:
    """Sorted lower-case headers joined by a bar; blank headers do not count."""
    lowered = F.transform(cells, lambda c: F.lower(clean_text(c)))
    return F.array_join(F.array_sort(F.filter(lowered, lambda c: c != "")), "|")


def strip_quotes(text: Column) -> Column:
    """Trim, then drop double quotes, then single quotes, at both ends."""
    return F.btrim(F.btrim(strip(text), F.lit('"')), F.lit("'"))


def is_quoted(text: Column) -> Column:
    """True for a column name in double quotes."""
    value = strip(text)
    return F.coalesce(
        value.startswith('"') & value.endswith('"') & (F.length(value) >= 3), F.lit(False)
    )


def is_letters(text: Column, longest: int = 2) -> Column:
    """True for text that is a column address such as B or AB."""
    return F.coalesce(F.upper(strip(text)).rlike(rf"^[A-Z]{{1,{longest}}}$"), F.lit(False))


def dollar_literal(text: Column) -> Column:
    """The text between two ``$$`` marks, trimmed, else NULL."""
    inner = strip(F.regexp_extract(strip(text), r"(?s)^\$\$(.+?)\$\$$", 1))
    return F.when(inner != "", inner)


def letters_to_number(text: Column) -> Column:
    """Column address to its 1-based number; NULL for other text."""
    letters = F.upper(strip(text))
    total = F.aggregate(
        F.split(letters, ""),
        F.lit(0),
        lambda acc, c: F.when(c == "", acc).otherwise(acc * 26 + F.ascii(c) - 64),
    )
    return F.when(letters.rlike(r"^[A-Z]{1,3}$"), total)


def number_to_letters(number: Column) -> Column:
    """1-based column number to its address, up to three letters."""
    def letter(n: Column) -> Column:
        return F.char(F.lit(65) + n.cast("int"))

    n = number.cast("int") - 1
    two = n - 26
    three = n - 702
    return (
        F.when(n < 0, F.lit(""))
        .when(n < 26, letter(n))
        .when(n < 702, F.concat(letter(F.floor(two / 26)), letter(two % 26)))
        .otherwise(
            F.concat(
                letter(F.floor(three / 676)),
                letter(F.floor(three / 26) % 26),
                letter(three % 26),
            )
        )
    )


def parse_range(text: Column) -> Column:
    """``A1:Z100`` to a struct of 1-based bounds; NULL when the text does not start so."""
    upper = F.upper(strip(text))
    pattern = r"^([A-Z]+)([0-9]+):([A-Z]+)([0-9]+)"

    def piece(i: int) -> Column:
        return F.regexp_extract(upper, pattern, i)

    return F.when(
        upper.rlike(pattern),
        F.struct(
            piece(2).try_cast("long").alias("start_row"),
            piece(4).try_cast("long").alias("end_row"),
            letters_to_number(piece(1)).alias("start_col"),
            letters_to_number(piece(3)).alias("end_col"),
        ),
    )


def file_stem(name: Column) -> Column:
    """The file name without its extension, underscores and dashes as spaces."""
    return F.translate(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), "_-", "  ")


def comma_list(text: Column) -> Column:
    """Comma text to an array of trimmed items, empty items dropped."""
    items = F.transform(F.split(F.coalesce(text, F.lit("")), ","), strip)
    return F.filter(items, lambda c: c != "")


def quote_or_null(header: Column) -> Column:
    """A found header in double quotes, else the text NULL."""
    found = F.coalesce(header, F.lit("")) != ""
    return F.when(found, F.concat(F.lit('"'), header, F.lit('"'))).otherwise(F.lit("NULL"))


@F.pandas_udf(T.StringType())
def unescape_entities(text: pd.Series) -> pd.Series:
    """Decode HTML entities. Meant for mapping rows, which are few."""
    return text.map(html.unescape, na_action="ignore")


def first_containing(text: Column, terms: list[str]) -> Column:
    """The first term, in list order, found in the text without regard to case."""
    lowered = F.lower(text)
    return F.coalesce(*[F.when(lowered.contains(t.lower()), F.lit(t)) for t in terms])


def stable_uuid(*parts: Column) -> Column:
    """A key in UUID form made from the parts.

    It is the same when a lost task runs again, which a random key is not. Parts are
    told apart whatever characters they hold, and NULL from empty text.
    """
    digest = F.md5(F.to_json(F.struct(*(p.alias(f"p{i}") for i, p in enumerate(parts)))))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lit("a"), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
