"""Expressions for text captured from pages and settlement reports."""

from __future__ import annotations

import datetime as dt
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portuguese month abbreviations.
MONTHS = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]

# A day label and what an amount keeps of its text.
DAY_LABEL = r"(?i)(\d{1,2})/([a-z]{3})"
NOT_OF_AN_AMOUNT = r"[^\d,]"

# Replacements that turn a report heading into a column name.
NAME_REPLACEMENTS = {"%": "percent", " ": "_", "/": "_", "-": "_", ".": "_"}


def column_name(heading: str) -> str:
    """Report heading without accents and without characters a table name rejects."""
    plain = unicodedata.normalize("NFKD", heading).encode("ascii", "ignore").decode("ascii")
    return plain.translate(str.maketrans(NAME_REPLACEMENTS))


def decimal_point(text: Column) -> Column:
    """``1.234,56`` becomes ``1234.56``: points dropped, comma turned into a point."""
    return F.translate(text, ",.", ".")


def parse_day_label(label: Column, as_of: dt.date) -> Column:
    """Date of a ``dd/mmm`` label; the year is the one that lies around ``as_of``.

    A label without a known day and month gives NULL.
    """
    pattern = DAY_LABEL
    day = F.regexp_extract(label, pattern, 1)
    name = F.lower(F.regexp_extract(label, pattern, 2))
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name).cast("int")
    year = F.lit(as_of.year)
    if as_of.month == 12:
        year = F.when(number == 1, as_of.year + 1).otherwise(year)
    if as_of.month == 1:
        year = F.when(number == 12, as_of.year - 1).otherwise(year)
    iso = F.format_string("%04d-%02d-%02d", year, number, day.try_cast("int"))
    return F.when(number > 0, F.try_to_date(iso))


def parse_money(text: Column, rounding: str = "truncate") -> Column:
    """Integer cents of a text such as ``R$ 1.234,56``.

    Everything but digits and commas goes, the sign included; an empty rest is 0.
    ``truncate`` cuts the binary fraction (19,99 gives 1998), ``round`` does not.
    """
    kept = F.regexp_replace(text, NOT_OF_AN_AMOUNT, "")
    cents = F.when(kept == "", F.lit(0.0)).otherwise(F.replace(kept, F.lit(","), F.lit(".")).cast("double")) * 100
    return (F.round(cents) if rounding == "round" else cents).cast("long")
