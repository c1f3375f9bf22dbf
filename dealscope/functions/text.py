"""Cleaning and parsing of raw text cells.

Every function maps a string column to a column built from Spark's own
expressions. Bad cells become NULL, never an error: Spark 4 runs in ANSI mode,
where a plain cast of one dirty cell would fail the whole job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a blank besides the single space (no-break spaces
# group digits in spreadsheets), and quote marks.
BLANKS = ("  ", "\t", "\n", "\r", "\u000b", "\u000c", "\u00a0", "\u202f")
BLANK_RUN = "[ \t\n\r\u000b\u000c\u00a0\u202f]+"
QUOTES = "«»„“”\"'"


def clean(cell: Column) -> Column:
    """Collapse runs of blanks, trim, and turn an empty cell into NULL.

    Most cells hold neither runs nor odd blanks, which a search for substrings
    finds out far faster than the regular expression that repairs the others.
    """
    odd = reduce(Column.__or__, [cell.contains(blank) for blank in BLANKS])
    single = F.when(odd, F.regexp_replace(cell, BLANK_RUN, " ")).otherwise(cell)
    return F.nullif(F.trim(single), F.lit(""))


def fold_name(cell: Column) -> Column:
    """Comparable form of a name: cleaned, without quote marks, in lower case."""
    return clean(F.lower(F.translate(cell, QUOTES, "")))


def digits(cell: Column) -> Column:
    """The digits of a phone number; NULL when there are none."""
    return F.nullif(F.regexp_replace(cell, "[^0-9]", ""), F.lit(""))


def parse_decimal(cell: Column, precision: int = 18, scale: int = 2) -> Column:
    """``'1 234,50'`` or ``'1234.5'`` to a decimal, from a cleaned cell; NULL for one with
    more decimals than fit, as rounding would change an amount without a trace."""
    wide = f"decimal(38,{38 - precision + scale})"
    read = F.coalesce(cell.try_cast(wide), F.translate(cell, ", ", ".").try_cast(wide))
    fitted = read.try_cast(f"decimal({precision},{scale})")
    return F.when(fitted == read, fitted)


def parse_timestamp(cell: Column) -> Column:
    """ISO timestamps and dates, ``dd.MM.yyyy`` with or without a time, and
    spreadsheet serial numbers (days since 1899-12-30), from a cleaned cell."""
    serial = F.when(cell.rlike(r"^\d{5}(\.\d+)?$"), cell.try_cast("double"))
    midnight = F.date_add(F.lit("1899-12-30").cast("date"), F.floor(serial).cast("int")).cast("timestamp")
    seconds = F.round((serial - F.floor(serial)) * 86400).cast("decimal(18,6)")
    return F.coalesce(
        # A year alone, or a bare number, would also cast.
        F.when(F.substring(cell, 5, 1) == "-", cell.try_cast("timestamp")),
        F.try_to_timestamp(cell, F.lit("dd.MM.yyyy HH:mm:ss")),
        F.try_to_timestamp(cell, F.lit("dd.MM.yyyy HH:mm")),
        F.try_to_timestamp(cell, F.lit("dd.MM.yyyy")),
        midnight + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds),
    )


def parse_date(cell: Column) -> Column:
    return parse_timestamp(cell).cast("date")


def to_code(cell: Column, codes: dict[str, str]) -> Column:
    """Map the synonyms of a status or stage to its code; unknown words give NULL.

    ``codes`` is configuration (a handful of words), so it is compiled into the
    expression instead of being joined.
    """
    known = F.create_map(*[F.lit(part) for word, code in codes.items() for part in (word.lower(), code)])
    return F.try_element_at(known, fold_name(cell))
