"""Date parsing and year ranges."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import is_text, named, type_of

# Accepted date patterns; the first that parses wins, so an
# ambiguous 05/01/2023 is the fifth of January.
DATE_PATTERNS = (
    "dd.MM.yyyy",
    "dd/MM/yyyy",
    "dd/MMM/yyyy",
    "dd.MMMM.yyyy",
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "dd-MMM-yyyy",
)


def parse_date(text: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """The date that ``text`` spells in the first matching pattern, else null.

    A failed attempt costs far more than a look at a few characters, so a pattern
    is tried only on texts of its shape.
    """
    return F.coalesce(
        *[F.when(_has_shape(text, p), F.try_to_date(text, p)) for p in patterns]
    )


def _has_shape(text: Column, pattern: str) -> Column:
    """What every text of the pattern satisfies, as far as positions are fixed.

    Two-digit fields have two characters, month names start with no digit, and a
    year has digits from its second character on (the first may be a sign).
    """
    position, shape = 1, F.lit(True)

    def character(at: int) -> Column:
        return F.substr(text, F.lit(at), F.lit(1))

    for field, separator in re.findall("([A-Za-z]+)([^A-Za-z]*)", pattern):
        if field in ("MMM", "MMMM"):
            return shape & ~character(position).between("0", "9")
        if field == "yyyy":
            return shape & character(position + 2).between("0", "9")
        if field not in ("dd", "MM"):
            return shape
        position += len(field)
        for expected in separator:
            shape = shape & (character(position) == expected)
            position += 1
    return shape


def as_date(df: DataFrame, name: str) -> Column:
    """A date or timestamp column as a date; ISO text is read, other text is null."""
    c = named(name)
    return c.try_cast("date") if is_text(type_of(df, name)) else c.cast("date")


def year_range(df: DataFrame, name: str, year: int) -> Column:
    """True for dates inside ``year``, written as a range.

    Unlike ``year(col) = 2023`` a range reaches the Parquet reader, which can then
    skip files and row groups by their statistics.
    """
    c = named(name)
    if is_text(type_of(df, name)):
        c = c.try_cast("date")
    return (c >= F.lit(date(year, 1, 1))) & (c < F.lit(date(year + 1, 1, 1)))
