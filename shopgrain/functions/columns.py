"""Column lookup, type tests and casts that never raise on dirty data.

ANSI mode turns comparisons such as ``int_col = 'null'`` into errors, so every
text test here looks at the column's type first.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Texts that stand for a missing value in the source files.
NULL_TEXT = ("null",)
BLANK_TEXTS = ("null", "None", "")

# Texts that cleaning writes into the data.
NOT_AVAILABLE = "Not Available"
INVALID_DATE = "Invalid Date"
INVALID_PHONE = "Invalid phone number"


def quoted(name: str) -> str:
    """The column name for use in SQL text, dots and spaces included."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """The text as a literal for use in SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(name: str) -> Column:
    """The column called exactly ``name``."""
    return F.col(quoted(name))


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Return ``df`` if it has all ``names``; else raise with the missing ones."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df


def existing_columns(
    df: DataFrame, names: Sequence[str], missing: str = "skip"
) -> list[str]:
    """The ``names`` that ``df`` has; others are logged, or raise on ``"raise"``."""
    if missing not in ("skip", "raise"):
        raise ValueError(f"missing must be 'skip' or 'raise', not {missing!r}")
    if missing == "raise":
        require_columns(df, names)
    absent = [n for n in names if n not in df.columns]
    if absent:
        log.warning("columns %s are not in the table and are left alone", absent)
    return [n for n in names if n in df.columns]


def numeric(df: DataFrame, name: str) -> Column:
    """The column as a number; unreadable text becomes null instead of an error."""
    c = named(name)
    return c.try_cast("double") if is_text(type_of(df, name)) else c


def missing_test(df: DataFrame, name: str, texts: Sequence[str] = ()) -> str:
    """SQL condition: null, or in a text column one of ``texts``."""
    c = quoted(name)
    if not texts or not is_text(type_of(df, name)):
        return f"{c} IS NULL"
    return f"({c} IS NULL OR {c} IN ({', '.join(map(literal, texts))}))"


def is_missing(df: DataFrame, name: str, texts: Sequence[str] = ()) -> Column:
    """True for null or a null-like text; never null."""
    return F.expr(missing_test(df, name, texts))


def null_or_nan_test(df: DataFrame, name: str) -> str:
    """SQL condition: null, or in a floating-point column NaN; never null."""
    c = quoted(name)
    if is_floating(type_of(df, name)):
        return f"({c} IS NULL OR isnan({c}))"
    return f"{c} IS NULL"


def is_null_or_nan(df: DataFrame, name: str) -> Column:
    """True for null and, in floating-point columns, for NaN."""
    return F.expr(null_or_nan_test(df, name))


def blank_to_null(
    df: DataFrame, names: Sequence[str], texts: Sequence[str]
) -> DataFrame:
    """Turn null-like texts of the text columns among ``names`` into null."""
    recoded = {}
    for name in names:
        if is_text(type_of(df, name)):
            test, c = missing_test(df, name, texts), quoted(name)
            recoded[name] = F.expr(f"CASE WHEN NOT {test} THEN {c} END")
    return df.withColumns(recoded) if recoded else df
