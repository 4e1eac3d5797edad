"""Enrichment steps; the function names are the step names of a configuration."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import age_in_years
from ..functions.columns import INVALID_DATE, is_text, named, require_columns, type_of
from ..functions.dates import as_date
from ..functions.states import state_code


def add_age_column(
    df: DataFrame,
    birth_date_column: str,
    as_of: date | Column | None = None,
    exact: bool = False,
) -> DataFrame:
    """Add ``age`` in full years on ``as_of`` (today by default).

    The text ``Invalid Date`` gives 0, an unknown date gives null.
    """
    require_columns(df, [birth_date_column])
    if as_of is None:
        as_of = F.current_date()
    elif isinstance(as_of, date):
        as_of = F.lit(as_of)
    age = age_in_years(as_date(df, birth_date_column), as_of, exact)
    if is_text(type_of(df, birth_date_column)):
        invalid = named(birth_date_column) == INVALID_DATE
        age = F.when(invalid, F.lit(0).cast("bigint")).otherwise(age)
    return df.withColumn("age", age)


def add_state_columns(
    df: DataFrame, shipping_col: str, billing_col: str, mode: str = "first"
) -> DataFrame:
    """Add ``shipping_state`` and ``billing_state`` found in two address columns."""
    require_columns(df, [shipping_col, billing_col])
    return df.withColumns(
        {
            "shipping_state": state_code(named(shipping_col), mode),
            "billing_state": state_code(named(billing_col), mode),
        }
    )
