"""Array columns of nested files as tables of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.columns import require_columns, type_of


def array_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]


def flatten_arrays(df: DataFrame, field: str) -> DataFrame:
    """One row per array element: struct fields as columns, scalars as ``value``.

    Rows whose array is null or empty give nothing.
    """
    require_columns(df, [field])
    dtype = type_of(df, field)
    if not isinstance(dtype, T.ArrayType):
        raise ValueError(f"{field!r} is not an array but {dtype.simpleString()}")
    quoted = "`" + field.replace("`", "``") + "`"
    if isinstance(dtype.elementType, T.StructType):
        return df.selectExpr(f"inline({quoted})")
    return df.selectExpr(f"explode({quoted}) AS value")
