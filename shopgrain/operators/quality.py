"""Data-quality profiles and their before/after comparison.

A profile has one row per (table, column).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NULL_TEXT, literal, missing_test, named, quoted
from ..saving import saved

# Type names whose negatives the older rule counts. It spells the
# 64-bit integer "long", which no Spark column is called, so bigint never counts.
COUNTED_TYPE_NAMES = ("int", "long", "float", "double")

# Names of the compared metrics.
NULL_METRIC = "Null Count"
NEGATIVE_METRIC = "Negative Count"
TYPE_METRIC = "Data Type Change"

KEYS = ["table_name", "column_name"]


def profile_table(
    df: DataFrame, table_name: str, reference_types: bool = False, by_digest: bool = False
) -> DataFrame:
    """Null, negative, row, column and duplicate counts of one table.

    The table is read once: equal rows are first counted together (map tasks
    already merge a hot row), and the column counts are taken over the distinct
    rows, weighted by how often each occurs. With ``by_digest``, for tables of wide
    rows, duplicates are counted as in ``duplicate_count`` and all else without a shuffle.
    """
    totals = ["coalesce(sum(_copies), 0L) AS rows"]
    distinct = "rows - duplicates" if by_digest else "distinct_rows"
    if not by_digest:
        totals.append("count(*) AS distinct_rows")
    entries = []
    for i, field in enumerate(df.schema):
        missing = missing_test(df, field.name, NULL_TEXT)
        totals.append(f"{_weighted(missing)} AS nulls_{i}")
        if _counts_negatives(field.dataType, reference_types):
            negative = _weighted(f"{quoted(field.name)} < 0")
        else:
            negative = "0L"
        totals.append(f"{negative} AS negatives_{i}")
        entries.append(
            f"""named_struct('table_name', {literal(table_name)},
            'column_name', {literal(field.name)}, 'null_count', nulls_{i},
            'negative_count', negatives_{i},
            'data_type', {literal(field.dataType.simpleString())}, 'row_count', rows,
            'column_count', {len(df.columns)},
            'duplicate_count', rows - ({distinct}))"""
        )
    if by_digest:
        whole = df.withColumn("_copies", F.lit(1).cast("long"))
        counted = whole.agg(*[F.expr(t) for t in totals])
        counted = counted.withColumn("duplicates", duplicate_count(df, True).scalar())
    else:
        counted = _counted_rows(df).agg(*[F.expr(t) for t in totals])
    return counted.selectExpr(f"inline(array({', '.join(entries)}))")


def _counted_rows(df: DataFrame) -> DataFrame:
    """Distinct rows and how often each occurs."""
    return df.groupBy(*[named(c) for c in df.columns]).agg(
        F.count(F.lit(1)).alias("_copies")
    )


def _weighted(condition: str) -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN _copies END), 0L)"


def profile_tables(
    dataset: Mapping[str, DataFrame], reference_types: bool = False, by_digest: bool = False
) -> DataFrame:
    """The profiles of all tables of a dataset, one below the other."""
    if not dataset:
        raise ValueError("there is no table to profile")
    profiles = [profile_table(df, n, reference_types, by_digest) for n, df in dataset.items()]
    return reduce(DataFrame.unionByName, profiles)


def _counts_negatives(dtype: T.DataType, reference_types: bool) -> bool:
    if reference_types:
        return dtype.simpleString() in COUNTED_TYPE_NAMES
    return isinstance(dtype, T.NumericType)


def duplicate_count(df: DataFrame, by_digest: bool = False) -> DataFrame:
    """Rows that repeat an earlier row, as one row.

    With ``by_digest`` rows are first counted by a digest of 128 bits, whatever their
    width. Only rows whose digest occurs more than once are compared by value, so equal
    digests of different rows change nothing; of large tables Spark's runtime filter keeps
    the others out of that shuffle. The digests are written when this is called.
    """
    if not by_digest:
        repeats = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0))
        return _counted_rows(df).agg(repeats.alias("duplicate_count"))
    digested = _digested(df)
    counted = saved(digested.groupBy("_d1", "_d2").agg(F.count("*").alias("_n")), "digests")
    repeated = counted.where("_n > 1").select("_d1", "_d2")
    known = digested.join(repeated, ["_d1", "_d2"], "left_semi").drop("_d1", "_d2")
    return duplicate_count(known)


def _digested(df: DataFrame) -> DataFrame:
    """Add two hashes over all columns and over which of them are null."""
    columns = [named(c) for c in df.columns]
    nulls = [c.isNull() for c in columns]
    return df.withColumns(
        {f"_d{i}": F.xxhash64(F.lit(i), *columns, *nulls) for i in (1, 2)}
    )


def profile_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Every null count, negative count and type that differs between two profiles.

    One row per (table, column, metric) with both values as text; a column that
    one side lacks counts as 0 nulls, 0 negatives and an empty type there.
    """
    fields = ("null_count", "negative_count", "data_type")

    def side(profile: DataFrame, name: str) -> DataFrame:
        texts = [f"CAST({f} AS STRING) AS {name}_{f}" for f in fields]
        return profile.selectExpr(*KEYS, *texts)

    def metric(name: str, field: str, absent: str) -> str:
        return f"""named_struct('metric', '{name}',
            'before', coalesce(before_{field}, '{absent}'),
            'after', coalesce(after_{field}, '{absent}'))"""

    both = side(before, "before").join(side(after, "after"), KEYS, "full")
    metrics = [
        metric(NULL_METRIC, "null_count", "0"),
        metric(NEGATIVE_METRIC, "negative_count", "0"),
        metric(TYPE_METRIC, "data_type", ""),
    ]
    stacked = both.selectExpr(*KEYS, f"inline(array({', '.join(metrics)}))")
    return stacked.where("before <> after")


def profile_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, columns and duplicates of each table before and after."""

    def per_table(profile: DataFrame, side: str) -> DataFrame:
        return profile.groupBy("table_name").agg(
            F.max("row_count").alias(f"row_count_{side}"),
            F.max("column_count").alias(f"column_count_{side}"),
            F.max("duplicate_count").alias(f"duplicate_count_{side}"),
        )

    return per_table(before, "before").join(
        per_table(after, "after"), "table_name", "left"
    )
