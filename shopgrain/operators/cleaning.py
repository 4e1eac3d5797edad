"""Cleaning steps.

The public functions are also the step names a cleaning configuration uses. None
of them starts a job (``exact=True`` medians excepted), and all but
``remove_duplicates`` and the computed fills are row-local: no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    BLANK_TEXTS,
    INVALID_DATE,
    NULL_TEXT,
    blank_to_null,
    existing_columns,
    is_floating,
    is_null_or_nan,
    is_text,
    missing_test,
    named,
    null_or_nan_test,
    numeric,
    require_columns,
    type_of,
)
from ..functions.contact import accepted_phone, valid_email, written_phone
from ..functions.dates import parse_date
from .modes import exact_modes
from .quantiles import exact_medians

# Names of the imputation methods and of the negative-value rules.
COMPUTED_FILLS = ("mean", "median", "mode")
NEGATIVE_RULES = ("absolute", "remove", "zero", "drop")

# Fixed value: 1 / rank error of the approximate median (0.01).
MEDIAN_ACCURACY = 100


def remove_duplicates(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    keep: str = "first",
) -> DataFrame:
    """One row per distinct key; null keys are equal to each other.

    The survivor is the smallest row by ``order_by`` and then by the remaining
    columns from left to right (the largest with ``keep="last"``), so a rerun or a
    retried task picks the same row. It is found with a ``min`` aggregate, not a
    window: map tasks shrink a hot key to one row each before the shuffle.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    if not columns:
        return df.dropDuplicates()
    require_columns(df, [*columns, *(order_by or ())])
    others = [c for c in df.columns if c not in columns]
    if not others:
        return df.dropDuplicates(list(columns))
    first = [c for c in (order_by or ()) if c not in columns]
    ranked = first + [c for c in others if c not in first]
    pick = F.min if keep == "first" else F.max
    # Maps have no order of their own; their sorted entries have.
    maps = {c for c in others if isinstance(type_of(df, c), T.MapType)}
    fields = [
        F.sort_array(F.map_entries(named(c))).alias(c) if c in maps else named(c)
        for c in ranked
    ]
    survivors = df.groupBy(*[named(c) for c in columns]).agg(
        pick(F.struct(*fields)).alias("_survivor")
    )

    def field(c: str) -> Column:
        value = F.col("_survivor").getField(c)
        return (F.map_from_entries(value) if c in maps else value).alias(c)

    return survivors.select(*[named(c) if c in columns else field(c) for c in df.columns])


def impute_nulls(
    df: DataFrame,
    columns: Sequence[str],
    method: str,
    value: Any = None,
    exact: bool = False,
    accuracy: int = MEDIAN_ACCURACY,
) -> DataFrame:
    """Fill null and the text ``null`` by ``constant``, ``mean``, ``median`` or ``mode``.

    A constant that does not fit the column's type (a text on a number) leaves the
    nulls as they are. Means filled into integer columns are cut, not rounded. With
    ``exact`` medians are exact, and modes, which always are, shuffle digests in
    place of the values: for columns of many or long values.
    """
    if method != "constant" and method not in COMPUTED_FILLS:
        raise ValueError(
            f"method must be 'constant' or one of {COMPUTED_FILLS}, not {method!r}"
        )
    require_columns(df, columns)
    recoded = blank_to_null(df, columns, NULL_TEXT)
    return _fill(recoded, columns, method, value, exact, accuracy)


def impute_missing_values(
    df: DataFrame,
    strategy: str = "mean",
    value: Any = None,
    columns: Sequence[str] | None = None,
    exact: bool = False,
    accuracy: int = MEDIAN_ACCURACY,
) -> DataFrame:
    """As ``impute_nulls`` but only for real nulls; ``value`` is the constant rule.

    Without ``columns`` every column the strategy can work on is filled: numbers
    for the mean and the median, all columns otherwise.
    """
    if strategy != "value" and strategy not in COMPUTED_FILLS:
        raise ValueError(
            f"strategy must be 'value' or one of {COMPUTED_FILLS}, not {strategy!r}"
        )
    if columns is None:
        columns = [
            f.name
            for f in df.schema
            if strategy in ("value", "mode") or isinstance(f.dataType, T.NumericType)
        ]
    require_columns(df, columns)
    method = "constant" if strategy == "value" else strategy
    return _fill(df, columns, method, value, exact, accuracy)


def _fill(
    df: DataFrame,
    columns: Sequence[str],
    method: str,
    value: Any,
    exact: bool,
    accuracy: int,
) -> DataFrame:
    if method in ("mean", "median"):
        texts = [
            c for c in columns if not isinstance(type_of(df, c), T.NumericType)
        ]
        if texts:
            raise ValueError(f"{method} needs numeric columns, {texts} are not")
    if not columns:
        return df

    filled = df
    if method == "constant":
        fills = dict.fromkeys(columns, F.lit(value))
    elif method == "median" and exact:
        fills = {c: F.lit(v) for c, v in exact_medians(df, columns).items()}
    elif method == "mode" and exact:
        fills = {c: _literal(df, c, v) for c, v in exact_modes(df, columns).items()}
    elif method == "mode":
        filled = df.withColumn("_fills", _most_frequent(df, columns).scalar())
        fills = {c: F.col("_fills").getField(f"fill_{i}") for i, c in enumerate(columns)}
    else:
        # One pass for all columns; the one-row answer enters the plan as a scalar
        # subquery, which runs once and is not a join.
        statistic = (
            F.avg
            if method == "mean"
            else lambda c: F.percentile_approx(c, 0.5, accuracy)
        )
        answers = [
            statistic(F.when(~is_null_or_nan(df, c), named(c))).alias(f"fill_{i}")
            for i, c in enumerate(columns)
        ]
        filled = df.withColumn("_fills", df.agg(F.struct(*answers)).scalar())
        fills = {
            c: F.col("_fills").getField(f"fill_{i}") for i, c in enumerate(columns)
        }

    return filled.withColumns(
        {c: F.coalesce(_nan_to_null(df, c), _as_type(df, c, f)) for c, f in fills.items()}
    ).drop("_fills")


def _literal(df: DataFrame, name: str, value: Any) -> Column:
    """A value of a column as a literal of the column's type."""
    schema = T.StructType([T.StructField("fill", type_of(df, name))])
    return df.sparkSession.createDataFrame([(value,)], schema).select("fill").scalar()


def _most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The most frequent value of each column, the smallest on ties, as one struct.

    One aggregate counts the values of all columns. Counting per value first keeps
    a hot value to one row per map task and never gathers the distinct values.
    """
    numbers = range(len(columns))
    entries = [
        F.struct(
            F.lit(i).alias("i"),
            *[
                (named(c) if i == k else F.lit(None).cast(type_of(df, c))).alias(f"v{k}")
                for k, c in enumerate(columns)
            ],
            (~is_null_or_nan(df, columns[i])).alias("known"),
        )
        for i in numbers
    ]
    counts = (
        df.select(F.inline(F.array(*entries)))
        .where("known")
        .groupBy("i", *[f"v{k}" for k in numbers])
        .agg((-F.count(F.lit(1))).alias("n"))
    )
    best = [F.min(F.when(F.col("i") == k, F.struct("n", f"v{k}"))) for k in numbers]
    fills = [b.getField(f"v{k}").alias(f"fill_{k}") for k, b in enumerate(best)]
    return counts.agg(F.struct(*fills).alias("fills"))


def _nan_to_null(df: DataFrame, name: str) -> Column:
    c = named(name)
    return F.when(~F.isnan(c), c) if is_floating(type_of(df, name)) else c


def _as_type(df: DataFrame, name: str, value: Column) -> Column:
    return value.try_cast(type_of(df, name))


def split_nulls(
    df: DataFrame, columns: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Recode null-like texts in every column, then split into (kept, rejected).

    A row is rejected if any of ``columns`` (all columns when not given) is null or
    NaN; the two parts together are the input.
    """
    checked = list(columns) if columns else df.columns
    require_columns(df, checked)
    recoded = blank_to_null(df, df.columns, BLANK_TEXTS)
    incomplete = F.expr(" OR ".join(null_or_nan_test(recoded, c) for c in checked))
    return recoded.where(~incomplete), recoded.where(incomplete)


def drop_nulls(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    archive_folder: str | None = None,
    archive_df_name: str | None = None,
) -> DataFrame:
    """The kept part of ``split_nulls``.

    The archive parameters are for the cleaning chain, which hands the rejected
    part and its path back to the caller; this function writes nothing.
    """
    return split_nulls(df, columns)[0]


def remove_decimal(
    df: DataFrame, columns: Sequence[str], missing: str = "skip"
) -> DataFrame:
    """Round down to whole numbers; -1.2 becomes -2."""
    names = existing_columns(df, columns, missing)
    return df.withColumns({c: F.floor(numeric(df, c)) for c in names})


def standardize_date_format(
    df: DataFrame, column: str, format: str = "yyyy-MM-dd", missing: str = "skip"
) -> DataFrame:
    """Rewrite dates of seven patterns as text in one; the rest is ``Invalid Date``."""
    if not existing_columns(df, [column], missing):
        return df
    source, dtype = named(column), type_of(df, column)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        parsed = source.cast("date")
    else:
        parsed = parse_date(source.cast("string"))
    written = F.date_format(parsed, format)
    return df.withColumn(column, F.coalesce(written, F.lit(INVALID_DATE)))


def clean_phone_numbers(
    df: DataFrame, column: str, accept_001_13: bool = False
) -> DataFrame:
    """Normalise a phone column; see ``functions.clean_phone``."""
    require_columns(df, [column])
    phone = named(column).cast("string")
    # A column of its own, so that Spark computes the written form once.
    staged = df.withColumn("_written", written_phone(phone, accept_001_13))
    accepted = accepted_phone(phone, F.col("_written"))
    return staged.withColumn(column, accepted).drop("_written")


def validate_emails(df: DataFrame, column: str, invalid_message: str) -> DataFrame:
    """Replace everything that is not an e-mail address by a message."""
    require_columns(df, [column])
    text = named(column).cast("string")
    return df.withColumn(column, valid_email(text, invalid_message))


def handle_negative_values(
    df: DataFrame,
    columns: Sequence[str],
    operation: str = "absolute",
    apply_floor: bool = False,
    missing: str = "skip",
) -> DataFrame:
    """Treat negative numbers.

    ``absolute`` flips the sign, ``remove`` makes them null, ``zero`` makes them
    (and nulls) 0, ``drop`` keeps only rows with a value of 0 or more.
    """
    if operation not in NEGATIVE_RULES:
        raise ValueError(f"operation must be one of {NEGATIVE_RULES}, not {operation!r}")
    names = existing_columns(df, columns, missing)
    if operation == "drop":
        for c in names:
            df = df.where(numeric(df, c) >= 0)
    else:
        df = df.withColumns({c: _without_negatives(df, c, operation) for c in names})
    if apply_floor:
        df = remove_decimal(df, names)
    return df


def _without_negatives(df: DataFrame, name: str, operation: str) -> Column:
    value, number, dtype = named(name), numeric(df, name), type_of(df, name)
    if operation == "absolute":
        if is_text(dtype):
            return F.when(number < 0, (-number).cast(dtype)).otherwise(value)
        return F.abs(value)
    kept = F.when(number >= 0, value)
    return kept.otherwise(F.lit(0).cast(dtype)) if operation == "zero" else kept


def remove_string_from_columns(
    df: DataFrame,
    columns: Sequence[str],
    string_to_remove: str,
    literal: bool = False,
) -> DataFrame:
    """Delete every match of a regular expression (of a plain text if ``literal``)."""
    require_columns(df, columns)
    if literal:
        return df.withColumns(
            {
                c: F.replace(named(c).cast("string"), F.lit(string_to_remove), F.lit(""))
                for c in columns
            }
        )
    return df.withColumns(
        {
            c: F.regexp_replace(named(c).cast("string"), string_to_remove, "")
            for c in columns
        }
    )


def convert_column_type(
    df: DataFrame, column: str, target_type: str, strict: bool = False
) -> DataFrame:
    """Cast a column; values that do not fit become null, or raise if ``strict``."""
    require_columns(df, [column])
    cast = named(column).cast if strict else named(column).try_cast
    try:
        converted = df.withColumn(column, cast(target_type))
        converted.schema  # noqa: B018 - analyses the cast now, without a job
    except Exception as e:
        raise ValueError(f"cannot convert {column!r} to {target_type!r}: {e}") from e
    return converted


def total_null_count(df: DataFrame) -> DataFrame:
    """Nulls and ``null`` texts over all columns, as one row, in one pass."""
    counts = df.agg(
        *[
            F.expr(f"count_if({missing_test(df, c, NULL_TEXT)}) AS n{i}")
            for i, c in enumerate(df.columns)
        ]
    )
    total = F.aggregate(
        F.array(*counts.columns),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n,
    )
    return counts.select(total.alias("total_null_count"))


def calculate_total_null_count(df: DataFrame) -> int:
    """The number in ``total_null_count``; runs one job."""
    return total_null_count(df).first()["total_null_count"]
