"""Top-N reports with a fixed order among equals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import named, require_columns


def top_n(
    df: DataFrame, metric: str, n: int = 10, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """The ``n`` rows with the largest ``metric``.

    Equal rows are ordered by ``tie_break`` (by all other columns when not given),
    so the answer does not depend on the order of arrival. Every task keeps only
    its own best ``n`` rows.
    """
    ties = [c for c in df.columns if c != metric] if tie_break is None else tie_break
    require_columns(df, [metric, *ties])
    order = [named(metric).desc_nulls_last(), *[named(c).asc() for c in ties]]
    return df.orderBy(*order).limit(n)


def top_n_per_group(
    df: DataFrame, group: str, metric: str, n: int, rank_col: str = "rank"
) -> DataFrame:
    """Rows whose rank by ``metric`` within ``group`` is at most ``n``, ties kept.

    The ``rank() <= n`` shape lets Spark cut every map partition to its best rows
    per group before the groups are brought together.
    """
    require_columns(df, [group, metric])
    best_first = Window.partitionBy(named(group)).orderBy(named(metric).desc())
    ranked = df.withColumn(rank_col, F.rank().over(best_first))
    return ranked.where(F.col(rank_col) <= n)
