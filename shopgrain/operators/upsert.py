"""Keyed upsert between Spark tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named, require_columns
from ..saving import saved
from .cleaning import remove_duplicates


def upsert_by_key(
    target: DataFrame, source: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """The target with source rows added, replacing target rows of the same key.

    Source rows are made unique by key first, once: the result is written to the
    working folder and serves both the join and the rows that are added. A null key
    matches nothing, so such rows of both sides stay, as in a SQL ``MERGE``; they go
    around the join. The anti join has a shuffle right below it on both sides, the
    form whose hot target keys AQE splits; Spark broadcasts a small source by its size.
    """
    if not keys:
        raise ValueError("an upsert needs at least one key column")
    require_columns(target, [*keys, *source.columns])
    require_columns(source, [*keys, *target.columns])
    columns = [named(c) for c in target.columns]
    unnamed = any_null(keys)
    unique = saved(remove_duplicates(source.where(~unnamed), keys), "source")
    replaced = unique.select(*[named(k) for k in keys])
    kept = target.where(~unnamed).join(replaced, list(keys), "left_anti").select(*columns)
    around = target.where(unnamed).unionByName(source.where(unnamed))
    return kept.unionByName(unique).unionByName(around)


def unique_by_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per complete key; rows with a null in the key all stay."""
    complete = remove_duplicates(source.where(~any_null(keys)), keys)
    return complete.unionByName(source.where(any_null(keys)))


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [named(k).isNull() for k in keys])
