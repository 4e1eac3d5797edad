"""Collects the registered queries of the suite modules."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .views import sql

Query = Callable[[SparkSession, str], DataFrame]


class Entry(NamedTuple):
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def register(run: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTRY[name] = Entry(
            lambda spark, sf_dir: plain(run(spark, sf_dir)),
            sql(oracle) if oracle else None,
        )
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles: exact sums first, one conversion at the end."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})
