"""Load all tables of a dataset and report on each."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..saving import saved_and_counted
from .database import upsert_jdbc
from .dialects import Dialect
from .warehouse import Warehouse

log = logging.getLogger(__name__)

STATUS_SCHEMA = "table_name string, action string, rows bigint, error string"

# Loads one table by its keys and says what was done.
LoadTable = Callable[[DataFrame, str, Sequence[str]], str]


def jdbc_loader(
    url: str, dialect: Dialect, properties: Mapping[str, str], schema: str | None = None
) -> LoadTable:
    """Loader for ``upsert_all`` into a database."""

    def load(df: DataFrame, table: str, keys: Sequence[str]) -> str:
        return upsert_jdbc(df, url, table, keys, dialect, properties, schema)

    return load


def warehouse_loader(warehouse: Warehouse) -> LoadTable:
    """Loader for ``upsert_all``: upsert known tables, create the others."""

    def load(df: DataFrame, table: str, keys: Sequence[str]) -> str:
        if warehouse.exists(df.sparkSession, table):
            warehouse.upsert(df, table, keys)
            return "upserted"
        warehouse.create(df, table)
        return "created"

    return load


def upsert_all(
    spark: SparkSession,
    dataset: Mapping[str, DataFrame | None],
    keys: Mapping[str, str | Sequence[str]],
    load: LoadTable,
) -> DataFrame:
    """Give every table with its keys to ``load`` and return one status per table.

    Missing keys raise before anything is written. Empty tables are skipped, and a
    failed table does not stop the others: its error is in the status. Each table is
    written to the working folder first, so its chain runs once for the count and the load.
    """
    unkeyed = [name for name in dataset if not keys.get(name)]
    if unkeyed:
        raise ValueError(f"no key columns are given for tables {unkeyed}")
    statuses = []
    for name, df in dataset.items():
        given = keys[name]
        columns = [given] if isinstance(given, str) else list(given)
        rows = 0
        try:
            if df is not None:
                df, rows = saved_and_counted(df, name)
            action = load(df, name, columns) if rows else "skipped"
            statuses.append((name, action, rows, None))
        except Exception as e:
            log.error("loading %s failed: %s", name, e)
            statuses.append((name, "failed", rows, str(e)))
    return spark.createDataFrame(statuses, STATUS_SCHEMA)
