"""Read tables and queries of a database over JDBC.

Any database with a JDBC driver on the session's class path will do. Large
tables are read by many tasks when a partition column is named.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Partitioning:
    """How to split a table: ranges of ``column`` read by ``partitions`` tasks.

    The bounds only place the cuts; rows outside them are read too. Bounds left
    out are asked from the database.
    """

    column: str
    partitions: int
    lower: object | None = None
    upper: object | None = None


def read_query(
    spark: SparkSession, url: str, query: str, properties: Mapping[str, str]
) -> DataFrame:
    """The result of a query that the database runs."""
    reader = spark.read.format("jdbc").options(**properties)
    return reader.option("url", url).option("query", query).load()


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partitioning: Partitioning | None = None,
) -> DataFrame:
    """A whole table; filters and column choices are pushed to the database."""
    if partitioning is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    p = partitioning
    lower, upper = p.lower, p.upper
    if lower is None or upper is None:
        edges = f"SELECT MIN({p.column}) AS low, MAX({p.column}) AS high FROM {table}"
        low, high = read_query(spark, url, edges, properties).first()
        if low is None:
            return spark.read.jdbc(url, table, properties=dict(properties))
        lower = low if lower is None else lower
        upper = high if upper is None else upper
    return spark.read.jdbc(
        url,
        table,
        column=p.column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=p.partitions,
        properties=dict(properties),
    )


def catalog_query(schema: str) -> str:
    """SQL for the names of all tables in a schema."""
    return (
        "SELECT table_name FROM information_schema.tables "
        f"WHERE table_schema = {text_literal(schema)}"
    )


def existence_query(table: str, schema: str | None = None, catalog: str = "") -> str:
    """SQL for the number of tables of a name, in any case of letters."""
    tables = f"{catalog}.information_schema.tables" if catalog else (
        "information_schema.tables"
    )
    query = (
        f"SELECT COUNT(*) AS n FROM {tables} "
        f"WHERE UPPER(table_name) = UPPER({text_literal(table)})"
    )
    if schema is not None:
        query += f" AND UPPER(table_schema) = UPPER({text_literal(schema)})"
    return query


def text_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def table_exists(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    schema: str | None = None,
) -> bool:
    """Whether the database has the table; a failed question raises."""
    query = existence_query(table, schema)
    return read_query(spark, url, query, properties).first()[0] > 0


def load_all_tables(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    schema: str = "public",
    partitioning: Mapping[str, Partitioning] | None = None,
) -> dict[str, DataFrame]:
    """Every table of a schema by name; nothing is read until it is used."""
    rows = read_query(spark, url, catalog_query(schema), properties).collect()
    names = sorted(r[0] for r in rows)
    splits = partitioning or {}
    return {n: read_table(spark, url, n, properties, splits.get(n)) for n in names}
