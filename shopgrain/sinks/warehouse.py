"""Tables of a warehouse reached through a Spark data source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.upsert import unique_by_key
from ..sources.jdbc import existence_query
from .database import RunSql, stage_name
from .dialects import SNOWFLAKE, Dialect


def create_table(
    df: DataFrame,
    table: str,
    format: str,
    options: Mapping[str, str],
    table_option: str = "dbtable",
) -> None:
    """Write ``df`` as a table through any data source, replacing an old one."""
    writer = df.write.format(format).options(**options)
    writer.option(table_option, table).mode("overwrite").save()


@dataclass(frozen=True)
class Warehouse:
    """A warehouse with a Spark connector.

    ``run_sql`` sends statements to it (the client library is the caller's);
    ``catalog`` and ``schema`` say where its tables are.
    """

    format: str
    options: Mapping[str, str]
    run_sql: RunSql
    schema: str
    catalog: str = ""
    dialect: Dialect = SNOWFLAKE
    table_option: str = "dbtable"

    def qualified(self, table: str) -> str:
        return ".".join(p for p in (self.catalog, self.schema, table) if p)

    def read_query(self, spark: SparkSession, query: str) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        return reader.option("query", query).load()

    def exists(self, spark: SparkSession, table: str) -> bool:
        """Whether the table exists, whatever its case; a failed question raises."""
        query = existence_query(table, self.schema, self.catalog)
        return self.read_query(spark, query).first()[0] > 0

    def create(self, df: DataFrame, table: str) -> None:
        create_table(df, table, self.format, self.options, self.table_option)

    def upsert(self, df: DataFrame, table: str, keys: Sequence[str]) -> None:
        """Stage, merge, drop the stage; a failed merge raises and keeps it."""
        stage = stage_name(table)
        target, staged = self.qualified(table), self.qualified(stage)
        merge = self.dialect.upsert_sql(target, staged, df.columns, keys)
        unique = unique_by_key(df, keys)
        create_table(unique, stage, self.format, self.options, self.table_option)
        self.run_sql([merge, self.dialect.drop_sql(staged)])
