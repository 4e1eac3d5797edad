"""Upsert a DataFrame into a database table over JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import require_columns
from ..operators.upsert import unique_by_key
from ..sources.jdbc import table_exists
from .dialects import Dialect

RunSql = Callable[[Sequence[str]], None]


def stage_name(table: str) -> str:
    """A stage table of this run alone, so concurrent loads do not collide."""
    return f"{table}_stage_{uuid.uuid4().hex[:12]}"


def write_stage(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str]
) -> None:
    """Write ``df`` as a table, each task over its own connection.

    The JDBC properties ``numPartitions`` and ``batchsize`` bound the number of
    connections and the size of an insert.
    """
    df.write.jdbc(url, table, mode="overwrite", properties=dict(properties))


def jdbc_runner(
    spark: SparkSession, url: str, properties: Mapping[str, str]
) -> RunSql:
    """Run statements in one transaction through the session's JDBC driver."""

    def run(statements: Sequence[str]) -> None:
        connection = _connect(spark, url, properties)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for sql in statements:
                statement.execute(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    return run


def _connect(spark: SparkSession, url: str, properties: Mapping[str, str]):
    """A JDBC connection; a named driver is found among the session's jars too."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, str(value))
    name = properties.get("driver")
    if name is None:
        return jvm.java.sql.DriverManager.getConnection(url, settings)
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    driver = jvm.java.lang.Class.forName(name, True, loader).newInstance()
    connection = driver.connect(url, settings)
    if connection is None:
        raise ValueError(f"driver {name} does not take the URL {url}")
    return connection


def upsert_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    keys: Sequence[str],
    dialect: Dialect,
    properties: Mapping[str, str],
    schema: str | None = None,
    run_sql: RunSql | None = None,
) -> str:
    """Insert new rows and update rows of known keys; returns what was done.

    Executors write a stage table in parallel; one statement then merges it, in
    one transaction with dropping the stage. If the merge fails the error is
    raised and the stage kept. Rows are made unique by key first; a null key is
    left for the database to refuse. ``run_sql`` replaces the JDBC connection for
    statements, e.g. by a client library.
    """
    spark = df.sparkSession
    require_columns(df, keys)
    stage = stage_name(table)
    merge = dialect.upsert_sql(table, stage, df.columns, keys)
    create = dialect.create_sql(df.schema, table, keys)
    run = run_sql or jdbc_runner(spark, url, properties)

    unique = unique_by_key(df, keys)
    existed = table_exists(spark, url, table, properties, schema)
    if not existed:
        run([create])
    write_stage(unique, url, dialect.identifier(stage), properties)
    run([merge, dialect.drop_sql(stage)])
    return "upserted" if existed else "created"
