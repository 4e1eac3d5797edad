"""Profiles, their comparison, and keyed upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopgrain import operators as op
from shopgrain.plans import run_cleaning
from shopgrain.plans.saving import new_folder
from shopgrain.sinks import FileTable

from .cleaning import (
    CLEANING,
    CUSTOMER_SQL,
    columns_of,
    raw_table,
    repeated_sql,
)
from .registry import query
from .views import table, view

RAW_TYPES = {
    "customer_id": "double",
    "first_name": "string",
    "last_name": "string",
    "email": "string",
    "phone_number": "string",
    "birth_date": "string",
    "zip_code": "double",
    "balance": "decimal(12,2)",
    "nation": "int",
}
CLEAN_TYPES = {
    **RAW_TYPES,
    "customer_id": "bigint",
    "zip_code": "string",
    "birth_date": "date",
}
REVIEW_TYPES = {
    "review_id": "bigint",
    "product_id": "bigint",
    "customer_id": "bigint",
    "rating": "bigint",
    "review_text": "string",
    "review_date": "string",
}
NUMERIC = ("double", "int", "bigint", "decimal(12,2)")


def profile_sql(
    name: str, source: str, types: dict[str, str], counted: tuple[str, ...] = NUMERIC
) -> str:
    """One row per column, computed column by column."""
    columns = ", ".join(types)
    duplicates = f"""(SELECT count(*) FROM {source}) -
        (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source}))"""
    rows = []
    for column, dtype in types.items():
        negatives = f"count(*) FILTER (WHERE {column} < 0)" if dtype in counted else "0"
        rows.append(
            f"""SELECT '{name}' AS table_name, '{column}' AS column_name,
            count(*) FILTER (WHERE {column} IS NULL
            OR CAST({column} AS VARCHAR) = 'null') AS null_count,
            CAST({negatives} AS BIGINT) AS negative_count, '{dtype}' AS data_type,
            count(*) AS row_count, {len(types)} AS column_count,
            {duplicates} AS duplicate_count FROM {source}"""
        )
    return " UNION ALL ".join(rows)


def _profiled(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    reviews = view(spark, d, "raw_review")
    return {"customer": raw_table(spark, d, "customer"), "review": reviews}


REVIEW_SOURCE = """(SELECT review_id, product_id, customer_id,
    CAST(rating AS BIGINT) AS rating, review_text, review_date FROM raw_review)"""


def _profiles_sql(counted: tuple[str, ...] = NUMERIC) -> str:
    customers = profile_sql("customer", repeated_sql("customer"), RAW_TYPES, counted)
    reviews = profile_sql("review", REVIEW_SOURCE, REVIEW_TYPES, counted)
    return f"{customers} UNION ALL {reviews}"


@query("q01_profile_tables", _profiles_sql())
def q01(spark, d):
    return op.profile_tables(_profiled(spark, d))


@query("q02_profile_counted_types", _profiles_sql(("int", "double")))
def q02(spark, d):
    return op.profile_tables(_profiled(spark, d), reference_types=True)


@query(
    "q03_duplicate_count",
    """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber
    FROM lineitem)) AS duplicate_count FROM lineitem""",
)
def q03(spark, d):
    return op.duplicate_count(
        table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    )


BEFORE_SQL = profile_sql("customer", repeated_sql("customer"), RAW_TYPES)
AFTER_SQL = profile_sql("customer", f"({CUSTOMER_SQL})", CLEAN_TYPES)


def _metric_sql(name: str, field: str, absent: str) -> str:
    return f"""SELECT table_name, column_name, '{name}' AS metric,
        coalesce(CAST(b.{field} AS VARCHAR), '{absent}') AS before,
        coalesce(CAST(a.{field} AS VARCHAR), '{absent}') AS after
    FROM before_profile b FULL JOIN after_profile a USING (table_name, column_name)"""


PROFILES = f"WITH before_profile AS ({BEFORE_SQL}), after_profile AS ({AFTER_SQL})"


@query(
    "q04_profile_changes",
    f"""{PROFILES} SELECT * FROM ({_metric_sql('Null Count', 'null_count', '0')}
    UNION ALL {_metric_sql('Negative Count', 'negative_count', '0')}
    UNION ALL {_metric_sql('Data Type Change', 'data_type', '')})
    WHERE before <> after""",
)
def q04(spark, d):
    customers = {"customer": raw_table(spark, d, "customer")}
    return run_cleaning(customers, CLEANING).changes


@query(
    "q05_profile_summary",
    f"""{PROFILES}, b AS (SELECT DISTINCT table_name, row_count, column_count,
    duplicate_count FROM before_profile), a AS (SELECT DISTINCT table_name, row_count,
    column_count, duplicate_count FROM after_profile)
    SELECT table_name, b.row_count AS row_count_before,
    b.column_count AS column_count_before, b.duplicate_count AS duplicate_count_before,
    a.row_count AS row_count_after, a.column_count AS column_count_after,
    a.duplicate_count AS duplicate_count_after FROM b JOIN a USING (table_name)""",
)
def q05(spark, d):
    customers = {"customer": raw_table(spark, d, "customer")}
    return run_cleaning(customers, CLEANING).summary


DOCUMENT_TYPES = {"text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


@query("q01b_profile_wide_rows", profile_sql("documents", "documents", DOCUMENT_TYPES))
def q01b(spark, d):
    documents = table(spark, d, "documents").select(*DOCUMENT_TYPES)
    return op.profile_table(documents, "documents", by_digest=True)


@query(
    "q03b_duplicate_count_wide_rows",
    """SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM
        (SELECT DISTINCT text, lang FROM documents)) AS duplicate_count""",
)
def q03b(spark, d):
    return op.duplicate_count(table(spark, d, "documents").select("text", "lang"), by_digest=True)


@query(
    "k09_upsert_by_key",
    """WITH source AS (SELECT order_id, min(total) AS total FROM (SELECT
        l_orderkey * 2 AS order_id, l_extendedprice AS total FROM lineitem)
        GROUP BY order_id)
    SELECT order_id, total FROM source UNION ALL
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey NOT IN (SELECT order_id FROM source)""",
)
def k09(spark, d):
    target = table(spark, d, "orders").selectExpr(
        "o_orderkey AS order_id", "o_totalprice AS total"
    )
    source = table(spark, d, "lineitem").selectExpr(
        "l_orderkey * 2 AS order_id", "l_extendedprice AS total"
    )
    return op.upsert_by_key(target, source, ["order_id"])


@query(
    "k09b_upsert_null_keys",
    """WITH source AS (SELECT CASE WHEN l_orderkey % 10 = 0 THEN NULL
        ELSE l_orderkey * 2 END AS order_id, l_extendedprice AS total FROM lineitem),
    target AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END
        AS order_id, o_totalprice AS total FROM orders)
    SELECT order_id, min(total) AS total FROM source WHERE order_id IS NOT NULL
    GROUP BY order_id UNION ALL
    SELECT * FROM source WHERE order_id IS NULL UNION ALL
    SELECT * FROM target WHERE order_id IS NULL UNION ALL
    SELECT * FROM target WHERE order_id IS NOT NULL AND order_id NOT IN
        (SELECT order_id FROM source WHERE order_id IS NOT NULL)""",
)
def k09b(spark, d):
    """Rows without a key match nothing and all stay."""
    target = table(spark, d, "orders").selectExpr(
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS order_id",
        "o_totalprice AS total",
    )
    source = table(spark, d, "lineitem").selectExpr(
        "CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_orderkey * 2 END AS order_id",
        "l_extendedprice AS total",
    )
    return op.upsert_by_key(target, source, ["order_id"])


@query(
    "k09c_upsert_files",
    """WITH source AS (SELECT order_id, min(total) AS total FROM (SELECT
        l_orderkey * 2 AS order_id, l_extendedprice AS total FROM lineitem)
        GROUP BY order_id)
    SELECT order_id, total FROM source UNION ALL
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey NOT IN (SELECT order_id FROM source)""",
)
def k09c(spark, d):
    """Orders as a table of files; the upsert rewrites the files that hold its keys."""
    orders = FileTable(spark, new_folder(spark))
    orders.create(
        table(spark, d, "orders").selectExpr("o_orderkey AS order_id", "o_totalprice AS total"),
        sort_by=["order_id"],
    )
    source = table(spark, d, "lineitem").selectExpr(
        "l_orderkey * 2 AS order_id", "l_extendedprice AS total"
    )
    orders.upsert(source, ["order_id"])
    return orders.read()


# Every column of the raw view is typed above.
assert columns_of("raw_customer") == list(RAW_TYPES)
