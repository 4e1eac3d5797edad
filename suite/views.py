"""Retail tables derived from the given ones.

One list of SQL expressions per table serves both engines: Spark evaluates it with
``selectExpr``, the SQL side gets it as a common table expression.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

AS_OF = date(2024, 6, 30)

VIEWS: dict[str, tuple[str, list[str]]] = {
    "shop_product": (
        "part",
        [
            "p_partkey AS product_id",
            "p_name AS product_name",
            "p_type AS category",
            "CAST(p_retailprice AS DECIMAL(12,2)) AS price",
            "CAST((p_partkey * 7) % 160 AS INT) AS inventory",
        ],
    ),
    "shop_order_item": (
        "lineitem",
        [
            "l_orderkey * 8 + l_linenumber AS order_item_id",
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "CAST(l_quantity AS INT) AS quantity",
            "CAST(floor(l_extendedprice / l_quantity) AS DECIMAL(12,2)) AS price",
        ],
    ),
    "shop_orders": (
        "orders",
        [
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "CAST(o_orderdate AS DATE) AS order_date",
            "o_totalprice AS total_amount",
            "CAST(o_orderkey AS STRING) || ' Main St, Town, ' || "
            "CASE o_custkey % 4 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'ZZ' "
            "ELSE 'tx' END || ' 12345' AS shipping_address",
            "CASE WHEN o_custkey % 9 = 0 THEN NULL "
            "WHEN o_custkey % 9 = 1 THEN 'PO Box 1, Reno, NV 89501' "
            "ELSE 'Unit 5, Reno, NV 89501' END AS billing_address",
        ],
    ),
    "shop_customer": (
        "customer",
        [
            "c_custkey AS customer_id",
            "c_name AS first_name",
            "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS last_name",
            "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE DATE '1940-01-01' + "
            "CAST((c_custkey * 37) % 25000 AS INT) END AS birth_date",
        ],
    ),
    "shop_review": (
        "events",
        [
            "event_id AS review_id",
            "event_id % 200 AS product_id",
            "user_id AS customer_id",
            "CAST(CASE WHEN value >= 100 THEN 5 ELSE floor(value / 20) END AS INT) "
            "AS rating",
            "CAST(ts AS DATE) AS review_date",
        ],
    ),
    "raw_customer": (
        "customer",
        [
            "CAST(c_custkey AS DOUBLE) + 0.25 AS customer_id",
            "CASE c_custkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN NULL ELSE c_name END "
            "AS first_name",
            "CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'None' ELSE c_mktsegment END "
            "AS last_name",
            "CASE c_custkey % 5 WHEN 0 THEN 'nobody.example.com' WHEN 1 THEN NULL "
            "WHEN 2 THEN 'a@b' ELSE 'user' || CAST(c_custkey AS STRING) || "
            "'@example.com' END AS email",
            "CASE c_custkey % 8 WHEN 0 THEN 'Not Available' WHEN 1 THEN NULL "
            "WHEN 2 THEN '(212) 555-' || "
            "lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') "
            "WHEN 3 THEN '1-212-555-' || "
            "lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') || 'x45' "
            "WHEN 4 THEN '001-212-555-0123' WHEN 5 THEN '001-212-555-012' "
            "WHEN 6 THEN '555-0123' ELSE '212.555.0123 ext 7' END AS phone_number",
            "CASE c_custkey % 6 WHEN 0 THEN "
            "lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') || '/0' || "
            "CAST(c_custkey % 9 + 1 AS STRING) || '/1980' "
            "WHEN 1 THEN '1980-0' || CAST(c_custkey % 9 + 1 AS STRING) || '-15' "
            "WHEN 2 THEN '12/25/1980' WHEN 3 THEN '05-Jan-1980' "
            "WHEN 4 THEN 'yesterday' ELSE NULL END AS birth_date",
            "CAST(CASE WHEN c_custkey % 7 = 3 THEN NULL WHEN c_custkey % 3 = 0 "
            "THEN -c_custkey ELSE c_custkey END AS DOUBLE) AS zip_code",
            "CAST(CASE WHEN c_custkey % 10 = 4 THEN NULL ELSE c_acctbal END "
            "AS DECIMAL(12,2)) AS balance",
            "CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE c_nationkey END AS nation",
        ],
    ),
    "raw_order": (
        "orders",
        [
            "CAST(o_orderkey AS DOUBLE) + 0.5 AS order_id",
            "CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE "
            "CAST(o_custkey AS DOUBLE) + 0.75 END AS customer_id",
            "CASE o_orderkey % 3 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) "
            "WHEN 1 THEN '17.03.1999' ELSE 'soon' END AS order_date",
            "CASE WHEN o_orderkey % 5 = 0 THEN -o_totalprice ELSE o_totalprice END "
            "AS total_amount",
            "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE '1 Main St' || chr(10) || "
            "'Reno, NV' END AS shipping_address",
            "CASE WHEN o_orderkey % 4 = 0 THEN 'null' ELSE "
            "'Unit 5' || chr(10) || 'Miami, FL' || chr(10) END AS billing_address",
        ],
    ),
    "raw_product": (
        "part",
        [
            "CAST(-p_partkey AS DOUBLE) AS product_id",
            "CASE WHEN p_partkey % 9 = 0 THEN 'null' ELSE p_name END AS product_name",
            "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS category",
            "p_brand || chr(10) || p_type AS description",
            "CASE WHEN p_partkey % 4 = 0 THEN -p_retailprice ELSE p_retailprice END "
            "AS price",
            "CAST((p_partkey * 7) % 160 AS DOUBLE) + 0.9 AS inventory",
        ],
    ),
    "raw_order_item": (
        "lineitem",
        [
            "-(l_orderkey * 8 + l_linenumber) AS order_item_id",
            "l_orderkey AS order_id",
            "CASE WHEN l_partkey % 3 = 0 THEN -l_partkey ELSE l_partkey END "
            "AS product_id",
            "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE -l_quantity END AS quantity",
            "l_extendedprice AS price",
        ],
    ),
    "raw_document": (
        "documents",
        [
            "doc_id",
            "CASE WHEN doc_id % 7 = 3 THEN NULL ELSE lang END AS lang",
            "CASE WHEN doc_id % 5 = 1 THEN NULL ELSE source END AS source",
            "CASE WHEN doc_id % 9 = 2 THEN NULL ELSE n_chars END AS n_chars",
            "CASE WHEN doc_id % 11 = 4 THEN NULL ELSE text END AS text",
        ],
    ),
    "raw_review": (
        "events",
        [
            "CASE WHEN event_id % 50 = 7 THEN NULL ELSE event_id END AS review_id",
            "-(event_id % 200) AS product_id",
            "user_id AS customer_id",
            "floor(value / 20) AS rating",
            "CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'fine' || chr(10) || "
            "event_type ELSE 'null' END AS review_text",
            "CASE event_id % 4 WHEN 0 THEN CAST(CAST(ts AS DATE) AS STRING) "
            "WHEN 1 THEN '31/12/2020' WHEN 2 THEN NULL ELSE 'n/a' END AS review_date",
        ],
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived retail table."""
    source, expressions = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*expressions)


def sql(body: str) -> str:
    """``body`` after common table expressions for the views it mentions."""
    used = [n for n in VIEWS if n in body]
    ctes = [f"{n} AS (SELECT {', '.join(VIEWS[n][1])} FROM {VIEWS[n][0]})" for n in used]
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(ctes)}, {body[5:]}"
    return f"WITH {', '.join(ctes)} {body}"
