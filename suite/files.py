"""File sources and sinks: whole tables written in a format and loaded back."""

from __future__ import annotations

import io
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.plans import run_cleaning, select_tables
from shopgrain.plans.saving import new_folder
from shopgrain.sinks import create_table
from shopgrain.sources import (
    flatten_arrays,
    list_files,
    load_dataset,
    load_file,
    sheet_columns,
    sheet_table,
    workbook_cells,
)

from .cleaning import BLANKED
from .registry import query
from .views import table, view
from .workbooks import write_workbook


CUSTOMERS = """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, c_acctbal,
    c_mktsegment FROM customer"""


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )


@query("s02_load_folder", CUSTOMERS)
def s02(spark, d):
    """The given folder, every file of it a table."""
    return load_dataset(spark, d).tables["df_customer"].select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )


@query("s02b_load_formats", CUSTOMERS)
def s02b(spark, d):
    """A folder of three formats; each row comes from the format of its columns."""
    folder, customers = new_folder(spark), _customers(spark, d)
    customers.select("c_custkey", "c_name").write.parquet(f"{folder}/names.parquet")
    customers.select("c_custkey", "c_acctbal").write.json(f"{folder}/balances.json")
    customers.select("c_custkey", "c_mktsegment").write.csv(
        f"{folder}/segments.csv", header=True
    )
    loaded = load_dataset(spark, folder, multiline=False).tables
    return (
        loaded["df_names"]
        .join(loaded["df_balances"], "c_custkey")
        .join(loaded["df_segments"], "c_custkey")
    )


@query("s09_skip_empty_and_select", CUSTOMERS)
def s09(spark, d):
    """An empty table is left out, the others are picked by name without a prefix."""
    folder, customers = new_folder(spark), _customers(spark, d)
    customers.write.parquet(f"{folder}/data_customer.parquet")
    customers.limit(0).write.parquet(f"{folder}/data_empty.parquet")
    loaded = load_dataset(spark, folder).tables
    names = [n.removeprefix("df_data_") for n in loaded]
    return select_tables(loaded, names, "df_data_")["customer"]


@query(
    "s05b_multiline_json",
    """SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name, n_name
    FROM region JOIN nation ON n_regionkey = r_regionkey""",
)
def s05b(spark, d):
    """One document per region over many lines, its nations in an array."""
    folder = new_folder(spark)
    nations = (
        table(spark, d, "nation")
        .groupBy("n_regionkey")
        .agg(F.collect_list(F.struct("n_name")).alias("nations"))
    )
    documents = table(spark, d, "region").join(
        nations, F.col("n_regionkey") == F.col("r_regionkey")
    )
    pretty = F.to_json(F.struct("r_regionkey", "r_name", "nations"), {"pretty": "true"})
    written = documents.select(pretty.alias("value"))
    written.write.option("maxRecordsPerFile", 1).text(f"{folder}/regions.json")
    loaded = load_dataset(spark, folder).tables["df_regions"]
    return loaded.select("r_regionkey", "r_name", F.explode("nations.n_name").alias("n_name"))


@query(
    "s04_csv_scan",
    """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_acctbal, c_mktsegment
    FROM customer""",
)
def s04(spark, d):
    folder = new_folder(spark)
    _customers(spark, d).write.csv(f"{folder}/customers.csv", header=True)
    return load_dataset(spark, folder).tables["df_customers"]


@query("s04b_csv_scan_with_schema", CUSTOMERS)
def s04b(spark, d):
    folder, customers = new_folder(spark), _customers(spark, d)
    customers.write.csv(f"{folder}/customers.csv", header=True)
    schemas = {"df_customers": customers.schema}
    return load_dataset(spark, folder, schemas).tables["df_customers"]


@query("s05_json_scan", CUSTOMERS)
def s05(spark, d):
    folder = new_folder(spark)
    _customers(spark, d).write.json(f"{folder}/customers.json")
    loaded = load_dataset(spark, folder, multiline=False).tables["df_customers"]
    return loaded.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query(
    "s06_flatten_struct_arrays",
    """SELECT event_id AS id, event_type AS kind, value AS amount FROM events
    UNION ALL SELECT user_id, 'user', 0.0 FROM events""",
)
def s06(spark, d):
    nested = table(spark, d, "events").selectExpr(
        "array(struct(event_id AS id, event_type AS kind, value AS amount), "
        "struct(user_id AS id, 'user' AS kind, 0D AS amount)) AS entries"
    )
    return flatten_arrays(nested, "entries")


@query("s06b_flatten_scalar_arrays", "SELECT unnest(embedding) AS value FROM embeddings")
def s06b(spark, d):
    return flatten_arrays(table(spark, d, "embeddings"), "embedding")


@query("s08_workbook_scan", CUSTOMERS)
def s08(spark, d):
    """Customers packed into workbooks by tasks, a sheet per batch, and read back."""

    def pack(batches):
        for batch in batches:
            rows = batch.astype(object).values.tolist()
            if not rows:
                continue
            content = io.BytesIO()
            write_workbook(content, {"customers": [list(batch.columns), *rows]})
            path = f"{rows[0][0]}.xlsx"
            yield pd.DataFrame({"path": [path], "content": [content.getvalue()]})

    customers = _customers(spark, d)
    books = customers.mapInPandas(pack, "path string, content binary")
    cells = workbook_cells(books, "customers")
    return sheet_table(cells, sheet_columns(cells)["customers"])


@query("s07_parquet_scan", CUSTOMERS)
def s07(spark, d):
    return load_file(spark, f"{d}/customer.parquet")["df_customer"].select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )


LISTED = (
    *("customer", "orders", "part", "lineitem", "events", "supplier", "nation", "region"),
    *("documents", "embeddings", "pages", "benchmark", "labels", "conversations"),
)


@query(
    "s01_list_files",
    " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in LISTED),
)
def s01(spark, d):
    """Rows of each table, by joining the listing with the files that rows come from.

    A file that the listing lacks shows as rows without a path, a file without rows as none.
    """

    def plain(path):
        return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")

    table_of = F.regexp_extract("path", r"([^/]+)\.parquet(/[^/]*)?$", 1)
    listed = list_files(spark, d).where("length > 0").select(plain("path").alias("path"))
    rows = [
        table(spark, d, t).select(plain("_metadata.file_path").alias("path")) for t in LISTED
    ]
    counts = reduce(DataFrame.unionByName, rows).groupBy("path").agg(F.count("*").alias("n"))
    found = listed.withColumn("name", table_of).join(counts, "path", "full")
    return found.groupBy("name").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


ARCHIVED = """SELECT customer_id, first_name, last_name FROM ({blanked}
    FROM raw_customer) WHERE last_name IS NULL"""


@query("k01b_archive_rejected_rows", ARCHIVED.format(blanked=BLANKED))
def k01b(spark, d):
    folder = new_folder(spark)
    raw = view(spark, d, "raw_customer")
    archive = {"archive_folder": folder, "archive_df_name": "customer"}
    config = {"customer": {"drop_nulls": {"columns": ["last_name"], **archive}}}
    (path,) = run_cleaning({"customer": raw}, config).write_rejected()
    archived = spark.read.csv(path, header=True, schema=raw.schema)
    return archived.select("customer_id", "first_name", "last_name")


@query("k05_create_table", CUSTOMERS)
def k05(spark, d):
    path = new_folder(spark)
    create_table(_customers(spark, d), path, "parquet", {}, table_option="path")
    return spark.read.parquet(path)
