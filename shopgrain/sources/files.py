"""Load a folder of CSV, JSON, Parquet and workbook files as named tables.

Paths are any URI the session's Hadoop file systems can read (``file:``,
``s3a:``, ...). A directory whose own name has a known extension, such as the
``orders.parquet/`` that Spark writes, is one table of many part files.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .json_arrays import array_fields, flatten_arrays
from .workbook import workbook_tables

log = logging.getLogger(__name__)

# File extensions and the prefix of table names.
READ_EXTENSIONS = ("csv", "json", "parquet", "xlsx")
NAME_PREFIX = "df_"

ERROR_SCHEMA = "path string, error string"

#: Tables that are opened at the same time.
AT_ONCE = 8


@dataclass(frozen=True)
class LoadResult:
    """Loaded tables by name, and what could not be loaded."""

    tables: dict[str, DataFrame]
    load_errors: DataFrame


def list_files(spark: SparkSession, uri: str) -> DataFrame:
    """Path, length and modification time of every file below ``uri``.

    Only the listing is read, never the contents.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(uri)
        .select("path", "length", "modificationTime")
    )


def table_name(path: str, part: str | None = None) -> str:
    """``df_<stem>`` or ``df_<stem>_<part>``; the stem ends at the first dot."""
    stem = path.rstrip("/").rsplit("/", 1)[-1].split(".")[0]
    return NAME_PREFIX + stem + (f"_{part}" if part is not None else "")


def load_dataset(
    spark: SparkSession,
    uri: str,
    schemas: Mapping[str, T.StructType | str] | None = None,
    multiline: bool = True,
    at_once: int = AT_ONCE,
) -> LoadResult:
    """Load every readable file or table directory below ``uri``.

    The small jobs that find out schemas and look for a first row run for ``at_once``
    tables at a time, each of them in parallel tasks of its own.

    Empty tables are left out. A file that cannot be read is skipped and reported
    in ``load_errors``; other extensions are ignored. Two files that give the same
    table name raise. ``schemas`` (by table name) spare the pass over CSV and JSON
    that finds out the types: name them for large files. ``multiline=False``
    reads JSON lines, which, unlike one large document, Spark can split.
    """
    sources = _table_paths(list_files(spark, uri), uri)
    if not sources:
        raise FileNotFoundError(f"no files below {uri}")

    known = [path for path in sources if _extension(path) in READ_EXTENSIONS]
    for path in sources:
        if path not in known:
            log.info("%s is not of a known format and is ignored", path)

    @inheritable_thread_target(spark)
    def load(path: str) -> dict[str, DataFrame] | Exception:
        try:
            return load_file(spark, path, schemas, multiline)
        except Exception as e:  # one bad file must not stop the others
            return e

    tables: dict[str, DataFrame] = {}
    errors: list[tuple[str, str]] = []
    with ThreadPoolExecutor(at_once) as pool:
        found = list(pool.map(load, known))
    for path, loaded in zip(known, found, strict=True):
        if isinstance(loaded, Exception):
            log.warning("%s cannot be read: %s", path, loaded)
            errors.append((path, str(loaded)))
            continue
        taken = tables.keys() & loaded.keys()
        if taken:
            raise ValueError(f"{path} gives table names already in use: {taken}")
        tables.update(loaded)
    return LoadResult(tables, spark.createDataFrame(errors, ERROR_SCHEMA))


def _table_paths(manifest: DataFrame, uri: str) -> list[str]:
    """One path per table: ``uri`` itself if it is a table directory, with its rows in
    part files; else below it the outermost name with an extension, in any case.

    Part files are folded into their directory by Spark; the driver receives one
    path per table, which it needs to name the tables.
    """
    root = re.sub(r"^[A-Za-z0-9+.-]+:/*", "/", uri).rstrip("/")
    below = F.instr("path", root) + F.lit(len(root))
    within = F.substr("path", below)
    extensions = "|".join(READ_EXTENSIONS)
    if _extension(root) in READ_EXTENSIONS:
        part = within.rlike(r"^/([^/=]+=[^/]*/)*part-[^/]*$")
        kinds = manifest.agg(F.count("*").alias("n"), F.count_if(part).alias("parts")).first()
        if kinds.n and kinds.n == kinds.parts:
            return [uri.rstrip("/")]
    directory = F.regexp_extract(within, rf"(?i)^(.*?\.(?:{extensions}))/", 1)
    table = F.when(
        directory != "",
        F.concat(F.substr("path", F.lit(1), below - 1), directory),
    ).otherwise(F.col("path"))
    rows = manifest.select(table.alias("path")).distinct().orderBy("path").collect()
    return [r["path"] for r in rows]


def _extension(path: str) -> str:
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()


def load_file(
    spark: SparkSession,
    path: str,
    schemas: Mapping[str, T.StructType | str] | None = None,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    """The non-empty tables in one file or table directory, by name."""
    kind, name = _extension(path), table_name(path)
    schema = (schemas or {}).get(name)
    if kind == "xlsx":
        tables = {
            table_name(path, sheet): df
            for sheet, df in workbook_tables(spark, path).items()
        }
    elif kind == "csv":
        tables = {name: read_csv(spark, path, schema)}
    elif kind == "json":
        tables = _json_tables(spark, path, schema, multiline)
    elif kind == "parquet":
        tables = {name: spark.read.parquet(path)}
    else:
        raise ValueError(f"{path} is not one of {READ_EXTENSIONS}")
    filled = {n: df for n, df in tables.items() if not is_empty(df)}
    for left_out in tables.keys() - filled.keys():
        log.warning("table %s is empty and is left out", left_out)
    return filled


def is_empty(df: DataFrame) -> bool:
    """Whether a table has no columns or no rows; looks for one row only."""
    return not df.columns or df.isEmpty()


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A CSV file with a header; types are inferred unless a schema is given."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.csv(path, header=True, schema=schema)


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """A JSON document (or JSON lines without ``multiline``)."""
    df = spark.read.json(path, schema=schema, multiLine=multiline)
    if df.columns == ["_corrupt_record"]:
        raise ValueError("the file holds no JSON")
    return df


def _json_tables(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None,
    multiline: bool,
) -> dict[str, DataFrame]:
    """Each array field as a table; the whole file too if it has other fields."""
    df = read_json(spark, path, schema, multiline)
    arrays = array_fields(df)
    tables = {table_name(path, f): flatten_arrays(df, f) for f in arrays}
    if len(arrays) < len(df.columns):
        tables[table_name(path)] = df
    return tables
