"""A table of Parquet files that an upsert rewrites only where it must.

A folder holds data files, which are never changed, and manifests, one per version,
which name the files the table consists of. An upsert looks up which files hold keys of
the source, reading the key columns alone, writes those anew without the replaced rows,
and commits a manifest of the files that stay and the new ones. A manifest is one file,
put in place when its job commits: readers see the old version or the new one, and a run
that dies before leaves files that no manifest names. Two writers of one version cannot
both succeed: the second one finds the version taken.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import named, require_columns, type_of
from ..operators.upsert import any_null, unique_by_key
from ..saving import saved
from ..sources.files import list_files

#: Types whose smallest and largest key let the reader skip row groups.
RANGED = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.DecimalType)


@dataclass(frozen=True)
class Upserted:
    """The version that was committed, and how many files were kept, replaced and added."""

    version: int
    kept: int
    replaced: int
    added: int


class FileTable:
    """The table below ``path``, which any file system of the session can hold."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        """All committed versions, ascending."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        paths = listed.load(f"{self.path}/manifest").select("path")
        found = F.regexp_extract("path", r"/version-(\d+)/[^/]*$", 1)
        rows = paths.select(found.cast("int").alias("v")).distinct().orderBy("v").collect()
        return [r["v"] for r in rows]

    def files(self, version: int | None = None) -> list[str]:
        """The data files of a version, the last one by default: one path per file."""
        version = self.versions()[-1] if version is None else version
        rows = self.spark.read.parquet(self._manifest(version)).orderBy("file").collect()
        return [f"{self.path}/{r['file']}" for r in rows]

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one by default."""
        return self.spark.read.parquet(*self.files(version))

    def create(self, df: DataFrame, sort_by: Sequence[str] = ()) -> int:
        """Write the first version; ``sort_by`` deals rows out by ranges of these columns.

        Keys that lie close together then share files, and an upsert that touches few of
        them rewrites few files.
        """
        if sort_by:
            columns = [named(c) for c in sort_by]
            df = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
        return self._commit(1, [], self._write(df))

    def upsert(self, source: DataFrame, keys: Sequence[str]) -> Upserted:
        """Replace rows of the same key by the source's, add its other rows.

        As in ``upsert_by_key``, source rows are made unique by key, a null in the key
        matches nothing, and such rows of both sides stay. Columns go by name and keep
        the table's types.
        """
        if not keys:
            raise ValueError("an upsert needs at least one key column")
        version = self.versions()[-1]
        files = self.files(version)
        target = self.spark.read.parquet(*files)
        require_columns(target, [*keys, *source.columns])
        require_columns(source, [*keys, *target.columns])
        columns = [named(c) for c in target.columns]
        typed = [named(c).cast(type_of(target, c)).alias(c) for c in target.columns]
        new = saved(unique_by_key(source, keys).select(*typed), "source")
        replacing = new.where(~any_null(keys)).select(*[named(k) for k in keys])
        touched = self._touched(target, replacing, keys)
        changed = [f for f in files if _plain(f) in touched]
        rows = new
        if changed:
            old = self.spark.read.parquet(*changed)
            matched = old.where(~any_null(keys)).join(replacing, list(keys), "left_anti")
            rows = matched.select(*columns).unionByName(old.where(any_null(keys)))
            rows = rows.unionByName(new)
        added = self._write(rows)
        kept = [f for f in files if _plain(f) not in touched]
        self._commit(version + 1, kept, added)
        return Upserted(version + 1, len(kept), len(changed), len(added))

    def _touched(self, target: DataFrame, replacing: DataFrame, keys: Sequence[str]) -> set[str]:
        """Files with a key of the source; the driver gets a path per file."""
        path = F.col("_metadata.file_path").alias("_file")
        held = target.where(self._within(target, replacing, keys)).select(
            *[named(k) for k in keys], path
        )
        found = held.join(replacing, list(keys), "left_semi").select("_file").distinct()
        return {_plain(r["_file"]) for r in found.collect()}

    def _within(self, target: DataFrame, replacing: DataFrame, keys: Sequence[str]) -> Column:
        """The range of the source's keys as a filter that reaches the Parquet reader."""
        ranged = [k for k in keys if isinstance(type_of(target, k), RANGED)]
        if not ranged:
            return F.lit(True)
        ends = replacing.agg(
            *(f(named(k)).alias(f"{n}{i}") for i, k in enumerate(ranged) for n, f in BOUNDS)
        ).first()
        test = F.lit(True)
        for i, k in enumerate(ranged):
            if ends[f"least{i}"] is None:
                return F.lit(False)
            kind = type_of(target, k)
            least, most = (F.lit(ends[f"{n}{i}"]).cast(kind) for n, _ in BOUNDS)
            test = test & named(k).between(least, most)
        return test

    def _write(self, df: DataFrame) -> list[str]:
        """Write rows to a new folder and return its files, relative to the table."""
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        written = list_files(self.spark, f"{self.path}/{folder}").where("length > 0")
        name = F.regexp_extract("path", r"[^/]+$", 0)
        return [f"{folder}/{r['name']}" for r in written.select(name.alias("name")).collect()]

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifest/version-{version}"

    def _commit(self, version: int, kept: list[str], added: list[str]) -> int:
        within = [f.removeprefix(f"{self.path}/") for f in kept]
        rows = [(f,) for f in [*within, *added]]
        manifest = self.spark.createDataFrame(rows, "file string").coalesce(1)
        manifest.write.mode("errorifexists").parquet(self._manifest(version))
        return version


BOUNDS = (("least", F.min), ("most", F.max))


def _plain(path: str) -> str:
    """A path as listings and metadata both spell it, without its scheme and slashes."""
    return path.split(":", 1)[-1].lstrip("/") if ":" in path.split("/", 1)[0] else path.lstrip("/")
