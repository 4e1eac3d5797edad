"""CSV archives of the rows that cleaning rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame


def archive_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/df_{name}_removed.csv"


def write_archive(rejected: DataFrame, path: str, single_file: bool = False) -> None:
    """Write rejected rows with a header, replacing an earlier archive.

    Every task writes its own part; ``single_file`` forces one part and so one
    task, and is only for small archives.
    """
    if single_file:
        rejected = rejected.coalesce(1)
    rejected.write.mode("overwrite").option("header", True).csv(path)
