"""Cut a long plan by writing its result to the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session's settings name it.

    Where no checkpoint folder is set, the session's own warehouse folder serves, unless
    it is a folder of the driver's machine that the executors of a cluster do not see.
    """
    context = spark.sparkContext
    folder = context.getConf().get(SETTING) or context.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if not context.master.startswith("local") and folder.startswith(("file:", "/")):
            raise ValueError(f"{folder} is local to the driver: set {SETTING}")
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A new folder for working files, below one that can be removed per application."""
    return f"{_working_folder(spark)}/{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Remove all working files of this application; what was read from them is gone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_working_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _working_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/shopgrain-{spark.sparkContext.applicationId}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    The copy survives lost executors, and readers of it skip unused columns.
    """
    spark = df.sparkSession
    path = f"{new_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def saved_and_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As ``saved``, with the number of rows, observed while they are written."""
    seen = Observation()
    copy = saved(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return copy, seen.get.get("rows", 0)
