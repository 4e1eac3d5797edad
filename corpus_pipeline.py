"""A corpus from raw documents to token ids, a stage at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopgrain.llm import stages
from shopgrain.llm.stages import STAGES

#: DuckDB has no words for the stages' models and streams; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents through all stages; each writes Parquet that the next one reads."""
    return stages.run(spark, sf_dir)


__all__ = ["ORACLE_SQL", "STAGES", "run"]
