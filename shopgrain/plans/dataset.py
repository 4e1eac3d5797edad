"""Datasets: tables by name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def select_tables(
    dataset: Mapping[str, DataFrame], names: Iterable[str], prefix: str = ""
) -> dict[str, DataFrame]:
    """The tables called ``prefix + name``, by name and in the order of ``names``."""
    names = list(names)
    missing = [prefix + n for n in names if prefix + n not in dataset]
    if missing:
        raise ValueError(f"tables {missing} are not among {sorted(dataset)}")
    return {n: dataset[prefix + n] for n in names}
