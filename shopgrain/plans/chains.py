"""Run configured cleaning and enrichment chains.

A configuration maps table name to step name to parameters, as read from YAML by
the caller. Steps run in the order given: the order is part of the meaning. The
whole chain of a table stays one lazy plan.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cleaning import drop_nulls, split_nulls
from ..operators.quality import profile_changes, profile_summary, profile_tables
from ..sinks.archive import archive_path, write_archive
from .saving import saved, saved_and_counted
from .steps import CLEANING_STEPS, TRANSFORM_STEPS, Step, apply_step, find_step

log = logging.getLogger(__name__)

Config = Mapping[str, Mapping[str, Any]]


@dataclass(frozen=True)
class Rejected:
    """Rows a ``drop_nulls`` step took out, and where they are to be archived."""

    rows: DataFrame
    path: str | None


@dataclass(frozen=True)
class CleaningResult:
    """Cleaned tables with what is needed to report on the cleaning; all lazy.

    Profiles and rejected rows are written to the working folder when first asked for,
    so that reports and archives do not run the chains again.
    """

    source: Mapping[str, DataFrame]
    tables: dict[str, DataFrame]
    rejected: dict[str, list[Rejected]]

    @cached_property
    def _profiles(self) -> DataFrame:
        """Both profiles, written by one job: its stages share what the sides have in common."""
        sides = [
            profile_tables(tables).withColumn("after", F.lit(after))
            for tables, after in ((self.source, False), (self.tables, True))
        ]
        return saved(sides[0].unionByName(sides[1]), "profiles")

    @property
    def profile_before(self) -> DataFrame:
        return self._profiles.where("NOT after").drop("after")

    @property
    def profile_after(self) -> DataFrame:
        return self._profiles.where("after").drop("after")

    @cached_property
    def changes(self) -> DataFrame:
        """Null counts, negative counts and types that cleaning changed."""
        return profile_changes(self.profile_before, self.profile_after)

    @cached_property
    def summary(self) -> DataFrame:
        """Rows, columns and duplicates per table before and after."""
        return profile_summary(self.profile_before, self.profile_after)

    def write_rejected(self, single_file: bool = False) -> list[str]:
        """Write every configured archive that has rows; returns the paths."""
        written = []
        for parts in self.rejected.values():
            for part in parts:
                if part.path is None:
                    continue
                rows, n = saved_and_counted(part.rows, "rejected")
                if n:
                    write_archive(rows, part.path, single_file)
                    written.append(part.path)
        return written


def run_cleaning(
    dataset: Mapping[str, DataFrame],
    config: Config,
    on_unknown: str = "raise",
    keep_input_if_empty: bool = False,
    save: bool = False,
) -> CleaningResult:
    """Apply each table's cleaning steps; tables without steps pass through.

    ``save`` writes each cleaned table to the folder that ``spark.checkpoint.dir``
    names and goes on from there, so that the profile, the enrichment and the load
    do not each repeat the chain.
    """
    tables: dict[str, DataFrame] = {}
    rejected: dict[str, list[Rejected]] = {}
    for name, df in dataset.items():
        parts: list[Rejected] = []
        for step, params in _steps(config.get(name), CLEANING_STEPS, on_unknown):
            if step is drop_nulls:
                parts.append(Rejected(*_archived(df, **params)))
            df = apply_step(df, step, params, keep_input_if_empty)
        tables[name] = saved(df, name) if save else df
        rejected[name] = parts
    return CleaningResult(dict(dataset), tables, rejected)


def _archived(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    archive_folder: str | None = None,
    archive_df_name: str | None = None,
) -> tuple[DataFrame, str | None]:
    _, rows = split_nulls(df, columns)
    if archive_folder and archive_df_name:
        return rows, archive_path(archive_folder, archive_df_name)
    return rows, None


def run_transforms(
    dataset: Mapping[str, DataFrame], config: Config, on_unknown: str = "raise"
) -> dict[str, DataFrame]:
    """Apply each table's enrichment steps; tables without steps pass through."""
    tables = {}
    for name, df in dataset.items():
        for step, params in _steps(config.get(name), TRANSFORM_STEPS, on_unknown):
            df = apply_step(df, step, params)
        tables[name] = df
    return tables


def _steps(
    steps: Mapping[str, Any] | None, known: Mapping[str, Step], on_unknown: str
) -> list[tuple[Step, Mapping[str, Any]]]:
    """(step, parameters) in order; a list of parameters repeats its step."""
    if on_unknown not in ("raise", "warn"):
        raise ValueError(f"on_unknown must be 'raise' or 'warn', not {on_unknown!r}")
    calls = []
    for name, given in (steps or {}).items():
        step = find_step(known, name, on_unknown)
        if step is None:
            continue
        for params in given if isinstance(given, list) else [given]:
            if params:
                calls.append((step, params))
            else:
                log.warning("step %s has no parameters and is skipped", name)
    return calls
