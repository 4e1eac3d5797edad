"""The steps a configuration may name."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame

from ..operators import cleaning, enrich

log = logging.getLogger(__name__)

Step = Callable[..., DataFrame]

CLEANING_STEPS: Mapping[str, Step] = {
    step.__name__: step
    for step in (
        cleaning.remove_duplicates,
        cleaning.impute_nulls,
        cleaning.drop_nulls,
        cleaning.impute_missing_values,
        cleaning.remove_decimal,
        cleaning.standardize_date_format,
        cleaning.clean_phone_numbers,
        cleaning.handle_negative_values,
        cleaning.remove_string_from_columns,
        cleaning.validate_emails,
        cleaning.convert_column_type,
    )
}

TRANSFORM_STEPS: Mapping[str, Step] = {
    step.__name__: step for step in (enrich.add_age_column, enrich.add_state_columns)
}


def apply_step(
    df: DataFrame,
    step: Step,
    params: Mapping[str, Any],
    keep_input_if_empty: bool = False,
) -> DataFrame:
    """``step(df, **params)``; no job is started.

    ``keep_input_if_empty`` gives the input back when the step leaves no rows,
    which takes a job to find out.
    """
    result = df.transform(step, **params)
    if keep_input_if_empty and result.isEmpty():
        log.warning("step %s left no rows and is not applied", step.__name__)
        return df
    return result


def find_step(steps: Mapping[str, Step], name: str, on_unknown: str) -> Step | None:
    if name in steps:
        return steps[name]
    if on_unknown == "warn":
        log.warning("step %s is not known and is skipped", name)
        return None
    raise ValueError(f"unknown step {name!r}; known are {sorted(steps)}")
