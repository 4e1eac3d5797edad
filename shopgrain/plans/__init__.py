"""Configured chains of steps over whole datasets."""

from .chains import CleaningResult, Rejected, run_cleaning, run_transforms
from .dataset import select_tables
from .steps import CLEANING_STEPS, TRANSFORM_STEPS, apply_step

__all__ = [
    "CLEANING_STEPS",
    "TRANSFORM_STEPS",
    "CleaningResult",
    "Rejected",
    "apply_step",
    "run_cleaning",
    "run_transforms",
    "select_tables",
]
