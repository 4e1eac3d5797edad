"""Registered queries over the given tables, each with its SQL counterpart."""

from . import analytics, cleaning, files, quality
from .registry import REGISTRY

flagship = cleaning.flagship

__all__ = ["REGISTRY", "analytics", "cleaning", "files", "flagship", "quality"]
