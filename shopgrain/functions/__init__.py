"""Column-level building blocks; usable in any ``select`` or ``withColumn``."""

from .bands import age_band, age_in_years
from .columns import is_missing, named, numeric, require_columns
from .contact import clean_phone, valid_email
from .dates import parse_date, year_range
from .states import US_STATES, state_code

__all__ = [
    "US_STATES",
    "age_band",
    "age_in_years",
    "clean_phone",
    "is_missing",
    "named",
    "numeric",
    "parse_date",
    "require_columns",
    "state_code",
    "valid_email",
    "year_range",
]
