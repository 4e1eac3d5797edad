"""Ages and age bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) and names of the age bands.
AGE_BANDS = ((20, "<20"), (30, "20-29"), (40, "30-39"), (50, "40-49"))
OLDEST_BAND = "50+"

# Fixed value: mean days per year of the age rule.
DAYS_PER_YEAR = 365.25


def age_band(age: Column) -> Column:
    """Name of the ten-year band; an unknown age counts as the oldest band."""
    (bound, name), *rest = AGE_BANDS
    band = F.when(age < bound, name)
    for bound, name in rest:
        band = band.when(age < bound, name)
    return band.otherwise(OLDEST_BAND)


def age_in_years(birth: Column, as_of: Column, exact: bool = False) -> Column:
    """Full years between two dates.

    The default divides days by 365.25, which is a day late on some birthdays;
    ``exact=True`` counts calendar years.
    """
    if exact:
        return F.floor(F.months_between(as_of, birth) / F.lit(12.0))
    return F.floor(F.datediff(as_of, birth) / F.lit(DAYS_PER_YEAR))
