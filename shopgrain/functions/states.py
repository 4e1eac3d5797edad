"""US state codes found in address texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import NOT_AVAILABLE

# The fifty state codes.
US_STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL",
    "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT",
    "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI",
    "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
)

# Fixed value: a stand-alone pair of capitals.
CAPITAL_PAIR = r"\b([A-Z]{2})\b"


def state_code(address: Column, mode: str = "first") -> Column:
    """State code in an address, or ``Not Available``.

    ``first`` looks only at the first pair of capitals, so a leading "PO Box"
    hides the state; ``any`` takes the last pair that is a state.
    """
    if mode == "first":
        pair = F.regexp_extract(address, CAPITAL_PAIR, 1)
        return F.when(pair.isin(*US_STATES), pair).otherwise(NOT_AVAILABLE)
    if mode == "any":
        pairs = F.regexp_extract_all(address, F.lit(CAPITAL_PAIR), F.lit(1))
        states = F.filter(pairs, lambda p: p.isin(*US_STATES))
        return F.coalesce(F.try_element_at(states, F.lit(-1)), F.lit(NOT_AVAILABLE))
    raise ValueError(f"mode must be 'first' or 'any', not {mode!r}")
