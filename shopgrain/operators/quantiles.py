"""Exact medians of columns too large to sort in one place."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import is_null_or_nan, named, type_of

# Size of the quantile sketch: a pass leaves at most about 6 / ACCURACY of the rows.
ACCURACY = 10_000

# Rows that may be sorted in one task at the end.
SORTABLE = 100_000

# Evenly spaced quantiles that a pass takes where it does not know yet which it needs.
GRID = 2_000


@dataclass
class _Search:
    """What is known of one column: its median is ``rank``th of ``n`` values, above
    ``floor`` and below ``ceiling``, and probably above ``low`` and below ``high``, between
    which there are ``most`` values at most. An end that is None is open."""

    rank: int
    n: int
    low: Any
    high: Any
    most: float
    floor: Any = None
    ceiling: Any = None
    value: Any = None

    def look_in(self, low: Any, high: Any, size: int) -> None:
        """Go on between two values that the median was counted to lie between."""
        self.low = self.floor = low
        self.high = self.ceiling = high
        self.most = size


def exact_median(
    df: DataFrame, name: str, accuracy: int = ACCURACY, sortable: int = SORTABLE
) -> Any:
    """The value at rank ceil(n / 2), or None without values."""
    return exact_medians(df, [name], accuracy, sortable)[name]


def exact_medians(
    df: DataFrame, names: Sequence[str], accuracy: int = ACCURACY, sortable: int = SORTABLE
) -> dict[str, Any]:
    """The exact median of each column, all columns in the same passes.

    Like ``approxQuantile`` this runs jobs and returns numbers. The first pass takes two
    approximate quantiles around the middle of each column. Every later one counts exactly
    what lies on either side of the cuts before it and takes new ones between them in the
    same aggregate, or, once the error of the quantiles leaves at most ``sortable`` values
    there, gathers these and has the median: two jobs for up to some 10^8 rows and
    a job more for each further factor of 1,000. A pass is a map-side aggregate without
    a shuffle of rows. Where an approximate quantile was off, the counts show it, and
    the search goes on beside the cuts.
    """
    for name in names:
        if not isinstance(type_of(df, name), T.NumericType):
            raise ValueError(f"median needs a numeric column, {name!r} is not")
    if accuracy < 10:
        raise ValueError(f"accuracy must be at least 10, not {accuracy}")
    if not names:
        return {}
    known = {c: ~is_null_or_nan(df, c) for c in names}
    margin = 2.0 / accuracy
    middle = [0.5 - margin, 0.5 + margin]
    first = df.agg(
        *[F.count_if(known[c]) for c in names],
        *[F.percentile_approx(F.when(known[c], named(c)), middle, accuracy) for c in names],
    ).first()
    columns = {
        c: _Search((n + 1) // 2, n, *cuts, most=(2 * margin + 2 / accuracy) * n + 2)
        for c, n, cuts in zip(names, first, first[len(names) :])
        if n
    }
    open_ = dict(columns)
    while open_:
        counted = df.agg(
            *[_counts(known[c], named(c), s, accuracy, sortable) for c, s in open_.items()]
        ).first()
        for (c, search), counts in zip(list(open_.items()), counted, strict=True):
            if _found(search, counts, margin, accuracy, sortable):
                del open_[c]
    return {c: columns[c].value if c in columns else None for c in names}


def _counts(
    known: Column, value: Column, search: _Search, accuracy: int, sortable: int
) -> Column:
    """Values below, up to, below and up to the cuts, and those between or their quantiles."""
    low, high = F.lit(search.low), F.lit(search.high)
    inside, tests = known, [F.lit(False)] * 2 + [known] * 2
    if search.low is not None:
        inside = inside & (value > low)
        tests[:2] = [known & (value < low), known & (value <= low)]
    if search.high is not None:
        inside = inside & (value < high)
        tests[2:] = [known & (value < high), known & (value <= high)]
    between = F.when(inside, value)
    if search.most <= sortable:
        held = F.sort_array(F.collect_list(between))
    else:
        grid = [i / GRID for i in range(GRID + 1)]
        held = F.percentile_approx(between, grid, accuracy)
    return F.struct(*map(F.count_if, tests), held)


def _found(search: _Search, counts: Row, margin: float, accuracy: int, sortable: int) -> bool:
    """Whether the counts settle the median; if not, where to look next is set."""
    below_low, to_low, below_high, to_high, held = counts
    rank, low, high = search.rank, search.low, search.high
    if below_low < rank <= to_low:
        search.value = low
    elif below_high < rank <= to_high:
        search.value = high
    elif rank <= below_low:
        search.look_in(search.floor, low, below_low)
    elif rank > to_high:
        search.look_in(high, search.ceiling, search.n - to_high)
    elif search.most <= sortable:
        search.value = held[rank - to_low - 1]
    else:
        size = below_high - to_low
        search.look_in(low, high, size)
        at = (rank - to_low) / size
        i, j = math.floor((at - margin) * GRID), math.ceil((at + margin) * GRID)
        if i > 0:
            search.low = held[i]
        if j < GRID:
            search.high = held[j]
        search.most = ((j - i) / GRID + 2 / accuracy) * size + 2
    return search.value is not None
