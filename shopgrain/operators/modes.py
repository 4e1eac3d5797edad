"""Most frequent values of columns too varied to count value by value."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.columns import is_null_or_nan, named, require_columns
from ..saving import saved

#: Entries of a frequent-items sketch. A full sketch of 1,024 slots lowers its entries by
#: their exact median, so its counts are off by at most 3.5 / 1,024 of all rows.
TRACKED, SLOTS = 768, 1024


def exact_modes(df: DataFrame, names: Sequence[str]) -> dict[str, Any]:
    """The most frequent value of each column, the smallest on ties; None without values.

    Null and NaN are no values. Like ``exact_medians`` this runs jobs and returns a value
    per column. Values are told apart by 64-bit digests until few are left, so neither
    the sketches nor what is shuffled grow with the width of a column:

    1. One map-side pass over all columns keeps a sketch of frequent digests. Every digest
       above twice the error of the sketch is in it, whatever the data.
    2. Rows of these digests are counted by value. A value above twice the error has won,
       as all that could beat it or tie with it were counted too.
    3. Columns without such a value count all digests. If none occurs twice, the smallest
       value has won. Else the rows of the most frequent digests are counted by value; if
       the best falls short of its digest, two values shared one, and the column
       is counted by value as a whole.
    """
    require_columns(df, names)
    if not names:
        return {}
    known = {c: ~is_null_or_nan(df, c) for c in names}
    digests = {c: F.when(known[c], F.xxhash64(named(c))) for c in names}
    columns = {f"d{i}": d for i, d in enumerate(digests.values())}
    sketched = df.select(*[d.alias(n) for n, d in columns.items()]).agg(
        *[F.count(n).alias(f"n_{n}") for n in columns],
        *[
            F.expr(f"approx_top_k({n}, {TRACKED}, {TRACKED}) FILTER (WHERE {n} IS NOT NULL)")
            .getField("item")
            .alias(n)
            for n in columns
        ],
    )
    seen = sketched.first()
    found: dict[str, Any] = dict.fromkeys(names)
    for c, name in zip(names, columns, strict=True):
        n, frequent = seen[f"n_{name}"], seen[name]
        if not n:
            continue
        rows = df.where(known[c]).select(named(c).alias("value"), digests[c].alias("digest"))
        best = _best(rows.where(F.col("digest").isin(frequent))) if frequent else None
        # A sketch that never was full holds every digest, so all rows were counted.
        if best is None or (best.n <= 2 * n * 3.5 / SLOTS and best.counted < n):
            best = _best_by_digest(rows)
        found[c] = best.value
    return found


def _best(rows: DataFrame) -> Row:
    """``value, n`` of the most frequent value, and how many rows were ``counted``."""
    counts = rows.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("n"), "value"))
    return counts.agg(
        first.getField("value").alias("value"),
        (-first.getField("n")).alias("n"),
        F.sum("n").alias("counted"),
    ).first()


def _best_by_digest(rows: DataFrame) -> Row:
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    counts = saved(counts, "digests")
    most = counts.agg(F.max("n")).first()[0]
    if most == 1:
        return rows.agg(F.min("value").alias("value")).first()
    # Written, so that the join knows its size and leaves the values where they are.
    top = saved(counts.where(F.col("n") == most).select("digest"), "top")
    best = _best(rows.join(top, "digest", "left_semi"))
    return best if best.n == most else _best(rows)
