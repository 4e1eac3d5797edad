"""Run Python over a few columns in Arrow batches, a bounded number of rows at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Rows = Callable[..., tuple[list, ...]]

#: Rows turned into Python objects at once.
STEP = 64


def slices(batches: Iterable[pa.RecordBatch], step: int = STEP) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def record_batch(columns: Iterable, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [
        c.cast(t) if isinstance(c, pa.Array) else pa.array(c, type=t)
        for c, t in zip(columns, schema.types, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def map_rows(
    df: DataFrame,
    keep: list[str],
    inputs: list[str],
    outputs: str,
    make: Callable[[], Rows],
    step: int = STEP,
) -> DataFrame:
    """``keep`` as it is, beside ``outputs`` that Python computes from ``inputs``.

    ``make`` runs once in each task and returns a function from a list per input
    column to a list per output column; what it remembers ends with the task, as idle
    workers would hold on to it. Only these columns are read.
    """
    kept = [f"k{i}" for i in range(len(keep))]
    given = [f"i{i}" for i in range(len(inputs))]
    made = StructType.fromDDL(outputs)
    picked = df.select(
        *(df[c].alias(k) for c, k in zip(keep, kept, strict=True)),
        *(df[c].alias(g) for c, g in zip(inputs, given, strict=True)),
    )
    result = StructType([*picked.select(kept).schema.fields, *made.fields])
    arrow = to_arrow_schema(result)
    n = len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for part in slices(batches, step):
            values = each(*(c.to_pylist() for c in part.columns[n:]))
            yield record_batch([*part.columns[:n], *values], arrow)
        del each
        pa.default_memory_pool().release_unused()

    return picked.mapInArrow(run, result).toDF(*keep, *made.names)
