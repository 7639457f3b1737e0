"""Sorted rows as streams: tasks go through the rows of a group in turn and hold none of them for long."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: What goes out at once: so many rows, or so many characters of text.
ROWS, CHARS = 2_000, 4_000_000


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, some hundred at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            yield from zip(*[c.to_pylist() for c in batch.slice(start, 500).columns], strict=True)


def batched(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of a bounded size; a single row may be larger."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if len(held) >= ROWS or chars >= CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def streamed(df: DataFrame, go, schema: StructType) -> DataFrame:
    """``go`` (rows as tuples to rows as tuples) over each partition of ``df``, in its order."""
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: batched(go(rows_of(batches)), arrow), schema)


def typed(df: DataFrame, column: str, rest: str) -> StructType:
    """``column`` as ``df`` has it, and the columns of ``rest``, as a schema."""
    return StructType([df.schema[column], *StructType.fromDDL(rest)])
