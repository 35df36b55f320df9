"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Text bytes that a task turns into Python objects at once.
SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about `limit` bytes of `column`, one row at least."""
    start, held = 0, 0
    values = batch.column(column)
    for row, size in enumerate(pc.binary_length(values).to_pylist()):
        if held and held + (size or 0) > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def append_columns(df: DataFrame, text: str, make: Callable[[], Callable[[list], list]],
                   fields: list[T.StructField]) -> DataFrame:
    """`df` with columns computed from the column `text`, a slice of rows at a time.

    `make` runs once in each task and returns the function that maps a list of texts
    (None for null) to one list or Arrow array of values for each field. All columns of `df` pass
    through Arrow untouched, so that integers with nulls stay integers. A name of
    `fields` must not be a column of `df`.
    """
    clash = {f.name for f in fields} & set(df.columns)
    if clash:
        raise ValueError(f"columns already exist: {sorted(clash)}")
    schema = T.StructType(df.schema.fields + fields)
    kinds = [arrow_type(f.dataType) for f in fields]
    names = df.columns + [f.name for f in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in slices(batch, text):
                made = compute(part.column(text).to_pylist())
                new = [v if isinstance(v, pa.Array) else pa.array(v, k)
                       for v, k in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(list(part.columns) + new, names=names)

    return df.mapInArrow(run, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, arrow_type(f.dataType)) for f in kind.fields])
    return {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(),
            T.BooleanType(): pa.bool_(), T.StringType(): pa.string(),
            T.BinaryType(): pa.binary()}[kind]
