"""Arrow helpers shared by the operators: bounded slices of batches and views of their text bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a vectorised step takes at once; one longer text is still taken whole.
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, text_at: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows whose text holds about `limit` bytes; every row appears once."""
    if batch.num_rows == 0:
        return
    _, offsets = utf8_view(batch.column(text_at))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def utf8_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32, count=column.offset + len(column) + 1)
    offsets = offsets[column.offset :].astype(np.int64)
    if buffers[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (public domain), over an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def annotate(
    df: DataFrame, text_col: str, outputs: str, work: Callable[[list[str | None]], list[pa.Array]], limit: int = SLICE_BYTES
) -> tuple[DataFrame, list[str]]:
    """Adds columns that `work` makes from the texts of each slice.

    All columns are renamed by place (c0, c1, ...; the new ones o0, o1, ...), so no name of the input can clash with a
    new one. Returns the frame and the input's names.
    """
    at = df.columns.index(text_col)
    inner = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    kinds = [k.strip() for k in outputs.split(",")]
    names = [*inner.columns, *(f"o{i}" for i in range(len(kinds)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at, limit):
                yield pa.RecordBatch.from_arrays([*batch.columns, *work(batch.column(at).to_pylist())], names=names)

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema), *(f"o{i} {k}" for i, k in enumerate(kinds))])
    return inner.mapInArrow(run, schema), df.columns


def with_outputs(annotated: tuple[DataFrame, list[str]], *outputs: str) -> DataFrame:
    """The input's columns and the named outputs; an input column of an output's name gives way."""
    df, names = annotated
    kept = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in outputs]
    return df.select(*kept, *(F.col(f"o{i}").alias(n) for i, n in enumerate(outputs)))


def rows_where(annotated: tuple[DataFrame, list[str]], condition: Column) -> DataFrame:
    """The input's rows and columns as they were, where a condition on o0, o1, ... holds."""
    df, names = annotated
    return df.filter(condition).select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))
