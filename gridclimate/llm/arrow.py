"""Helpers for functions over Arrow batches."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = 1000


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most so many rows, so that few texts are unpacked at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def row_of(docs: DataFrame, keep: list[str] | None = None) -> Column:
    """A struct of the columns to keep, all unless given, under the name ``row``."""
    return F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row")


def slices_of_bytes(
    batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20, rows: int = SLICE
) -> Iterator[pa.RecordBatch]:
    """The same, and with at most so many bytes in that column of texts, or a single row."""
    for batch in slices(batches, rows):
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        size = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop
