"""Python functions of one text as Arrow UDFs: a batch is worked through in slices, so what Python holds doesn't grow with the batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

#: Bytes of text and rows of a slice; a longer text is a slice of its own.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1024


def cuts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of the slices of an array of strings."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = upto[at - 1] if at else 0
        end = int(min(max(np.searchsorted(upto, before + SLICE_BYTES, "right"), at + 1), at + SLICE_ROWS, len(texts)))
        yield at, end - at
        at = end


def each(kind: DataType, work: Callable):
    """A UDF of type ``kind`` that gives ``work`` of every row's values; the first column is the text that slices are cut by.

    Only one slice's values are Python objects at a time; results are kept as Arrow arrays.
    """
    out = to_arrow_type(kind)

    @arrow_udf(kind)
    def run(*columns: pa.Array) -> pa.Array:
        parts = [pa.array([work(*row) for row in zip(*(c.slice(at, n).to_pylist() for c in columns), strict=True)], out) for at, n in cuts(columns[0])]
        return pa.concat_arrays(parts) if parts else pa.array([], out)

    return run
