"""Reading embedding columns: which vectors are usable, and their numpy form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sound(vector: str) -> Column:
    """Not null, not empty, without null or non-finite components."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~bad, F.lit(False))


def usual_length(rows: DataFrame, vector: str) -> int:
    """The commonest length, the larger on a tie; 0 without rows."""
    found = rows.filter(sound(vector)).groupBy(F.size(vector).alias("n")).count() \
        .orderBy(F.desc("count"), F.desc("n")).first()
    return found["n"] if found else 0


def matrix(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    """Rows of doubles from a list column whose lists all have the given length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), length)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, length = rows.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * length, length, dtype=np.int32),
                                    pa.array(np.ascontiguousarray(rows).ravel(), kind))
