"""Rows with a vector: which of them can be used, and their vectors as matrices of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LARGEST = float(1 << 52)


def usable(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """The rows whose vector is not null, not empty, holds only finite numbers and has the most frequent length (of several
    the largest), and that length; 0 if there are none."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    whole = rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).filter(F.forall(vector, lambda x: number(x.cast("double"))))
    lengths = whole.groupBy(F.size(vector).alias("width")).count()
    width = lengths.agg(F.max(F.struct("count", "width")).alias("most")).first()["most"]
    width = width["width"] if width else 0
    return whole.filter(F.size(vector) == width), width


def whole_numbers(vector: str, scale: int, bound: float = LARGEST) -> Column:
    """floor(scale * x) of every entry x as long; the products end at `bound` on both sides."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(bound)), F.lit(-bound))))


def matrix(array: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The lists of an Arrow column, all of one length, as rows of a matrix."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), width)


def lists(values: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as lists."""
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, n * width + 1, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32),
                                    pa.array(np.ascontiguousarray(values).ravel()))
