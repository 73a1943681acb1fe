"""What the operators on vectors share: which rows take part, their lengths, and arrays of Arrow as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Different lengths of vectors in one table at most; each has a model of its own, which the driver holds.
LENGTHS = 64
LONG = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def lengths(rows: DataFrame, vector: str) -> list[int]:
    """The different lengths of the column's arrays, of which there may be ``LENGTHS``."""
    found = sorted(r[0] for r in rows.select(F.size(vector)).distinct().limit(LENGTHS + 1).collect())
    if len(found) > LENGTHS:
        raise ValueError(f"more than {LENGTHS} different lengths of vectors")
    return found


def matrix(column: pa.ListArray, length: int) -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def arrays(values: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as a column of arrays."""
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], pa.array(values.ravel()))


def exact(values: np.ndarray, bound: int) -> np.ndarray:
    """Whole numbers as they are if results up to ``bound`` fit in a long, else as Python's unbounded ones."""
    return values if bound <= LONG else values.astype(object)
