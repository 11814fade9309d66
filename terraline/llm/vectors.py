"""Vectors of a table as dense matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True where a vector is not null and neither holds a null nor a non-finite entry."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))


def dense(column: pa.Array, width: int = 0, fill: float = 0) -> np.ndarray:
    """A list column without nulls as rows of a matrix of its longest row (or the width); shorter rows are filled up."""
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    n, longest = len(lengths), max(width, int(lengths.max(initial=0)))
    if len(values) == n * longest:
        return values.reshape(n, longest)
    out = np.full((n, longest), fill, values.dtype)
    out[np.arange(longest) < lengths[:, None]] = values
    return out
