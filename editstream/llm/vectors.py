"""Vector columns as numpy blocks, for the operators on embeddings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(True))


def matrices(batch, column: str, most: int):
    """(row numbers, float64 matrix) of each dimension in a batch, at most
    ``most`` rows each."""
    import numpy as np
    import pyarrow as pa

    vectors = batch.column(column)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    off = np.asarray(vectors.offsets)
    off = off - off[0]
    dims = np.diff(off)
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        for i in range(0, len(rows), most):
            part = rows[i:i + most]
            yield part, flat[off[part][:, None] + np.arange(d)]
