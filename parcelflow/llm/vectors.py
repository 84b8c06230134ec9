"""Vector columns as arrays: which rows take part, and their components in double precision."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: str) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def lengths(rows: DataFrame, vector: str) -> list[int]:
    """The lengths that the vectors have, one number for each."""
    return sorted(r["d"] for r in rows.select(F.size(vector).alias("d")).distinct().collect())


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length, one in each row, as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
