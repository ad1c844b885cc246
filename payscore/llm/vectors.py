"""What the operators on embedding vectors share: fixed-point components, and columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Steps in a unit, and the largest number of steps (larger components count as this).
STEPS = 64
LARGEST = 4e18


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is neither null nor holds a null or non-finite component."""
    strange = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return df.where(F.col(vector).isNotNull() & ~strange)


def fixed_point(vector: str | Column = "embedding") -> Column:
    """floor(64 * component) as long; the product is made in double precision."""
    column = F.col(vector) if isinstance(vector, str) else vector

    def steps(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x.cast("double") * STEPS, F.lit(LARGEST)), F.lit(-LARGEST)))

    return F.transform(column, steps)


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """A column of lists of ``width`` longs, one list a row."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
