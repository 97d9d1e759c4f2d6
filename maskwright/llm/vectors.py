"""Checks and shapes of embedding columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, not zero, and has only finite components."""
    value = vector.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(value, lambda x: x != 0), F.lit(False))


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors of one length as rows, in double precision."""
    return np.stack(column.to_numpy()).astype(np.float64)
