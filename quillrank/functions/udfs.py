"""Functions that need Python, and their registration for SQL."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession, functions as F, types as T


@F.pandas_udf(T.DoubleType())
def beta_sample(a: pd.Series, b: pd.Series, key: pd.Series) -> pd.Series:
    """One Beta(a, b) draw per row, from a generator seeded by the row's key."""
    draws = [np.random.Generator(np.random.PCG64(int(k) & (2**63 - 1))).beta(x, y) for x, y, k in zip(a, b, key)]
    return pd.Series(draws, dtype="float64")


def register(spark: SparkSession) -> None:
    """Make ``beta_dist_sample(a, b, key)`` known to SQL."""
    spark.udf.register("beta_dist_sample", beta_sample)
