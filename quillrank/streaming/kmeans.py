"""Mini-batch k-means with forgetting."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quillrank.functions import doubles

# Centres travel to every task; more than this is refused.
MAX_CENTRES = 10_000


def nearest_centre(points: DataFrame, centres: DataFrame, vector: str) -> DataFrame:
    """Add the id of the closest centre to every point, ties to the lower id."""
    rows = centres.orderBy("id").limit(MAX_CENTRES + 1).collect()
    if len(rows) > MAX_CENTRES:
        raise ValueError(f"at most {MAX_CENTRES} centres are supported")
    ids = np.array([r["id"] for r in rows])
    matrix = np.array([r["centre"] for r in rows], dtype="float64")
    half = (matrix * matrix).sum(axis=1) / 2.0

    @F.pandas_udf("bigint")
    def closest(vectors: pd.Series) -> pd.Series:
        block = np.stack(vectors.to_numpy()).astype("float64")
        return pd.Series(ids[np.argmin(half - block @ matrix.T, axis=1)])

    return points.withColumn("cluster", closest(vector))


def updated(centres: DataFrame, points: DataFrame, vector: str, decay: float) -> DataFrame:
    """c' = (c n a + x m) / (n a + m), n' = n a + m, x the mean and m the number of a centre's new points."""
    assigned = nearest_centre(points, centres, vector)
    mean = Summarizer.mean(array_to_vector(doubles(vector)))
    new = assigned.groupBy(F.col("cluster").alias("id")).agg(
        vector_to_array(mean).alias("x"), F.count(F.lit(1)).cast("double").alias("m")
    )
    joined = centres.join(new, "id", "left")
    n, m = F.col("n") * decay, F.coalesce(F.col("m"), F.lit(0.0))
    moved = F.zip_with("centre", "x", lambda c, x: (c * n + x * m) / (n + m))
    return joined.select("id", F.coalesce(moved, F.col("centre")).alias("centre"), (n + m).alias("n"))


def _version(table: str, number: int) -> str:
    return os.path.join(table, f"batch={number:09d}")


def start(points: DataFrame, first: DataFrame, table: str, checkpoint: str, vector: str, decay: float) -> StreamingQuery:
    """Keep centres (id, centre, n) in one folder per batch; a replayed batch starts from the version before it."""
    first.write.mode("overwrite").parquet(_version(table, 0))

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        centres = spark.read.parquet(_version(table, number))
        updated(centres, batch, vector, decay).write.mode("overwrite").parquet(_version(table, number + 1))

    return (
        points.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_centres(spark: SparkSession, table: str) -> DataFrame:
    versions = spark.read.option("basePath", table).parquet(table)
    return versions.filter(F.col("batch") == versions.agg(F.max("batch")).scalar())
