"""Isotonic regression on samples: pooled blocks per range of scores, merged in a tree."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from quillrank.plans.ranks import bucket_count, range_bucket
from quillrank.session import stage

# Ranges that one task merges.
FAN_IN = 16
BLOCK = "bucket int, lo double, n double, total double"


def _pool(rows: pd.DataFrame) -> pd.DataFrame:
    """Adjacent rows in the order of ``lo`` as blocks with rising means; a violator joins the block before it."""
    rows = rows.sort_values("lo", kind="stable")
    kept: list[list[float]] = []
    for lo, n, total in zip(rows["lo"].tolist(), rows["n"].tolist(), rows["total"].tolist()):
        while kept and kept[-1][2] * n >= total * kept[-1][1]:
            lo, below_n, below_total = kept.pop()
            n, total = n + below_n, total + below_total
        kept.append([lo, n, total])
    out = pd.DataFrame(kept, columns=["lo", "n", "total"], dtype="float64")
    out.insert(0, "bucket", rows["bucket"].iloc[0])
    return out


def isotonic(df: DataFrame, score: str = "prob", label: str = "label", weight: str | None = None) -> DataFrame:
    """(value, n, total, calibrated): for each different score its weight, weighted label sum and isotonic fit.

    The fit is exact. Pooling the blocks of adjacent ranges gives the blocks of both together, so no task sees the samples
    of more than one range; the last task sees blocks only, about the cube root of the number of scores where labels are
    noisy. Rows without score, label or a positive weight are left out; labels may be any numbers.
    """
    w = (F.lit(1.0) if weight is None else F.col(weight)).cast("double")
    samples = df.select(F.col(score).cast("double").alias("value"), F.col(label).cast("double").alias("y"), w.alias("w"))
    samples = samples.filter("value IS NOT NULL AND y IS NOT NULL AND w > 0")
    points = samples.groupBy("value").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("total"))
    points = stage(points, "scores")
    ranges = bucket_count(points.count())
    cut_up = range_bucket(points, "value", "bucket", ranges)
    blocks = cut_up.select("bucket", F.col("value").alias("lo"), "n", "total").groupBy("bucket").applyInPandas(_pool, BLOCK)
    while ranges > 1:
        ranges = -(-ranges // FAN_IN)
        wider = blocks.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN).cast("int"))
        blocks = wider.groupBy("bucket").applyInPandas(_pool, BLOCK)
    starts = stage(blocks.select(F.col("lo").alias("value"), (F.col("total") / F.col("n")).alias("mean")), "blocks")
    # Means rise, so the block of a score has the largest mean of all blocks that start at or below it.
    marked = cut_up.join(starts, "value", "left")
    tops = marked.groupBy("bucket").agg(F.max("mean").alias("top"))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    tops = tops.select("bucket", F.max("top").over(before).alias("below"))
    inside = W.partitionBy("bucket").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    fitted = F.greatest(F.max("mean").over(inside), F.col("below"))
    return marked.join(F.broadcast(tops), "bucket").select("value", "n", "total", fitted.alias("calibrated"))
