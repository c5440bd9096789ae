"""Global ranks and running sums without a window over the whole table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillrank.plans.skew import null_safe_join
from quillrank.session import cut, stage

BUCKETS, MOST_BUCKETS = 256, 16_384
ROWS_A_BUCKET = 1_000_000


def bucket_count(rows: int) -> int:
    """Range buckets for that many rows: a bucket's window holds about ROWS_A_BUCKET, the bounds stay a short array."""
    return min(max(BUCKETS, -(-rows // ROWS_A_BUCKET)), MOST_BUCKETS)


def range_bucket(df: DataFrame, value: str, name: str = "bucket", buckets: int = BUCKETS) -> DataFrame:
    """Add an ordered bucket number from approximate quantiles of ``value``.

    The bounds only decide how even the buckets are, never a result. They are one row of at most ``buckets`` numbers.
    """
    step = max(math.isqrt(buckets), 1)
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(value, cuts, 10 * buckets).alias("b")).scalar()
    x = F.col(value)
    out = df.withColumn("__bounds", bounds)
    # Two short scans instead of one long one: first over every ``step``-th bound, then inside one stretch.
    coarse = F.transform(
        F.sequence(F.lit(step), F.lit(buckets - 1), F.lit(step)), lambda i: F.element_at("__bounds", i.cast("int"))
    )
    out = out.withColumn("__stretch", F.size(F.filter(coarse, lambda b: b < x)))
    fine = F.slice(F.col("__bounds"), F.col("__stretch") * step + 1, F.lit(step))
    out = out.withColumn(
        name, (F.col("__stretch") * step + F.size(F.filter(fine, lambda b: b < x))).cast("int")
    )
    return out.drop("__bounds", "__stretch")


def running_below(
    df: DataFrame, value: str, sums: list[str], group: list[str] = [], buckets: int | None = None
) -> DataFrame:
    """For a table with one row per (group, value): add ``<sum>_below``, the total over smaller values of the group.

    Rows are summed inside range buckets; the at most ``buckets`` bucket totals of a group are accumulated and joined
    back, by broadcast where there is no group. Without ``buckets`` their number follows the counted rows. The table is
    read several times and so is staged.
    """
    df = stage(df, "by_value")
    cut_up = range_bucket(df, value, "__bucket", buckets or bucket_count(df.count()))
    totals = cut_up.groupBy(*group, "__bucket").agg(*[F.sum(s).alias(f"__{s}") for s in sums])
    before = W.partitionBy(*group).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *group, "__bucket", *[F.coalesce(F.sum(f"__{s}").over(before), F.lit(0)).alias(f"__{s}_before") for s in sums]
    )
    inside = W.partitionBy(*group, "__bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    partial = cut_up
    for s in sums:
        partial = partial.withColumn(f"__{s}_in", F.coalesce(F.sum(s).over(inside), F.lit(0)))
    joined = null_safe_join(partial, offsets if group else F.broadcast(offsets), [*group, "__bucket"])
    for s in sums:
        joined = joined.withColumn(f"{s}_below", F.col(f"__{s}_before") + F.col(f"__{s}_in"))
    drop = ["__bucket", *[f"__{s}_in" for s in sums], *[f"__{s}_before" for s in sums]]
    return joined.drop(*drop)


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Exact row_number over the whole table: range sort, then one offset per partition.

    ``order`` must end in a unique key. The sorted rows are checkpointed so that partition numbers are final.
    """
    sorted_rows = cut(df.orderBy(*order))
    at = F.monotonically_increasing_id()
    placed = sorted_rows.withColumn("__part", F.shiftright(at, 33)).withColumn(
        "__pos", at.bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    numbered = placed.join(F.broadcast(offsets), "__part")
    return numbered.withColumn(name, F.col("__pos") + F.col("__offset") + 1).drop("__part", "__pos", "__offset")


def top_by(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows per key with their rank; Spark limits the groups before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("bigint")).filter(F.col(name) <= k)


def top_rows(df: DataFrame, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of the whole table with their rank; the window sees at most ``k`` rows."""
    best = df.orderBy(*order).limit(k)
    return best.withColumn(name, F.row_number().over(W.orderBy(*order)).cast("bigint"))
