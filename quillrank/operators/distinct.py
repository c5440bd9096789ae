"""Distinct users of any period from stored daily sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillrank.sources.sinks import overwrite_partitions

# Registers of a sketch as a power of two; the standard error is about 1.04 / sqrt(2 ** REGISTERS), 0.8 %.
REGISTERS = 14


def daily_sketches(
    hits: DataFrame, ts: str, user: str, keys: list[str] = [], registers: int = REGISTERS, late: str | None = None
) -> DataFrame:
    """(day, keys, pv, users): views and a sketch of the users of each day and key.

    Tasks sketch their own rows, so a hot key costs one small row a task. On a stream, ``late`` is the watermark. Null users
    count as views only; rows without a time are left out.
    """
    timed = hits.filter(F.col(ts).isNotNull())
    if late is not None:
        timed = timed.withWatermark(ts, late)
    sums = [F.count(F.lit(1)).alias("pv"), F.hll_sketch_agg(user, F.lit(registers)).alias("users")]
    days = timed.groupBy(F.window(ts, "1 day"), *keys).agg(*sums)
    return days.select(F.to_date("window.start").alias("day"), *keys, "pv", "users")


def save_days(sketches: DataFrame, path: str) -> None:
    """Replace the days present in ``sketches``; the others stay as they are."""
    overwrite_partitions(sketches, path, ["day"])


def united(sketches: DataFrame, period: Column | None = None, keys: list[str] = []) -> DataFrame:
    """(period, keys, pv, uv) from daily sketches alone: users of several days or keys count once.

    Leave out ``period`` for all days together, and keys to unite over them.
    """
    by = [*([] if period is None else [period.alias("period")]), *keys]
    users = F.hll_sketch_estimate(F.hll_union_agg("users", F.lit(True)))
    return sketches.groupBy(*by).agg(F.sum("pv").alias("pv"), users.alias("uv"))
