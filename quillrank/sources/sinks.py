"""Writers and table upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

PARTITIONS = ["ds", "item_type"]


def overwrite_partitions(df: DataFrame, path: str, partitions: list[str] = PARTITIONS, files: int | None = None) -> None:
    """Replace the partitions present in ``df`` and leave the others; safe to repeat.

    Rows are shuffled so that each partition value gets few files; AQE splits a large partition value again.
    """
    layout = df.repartition(files, *partitions) if files else df.hint("rebalance", *partitions)
    layout.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def retained(df: DataFrame, run_date: str, days: int = 7, ds: str = "ds") -> DataFrame:
    """Rows of the last ``days`` days before the run date; older partitions are left out by pruning."""
    first = F.date_format(F.date_sub(F.to_date(F.lit(run_date), "yyyyMMdd"), days), "yyyyMMdd")
    return df.filter(F.col(ds) > first)


def expired(partitions: DataFrame, run_date: str, days: int = 7, ds: str = "ds") -> DataFrame:
    """The partition values that ``retained`` leaves out."""
    first = F.date_format(F.date_sub(F.to_date(F.lit(run_date), "yyyyMMdd"), days), "yyyyMMdd")
    return partitions.select(ds).distinct().filter(F.col(ds) <= first)


def run_dates(spark: SparkSession, date: str | None = None, window: int = 7, lag: int = 1, keep: int = 7) -> DataFrame:
    """One row: run date (default ``lag`` days ago), its dashed form, window start and the day to drop."""
    day = F.to_date(F.lit(date), "yyyyMMdd") if date else F.date_sub(F.current_date(), lag)
    text = lambda c: F.date_format(c, "yyyyMMdd")
    return spark.range(1).select(
        text(day).alias("date"),
        F.date_format(day, "yyyy-MM-dd").alias("day"),
        text(F.date_sub(day, window)).alias("first"),
        text(F.date_sub(day, keep)).alias("drop"),
    )


def text_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def key_values(df: DataFrame, key: str, value: str, path: str, sep: str = "\t") -> None:
    """Lines of key and value for a loader of a key/value store."""
    df.select(F.concat_ws(sep, key, value).alias("value")).write.mode("overwrite").text(path)
