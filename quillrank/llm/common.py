"""Column expressions and settings that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: the separators of the word pattern [^\x20\x09-\x0D]+.
BREAK, NOT_BREAK = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
# Rows per Arrow batch: a batch of whole texts stays at a few MB even where long texts follow each other.
BATCH_ROWS = 200


def prepared(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, because their rows hold whole documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Runs without white space; an empty array for null and blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK + "+"), "")


def without_breaks(text: Column) -> Column:
    return F.regexp_replace(text, BREAK + "+", "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone, under fixed names, so that no other column can clash; a null text counts as empty."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
