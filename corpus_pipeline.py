"""A cleaning pipeline over ``documents``: each stage reads what its predecessor kept, as a written table.

Quality classifier, near-duplicates, repeated passages, benchmark passages, packing. All stages but the last return the
columns of documents; repeated rows, nulls and empty texts are treated as the operators' own descriptions say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillrank import session
from quillrank.llm import kneser_ney, latent, minhash, packing, spans
from quillrank.llm.common import prepared
from quillrank.llm.queries import tokenizer
from quillrank.plans.skew import spread_join


def _without(docs: DataFrame, verdicts: DataFrame, bad: Column) -> DataFrame:
    """``docs`` less the keys that ``verdicts`` condemns; rows without a key stay."""
    gone = verdicts.filter(bad & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return spread_join(docs, gone, "doc_id", "left_anti", salt=F.xxhash64("doc_id")).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney classifier does not reject."""
    labels = prepared(session.configure(spark)).read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, kneser_ney.classify(docs, labels), ~F.col("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8 or more), the one with the smallest key."""
    prepared(session.configure(spark))
    return _without(docs, minhash.near_duplicates(docs, percent=80), ~F.col("kept"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the sentences of runs that stand elsewhere first; n_chars follows the text."""
    prepared(session.configure(spark))
    done = spans.without_repeats(docs)
    length = F.when(F.col("__removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", length).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    asked = prepared(session.configure(spark)).read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, latent.contaminated(docs, asked), F.col("contaminated"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the packed sequences."""
    prepared(session.configure(spark))
    table = packing.pieces(docs, tokenizer("byte_bpe_50k.json"))
    return packing.digest(packing.best_fit(table.drop("ids")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark passages", benchmark_passages),
    ("packing", packed),
]

# A trained model and hashed searches have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = session.run_dir(spark, "pipeline")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
