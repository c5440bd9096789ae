"""Baskets and texts as training corpora: word lists, vocabulary, sampling weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillrank.functions import as_number, tokens
from quillrank.fixed import ACTION_PLAY, UNKNOWN
from quillrank.plans.skew import keep_by_count


def basket_corpus(actions: DataFrame, low: int = 5, high: int = 50, ms: int = 90_000) -> DataFrame:
    """Items of each user as one line, for users with ``low <= distinct items <= high`` long plays."""
    plays = actions.filter(
        (F.col("action") == ACTION_PLAY) & (F.col("item_id") != UNKNOWN) & (as_number("extend") > ms)
    )
    pairs = plays.select("user_id", "item_id").distinct()
    cnt = F.col("cnt")
    kept = keep_by_count(pairs, "user_id", cnt.between(low, high), cnt > high)
    # At most ``high`` items per user are left.
    items = F.array_sort(F.collect_list("item_id"))
    return kept.groupBy("user_id").agg(F.concat_ws(" ", items).alias("list"))


def term_counts(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    # Texts are shuffled, which are shorter than their words with the key beside each; then a key's words lie together.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = docs.select(doc, text).repartition(parts, doc).select(doc, F.explode(tokens(text)).alias("term"))
    return words.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(docs: DataFrame, text: str = "text", min_count: int = 5) -> DataFrame:
    """Words with at least ``min_count`` uses."""
    words = docs.select(F.explode(tokens(text)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cn")).filter(F.col("cn") >= min_count)


def kept_words(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"), F.sum("cn").alias("train_words"))


def negative_sampling(vocab: DataFrame, power: float = 0.75) -> DataFrame:
    """Draw probability of each word: its count to a power, over the sum of all."""
    total = vocab.agg(F.sum(F.pow("cn", F.lit(power)))).scalar()
    return vocab.withColumn("prob", F.pow("cn", F.lit(power)) / total)
