"""Samples and splits that come out the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillrank.functions import hash_slot, hash_unit
from quillrank.plans.skew import spread_join


def drop_negatives(df: DataFrame, key: str, label: str, rate: float, seed: int = 0) -> DataFrame:
    """All positives and a ``rate`` share of the negatives, chosen by key."""
    return df.filter((F.col(label) == 1) | (hash_unit(key, seed) < rate))


def skip_above(df: DataFrame, query: str, position: str, label: str) -> DataFrame:
    """Clicked rows, and unclicked rows shown above the last click of their query."""
    last = df.filter(F.col(label) == 1).groupBy(query).agg(F.max(position).alias("last_click"))
    return spread_join(df, last, query).filter(F.col(position) <= F.col("last_click")).drop("last_click")


def fold(key: Column | str, folds: int, seed: int = 0) -> Column:
    return hash_slot(key, folds, seed)


def ab_group(key: Column | str, salt: str, shares: dict[str, int]) -> Column:
    """Traffic group of a key by a salted slot in 0..99; ``shares`` are per cent and sum to at most 100."""
    slot = hash_slot(key, 100, salt)
    out = F.lit(None).cast("string")
    edge = sum(shares.values())
    for name, share in reversed(list(shares.items())):
        out = F.when(slot < edge, F.lit(name)).otherwise(out)
        edge -= share
    return out


def time_split(df: DataFrame, ts: str, train_until: str) -> DataFrame:
    return df.withColumn("part", F.when(F.col(ts) < F.lit(train_until).cast("timestamp"), "train").otherwise("test"))


def bootstrap_weight(key: Column | str, seed: int = 0) -> Column:
    """Poisson(1) weight of a row, from a hash: how often the row is drawn."""
    u = hash_unit(key, seed)
    out, total, p = F.lit(0), 0.0, 0.36787944117144233
    for times in range(0, 12):
        total += p
        out = out + (u >= total).cast("int")
        p /= times + 1
    return out
