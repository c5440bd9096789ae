"""Edit-distance join of two tables of strings without comparing all pairs.

A string that is at most d edits away from another one of length n holds one of that one's d + 1 segments unchanged, the
i-th of them shifted by at most i places counted from the left and by at most d - i counted from the right. So a string of
the indexed side has d + 1 keys (length, number of the segment, segment), and one of the asking side has the few pieces
that can match them, (d + 1)^2 times a small number whatever its length. Pairs that share a key are then measured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillrank.plans.skew import spread_join
from quillrank.session import stage


def _segment(length: Column, i: int, distance: int) -> tuple[Column, Column]:
    """Start and size of the i-th of ``distance`` + 1 even segments; the last ones are the longer ones."""
    base, longer = F.floor(length / (distance + 1)), length % (distance + 1)
    ahead = F.greatest(i - (distance + 1 - longer), F.lit(0))
    return base * i + ahead, base + F.when(i >= distance + 1 - longer, 1).otherwise(0)


def _key(length: Column, i: int, piece: Column) -> Column:
    return F.concat_ws(":", length.cast("string"), F.lit(i).cast("string"), piece)


def _indexed(text: Column, distance: int) -> Column:
    length = F.length(text)
    parts = []
    for i in range(distance + 1):
        start, size = _segment(length, i, distance)
        parts.append(_key(length, i, F.substring(text, (start + 1).cast("int"), size.cast("int"))))
    return F.array(*parts)


def _asking(text: Column, distance: int) -> Column:
    """Keys of all pieces that a string within the distance could have as a segment."""
    keys = []
    for change in range(-distance, distance + 1):
        # ``change`` is what the asking string has more than the indexed one.
        length = F.length(text) - change
        for i in range(distance + 1):
            start, size = _segment(length, i, distance)
            for shift in range(max(-i, change - (distance - i)), min(i, change + (distance - i)) + 1):
                at = start + shift
                inside = (length >= 0) & (at >= 0) & (at + size <= F.length(text))
                keys.append(F.when(inside, _key(length, i, F.substring(text, (at + 1).cast("int"), size.cast("int")))))
    return F.array_distinct(F.filter(F.array(*keys), lambda k: k.isNotNull()))


def edit_join(queries: DataFrame, titles: DataFrame, query: str, title: str, distance: int = 2) -> DataFrame:
    """(query, title, distance) of all different strings of both columns that are at most ``distance`` edits apart.

    Strings that occur often count once, nulls not at all; join the result with the tables for their rows. A key that
    many strings share is salted. Each pair is measured where its strings first share a key.
    """
    left = queries.select(F.col(query).alias("query")).filter("query IS NOT NULL").distinct()
    right = titles.select(F.col(title).alias("title")).filter("title IS NOT NULL").distinct()
    asking = left.select("query", F.explode(_asking(F.col("query"), distance)).alias("key"))
    indexed = stage(right.select("title", F.explode(_indexed(F.col("title"), distance)).alias("key")), "segments")
    weights = indexed.groupBy("key").agg(F.count(F.lit(1)).alias("cnt"))
    pairs = spread_join(indexed, asking, "key", weights=weights, salt=F.xxhash64("title"))
    apart = F.levenshtein("query", "title", distance)
    return pairs.select("query", "title", apart.cast("bigint").alias("distance")).filter("distance >= 0").distinct()
