"""Traffic and corpus reports, snapshots, wide and tall tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillrank.functions import strip_html, tokens
from quillrank.plans.ranks import top_rows


def page_views(pages: DataFrame, hits: DataFrame, key: str = "url") -> DataFrame:
    """Hits per listed page, 0 where there are none."""
    counts = hits.groupBy(key).agg(F.count(F.lit(1)).alias("time"))
    return pages.join(counts, key, "left").withColumn("time", F.coalesce("time", F.lit(0)))


def pv_uv(hits: DataFrame, keys: list[str], user: str, approximate: bool = False) -> DataFrame:
    """Page views and distinct users per key; two-level counting, so one hot key is counted by many tasks."""
    if approximate:
        return hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("pv"), F.approx_count_distinct(user).alias("uv"))
    per_user = hits.groupBy(*keys, user).agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy(*keys).agg(F.sum("n").alias("pv"), F.count(user).alias("uv"))


def reading_time(docs: DataFrame, doc: str, text: str, rate: int = 300, html: bool = False) -> DataFrame:
    """Words and minutes (rounded up) per text."""
    words = F.size(tokens(strip_html(text) if html else F.col(text))).cast("bigint")
    return docs.select(doc, words.alias("words")).withColumn("minutes", F.ceil(F.col("words") / rate).cast("bigint"))


def reading_total(docs: DataFrame, doc: str, text: str, rate: int = 300, html: bool = False) -> DataFrame:
    """Words of all texts together, and the minutes they take."""
    words = F.coalesce(F.sum("words"), F.lit(0)).alias("words")
    total = reading_time(docs, doc, text, rate, html).agg(words)
    return total.withColumn("minutes", F.ceil(F.col("words") / rate).cast("bigint"))


def archive_counts(posts: DataFrame, ts: str) -> DataFrame:
    """Posts per month, per year and in all."""
    parts = posts.select(F.year(ts).alias("year"), F.month(ts).alias("month"))
    return parts.rollup("year", "month").agg(F.count(F.lit(1)).alias("posts"))


def tag_counts(posts: DataFrame, tags: Column, k: int = 300) -> DataFrame:
    """The ``k`` tags with most posts."""
    counts = posts.select(F.explode(F.array_distinct(tags)).alias("tag")).groupBy("tag").agg(
        F.count(F.lit(1)).alias("posts")
    )
    return top_rows(counts, [F.desc("posts"), F.asc("tag")], k)


def newest_pages(posts: DataFrame, ts: str, key: str, size: int = 10, pages: int = 10) -> DataFrame:
    """The newest ``pages`` pages of ``size`` posts."""
    best = top_rows(posts.select(key, ts), [F.desc(ts), F.desc(key)], size * pages)
    return best.withColumn("page", F.floor((F.col("rank") - 1) / size).cast("bigint"))


def month_snapshot(rows: DataFrame, key: str, ts: str, tie: str, values: list[str]) -> DataFrame:
    """The last known values of each key at every month end, carried forward to the last month of the table."""
    last = F.max_by(F.struct(*values), F.struct(ts, tie))
    monthly = rows.groupBy(key, F.last_day(ts).alias("month_end")).agg(last.alias("v"))
    end = rows.agg(F.last_day(F.max(ts))).scalar()
    # One row per key and month: a key's group is as long as the table has months.
    nxt = F.lead("month_end").over(W.partitionBy(key).orderBy("month_end"))
    until = F.coalesce(F.add_months(nxt, -1), F.add_months(F.col("__end"), 0))
    spans = monthly.withColumn("__end", end).withColumn("__until", F.last_day(until))
    months = F.sequence(F.trunc("month_end", "month"), F.trunc("__until", "month"), F.expr("interval 1 month"))
    carried = spans.select(key, F.explode(months).alias("m"), "v")
    return carried.select(key, F.last_day("m").alias("month_end"), *[F.col(f"v.{c}").alias(c) for c in values])


def wide(rows: DataFrame, keys: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """Tall to wide: one column per listed name, sums of the value."""
    return rows.groupBy(*keys).pivot(name, names).agg(F.sum(value))


def tall(rows: DataFrame, keys: list[str], names: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return rows.unpivot(keys, names, name, value).filter(F.col(value).isNotNull())
