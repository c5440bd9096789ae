"""Per-user recommendation lists from play history and association rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillrank import fixed as X
from quillrank.functions import hash_unit
from quillrank.operators.actions import in_window, numbered_plays
from quillrank.plans.ranks import global_row_number, top_by, top_rows
from quillrank.plans.skew import spread_join
from quillrank.session import view


def candidate_priors(
    actions: DataFrame,
    date: str,
    info: DataFrame | None = None,
    days: int = X.PRIOR_DAYS,
    low: int = X.PLAY_MS_MIN,
    high: int = X.PLAY_MS_MAX,
    k: int = X.PRIOR_MAX,
    item_type: int | None = None,
) -> DataFrame:
    """The ``k`` items each user played most within ``date - days .. date`` (both included)."""
    plays = numbered_plays(in_window(actions, date, days, item_type), low, high)
    counted = plays.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("prior"))
    best = top_by(counted, ["user_id"], [F.desc("prior"), F.asc("item_id")], k)
    if info is None:
        return best.select("user_id", "item_id", "prior")
    text = [F.nvl(c, F.lit("")) for c in ("song_id", "song_name", "singer_id", "singer_name")]
    described = spread_join(best, view(info, "*", F.col("song_id").alias("item_id")), "item_id", "left")
    return described.select("user_id", "item_id", "prior", F.concat_ws("|", *text).alias("debug_info"))


def recommend(
    priors: DataFrame,
    rules: DataFrame,
    rules_used: int = X.RULES_USED,
    k: int = X.REC_MAX,
    per_singer: int = X.PER_SINGER_MAX,
    exclude_seen: bool = False,
) -> DataFrame:
    """Posteriors of a user's prior items, best rule rank per play first, at most ``per_singer`` per singer.

    rec_reason, debug_info and singer_id of an item reached by several rules are three separate maxima.
    """
    offer = F.struct("rank", "item_posterior", "debug_info", "singer_posterior")
    # At most rules_used rows per prior, so one row per prior holds them all and the join key is unique.
    packed = (
        rules.filter(F.col("rank") <= rules_used)
        .groupBy(F.col("item_prior").alias("item_id"))
        .agg(F.collect_list(offer).alias("offers"))
    )
    held = spread_join(priors.select("user_id", "item_id", "prior"), packed, "item_id")
    offers = held.select("user_id", F.col("item_id").alias("item_prior"), "prior", F.inline("offers"))
    if exclude_seen:
        seen = priors.select("user_id", F.col("item_id").alias("item_posterior"))
        offers = offers.join(seen, ["user_id", "item_posterior"], "left_anti")
    order = [(F.col("rank").cast("double") / F.col("prior")).asc(), F.asc("item_prior"), F.asc("item_posterior")]
    first = top_by(offers, ["user_id"], order, k, "position")
    merged = first.groupBy("user_id", F.col("item_posterior").alias("item_id")).agg(
        F.min("position").alias("position"),
        F.max("item_prior").alias("rec_reason"),
        F.max("debug_info").alias("debug_info"),
        F.max("singer_posterior").alias("singer_id"),
    )
    capped = top_by(merged, ["user_id", "singer_id"], [F.asc("position")], per_singer, "in_singer")
    rank = F.row_number().over(W.partitionBy("user_id").orderBy("position")).cast("bigint")
    return capped.select(
        "user_id", "item_id", F.lit(0.0).alias("score"), rank.alias("rank"), "rec_reason", "debug_info", "singer_id"
    )


def default_list(
    actions: DataFrame,
    info: DataFrame,
    date: str,
    hot_min: int = X.HOT_MIN,
    k: int = X.REC_MAX,
    excluded_singer: str = X.EXCLUDED_SINGER,
    seed: int = 0,
) -> DataFrame:
    """A random ``k`` of the titles with more than ``hot_min`` actions on a day, for the user 'default'.

    The rank counts from the least hot title and is taken over all hot titles before the draw.
    """
    per_item = in_window(actions, date).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    # One row per item on the left; the table of all items can be small as a file and still large in memory.
    allowed = info.filter(F.col("singer_name") != excluded_singer).hint("merge")
    named = per_item.join(allowed, F.col("item_id") == F.col("song_id"))
    titles = named.groupBy("song_name").agg(
        F.max("song_id").alias("item_id"), F.max("singer_id").alias("singer_id"), F.sum("n").alias("hot")
    )
    ranked = global_row_number(titles.filter(F.col("hot") > hot_min), [F.asc("hot"), F.asc("item_id")])
    drawn = ranked.orderBy(hash_unit("item_id", seed), "item_id").limit(k)
    return drawn.select(
        F.lit("default").alias("user_id"),
        "item_id",
        F.lit(0.0).alias("score"),
        "rank",
        F.lit("").alias("rec_reason"),
        F.lit("").alias("debug_info"),
        "singer_id",
    )


def list_with_default(defaults: DataFrame, lists: DataFrame) -> DataFrame:
    return defaults.unionByName(lists)


def random_hot(
    actions: DataFrame,
    date: str,
    pool: int = X.HOT_POOL,
    low: int = X.PLAY_MS_MIN,
    seed: int = 0,
    info: DataFrame | None = None,
    item_type: int | None = None,
) -> DataFrame:
    """A shuffled hot list of one day: the ``pool`` most played items by ``rank * random`` descending.

    A large rank is a less played item, so the order favours the lower end of the pool.
    """
    plays = numbered_plays(in_window(actions, date, 0, item_type), low, strict=True)
    counted = plays.groupBy("item_id").agg(F.count(F.lit(1)).alias("hot_rate"))
    hottest = top_rows(counted, [F.desc("hot_rate"), F.asc("item_id")], pool, "rank1")
    mixed = hottest.withColumn("mix", F.col("rank1") * hash_unit("item_id", seed))
    # The window sees at most ``pool`` rows.
    rank = F.row_number().over(W.orderBy(F.desc("mix"), F.asc("item_id"))).cast("bigint")
    ranked = mixed.select("item_id", rank.alias("rank"))
    if info is None:
        return ranked
    named = ranked.join(info, F.col("item_id") == F.col("song_id"), "left")
    text = [F.nvl(c, F.lit("")) for c in ("song_id", "song_name", "singer_name")]
    return named.select("item_id", "rank", F.concat(F.concat_ws("|", *text), F.lit("|")).alias("debug_info"))


def ordered_items(rank: Column, item: Column) -> Column:
    """Aggregate: items in rank order, whatever the shuffle did to the rows."""
    return F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("r"), item.alias("i")))), lambda x: x["i"])


def fill_and_pack(
    lists: DataFrame, hot: DataFrame, prefix: str, k: int = X.REC_MAX, defaults: DataFrame | None = None
) -> DataFrame:
    """One row per user: key and the first ``k`` items of the personal list followed by the hot list.

    ``defaults`` (any frame with user_id) adds users who get hot items only. The hot list is one value of at most
    ``k`` items, appended per user, instead of ``k`` rows for every user.
    """
    place = F.struct(F.col("rank").alias("r"), F.col("item_id").alias("i"))
    places = lists.select("user_id", F.when(F.col("rank") <= k, place).alias("x"))
    if defaults is not None:
        places = places.unionByName(defaults.select("user_id"), allowMissingColumns=True)
    # collect_list leaves out NULL: a user without rows up to rank k has an empty list and gets the filler.
    own = places.groupBy("user_id").agg(
        F.transform(F.array_sort(F.collect_list("x")), lambda x: x["i"]).alias("own")
    )
    filler = hot.filter(F.col("rank") <= k).agg(
        ordered_items(F.col("rank") + X.FILLER_OFFSET, F.col("item_id")).alias("filler")
    )
    whole = F.slice(F.concat(F.col("own"), F.nvl(filler.scalar(), F.array().cast("array<string>"))), 1, k)
    return own.select(F.concat(F.lit(prefix), "user_id").alias("user_id"), F.concat_ws(",", whole).alias("reclist"))


def version_pointer(dates: DataFrame, name: str, item_type: int = 1, scene: str = "daily_rec") -> DataFrame:
    """The pointer row for the list of a day; ``dates`` has the day in column ``d``."""
    return dates.select(
        F.lit(name).alias("versionname"),
        F.concat(F.lit("1,"), "d", F.lit(","), "d").alias("content"),
        F.lit(item_type).alias("item_type"),
        F.lit(scene).alias("scene"),
    )


def merge_recall(sources: dict[str, DataFrame], keys: list[str], k: int) -> DataFrame:
    """Union of tagged candidate frames (``keys``, item_id, score); the first source in order wins a duplicate."""
    tagged = None
    for priority, (name, df) in enumerate(sources.items(), start=1):
        part = df.select(*keys, "item_id", "score", F.lit(priority).alias("priority"), F.lit(name).alias("source"))
        tagged = part if tagged is None else tagged.unionByName(part)
    first = tagged.groupBy(*keys, "item_id").agg(
        F.min_by(F.struct("priority", "source", "score"), F.struct("priority", -F.col("score"))).alias("best")
    )
    rows = first.select(*keys, "item_id", "best.priority", "best.source", "best.score")
    return top_by(rows, keys, [F.asc("priority"), F.desc("score"), F.asc("item_id")], k)


def bid_ranking(
    ads: DataFrame, keys: list[str], ad: str, k: int, pctr: str = "pctr", cpc: str = "cpc", power: float = 1.0
) -> DataFrame:
    """score = pCTR^power * cpc; the best ``k`` ads per request."""
    scored = ads.withColumn("score", F.pow(F.col(pctr), F.lit(power)) * F.col(cpc))
    return top_by(scored, keys, [F.desc("score"), F.asc(ad)], k)
