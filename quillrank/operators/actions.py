"""From a raw event log to a user-item action table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillrank import fixed as X
from quillrank.functions import as_number, version_at_least
from quillrank.plans.ranks import top_rows
from quillrank.plans.skew import spread_join

ACTION_CODES = {
    X.ACTION_PLAY: X.PLAY_EVENTS,
    X.ACTION_DOWNLOAD: X.DOWNLOAD_EVENTS,
    X.ACTION_FAVOR: X.FAVOR_EVENTS,
    X.ACTION_SWITCH: X.SWITCH_EVENTS,
    X.ACTION_SHARE: X.SHARE_EVENTS,
}


def action_code(event: Column, codes: dict[int, tuple[str, ...]] = ACTION_CODES) -> Column:
    code = F.lit(-1)
    for action, events in reversed(list(codes.items())):
        code = F.when(event.isin(*events), F.lit(action)).otherwise(code)
    return code


def payload(event: Column, params: Column, codes: dict[int, tuple[str, ...]] = ACTION_CODES) -> Column:
    """Play time for plays, an empty text for the other known events, '-1' otherwise."""
    others = [e for action, events in codes.items() if action != X.ACTION_PLAY for e in events]
    return (
        F.when(event.isin(*codes[X.ACTION_PLAY]), F.try_element_at(params, F.lit("songtime")))
        .when(event.isin(*others), F.lit(""))
        .otherwise(F.lit(X.UNKNOWN))
    )


def user_item_action(
    log: DataFrame,
    items: DataFrame,
    first_day: str | None = None,
    last_day: str | None = None,
    min_version: str = X.MIN_APP_VERSION,
    version_order: str = "string",
    time_divisor: int = X.TIME_DIVISOR,
    codes: dict[int, tuple[str, ...]] = ACTION_CODES,
    item_type: int = 1,
) -> DataFrame:
    """Known events on known items, one row per event.

    ``log``: imei, event_id, event_time, params, app_version_name, day ('yyyy-MM-dd'); ``items``: song_id.
    """
    if first_day:
        log = log.filter(F.col("day") >= first_day)
    if last_day:
        log = log.filter(F.col("day") <= last_day)
    event, params = F.col("event_id"), F.col("params")
    known = [e for events in codes.values() for e in events]
    rows = log.filter(version_at_least("app_version_name", min_version, version_order) & event.isin(*known)).select(
        F.nvl("imei", F.lit(X.UNKNOWN)).alias("user_id"),
        F.nvl(F.try_element_at(params, F.lit("songid")), F.lit(X.UNKNOWN)).alias("item_id"),
        action_code(event, codes).alias("action"),
        F.lit(-1).alias("location"),
        (F.col("event_time") / time_divisor).cast("bigint").alias("tmstamp"),
        payload(event, params, codes).alias("extend"),
        F.replace("day", F.lit("-"), F.lit("")).alias("ds"),
        F.lit(item_type).alias("item_type"),
    )
    # The log is a scan, whose row numbers are the same in every run: a salt that also splits equal events.
    known_items = items.select(F.col("song_id").alias("item_id")).distinct()
    return spread_join(rows, known_items, "item_id", "left_semi", salt=F.monotonically_increasing_id())


def in_window(df: DataFrame, last: str, days: int = 0, item_type: int | None = None) -> DataFrame:
    """Rows with ``last - days <= ds <= last`` (both ends included), ds as 'yyyyMMdd' text, of one item type if given."""
    first = F.date_format(F.date_sub(F.to_date(F.lit(last), "yyyyMMdd"), days), "yyyyMMdd")
    return of_type(df, item_type).filter((F.col("ds") <= last) & (F.col("ds") >= first))


def of_type(df: DataFrame, item_type: int | None) -> DataFrame:
    return df if item_type is None else df.filter(F.col("item_type") == item_type)


def play_threshold(
    actions: DataFrame, ms: int = X.PLAY_MS_MIN, date: str | None = None, days: int = 0, item_type: int | None = None
) -> DataFrame:
    """Distinct (user, item) with one play strictly longer than ``ms``, in a day window and of one item type if given."""
    chosen = of_type(actions, item_type) if date is None else in_window(actions, date, days, item_type)
    long_plays = chosen.filter(
        (F.col("action") == X.ACTION_PLAY) & (F.col("item_id") != X.UNKNOWN) & (as_number("extend") > ms)
    )
    return long_plays.select("user_id", "item_id").distinct().withColumn("preference", F.lit(1))


def numbered_plays(actions: DataFrame, low: int, high: int | None = None, strict: bool = False) -> DataFrame:
    """Plays by numeric users on numeric items within a play time range."""
    ms = as_number("extend")
    keep = (ms > low) if strict else (ms >= low)
    if high is not None:
        keep = keep & (ms <= high)
    return actions.filter(
        (F.col("action") == X.ACTION_PLAY) & (as_number("item_id") > 0) & (as_number("user_id") > 0) & keep
    )


def top_buyers_first_purchase(
    actions: DataFrame, k: int = 10, buy: int = 2, user: str = "user_id", when: str = "timestamp"
) -> DataFrame:
    """The ``k`` users with most purchases and the time of their first one, in that order."""
    per_user = (
        actions.filter(F.col("action") == buy)
        .groupBy(user)
        .agg(F.count(F.lit(1)).alias("buy_cnt"), F.min(when).alias("first_time"))
    )
    return top_rows(per_user, [F.desc("buy_cnt"), F.asc(user)], k, "rnk")
