"""Feature engineering: scaling, binning, encoding, crosses, history, feature scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillrank.functions import col, hash_feature, safe_ratio
from quillrank.operators.metrics import auc
from quillrank.plans.ranks import running_below
from quillrank.plans.skew import null_safe_join, spread_join
from quillrank.session import stage


# Scaling -----------------------------------------------------------------------------------------------------------


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean, deviation, minimum and maximum of each column."""
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [F.avg(v).alias(f"{c}_avg"), F.stddev_samp(v).alias(f"{c}_std")]
        aggs += [F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max")]
    return df.agg(*aggs)


def scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add z-score, min-max and log forms of each column, from one pass for the statistics."""
    stats = column_stats(df, columns)
    out = df.withColumn("__s", stats.select(F.struct("*")).scalar())
    for c in columns:
        v, s = F.col(c).cast("double"), lambda k: F.col(f"__s.{c}_{k}")
        out = (
            out.withColumn(f"{c}_z", safe_ratio(v - s("avg"), s("std")))
            .withColumn(f"{c}_minmax", safe_ratio(v - s("min"), s("max") - s("min")))
            .withColumn(f"{c}_log", F.when(v >= 0, F.log1p(v)))
        )
    return out.drop("__s")


def clip_peaks(df: DataFrame, column: str, share: float, accuracy: int = 10_000) -> DataFrame:
    """Cap a column at its ``share`` quantile."""
    cap = df.agg(F.percentile_approx(column, share, accuracy)).scalar()
    return df.withColumn(f"{column}_clipped", F.least(F.col(column), cap))


def binarized(c: Column | str, threshold: float) -> Column:
    return (col(c) > threshold).cast("int")


def filled(df: DataFrame, column: str) -> DataFrame:
    """Missing values take the mean; an indicator keeps missing apart from zero."""
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(f"{column}_missing", F.col(column).isNull().cast("int")).withColumn(
        f"{column}_filled", F.coalesce(F.col(column).cast("double"), mean)
    )


# Bins --------------------------------------------------------------------------------------------------------------


def width_bins(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bin numbers 1..bins between minimum and maximum."""
    stats = column_stats(df, [column]).select(F.struct("*")).scalar()
    out = df.withColumn("__s", stats)
    low, high = F.col(f"__s.{column}_min"), F.col(f"__s.{column}_max")
    # A constant column has one bin, the first.
    share = F.coalesce(safe_ratio(F.col(column) - low, high - low), F.lit(0.0))
    number = F.when(F.col(column).isNotNull(), F.floor(share * bins) + 1)
    return out.withColumn("bin", F.when(number > bins, F.lit(bins)).otherwise(number).cast("bigint")).drop("__s")


def frequency_bins(counts: DataFrame, bins: int, value: str = "value", n: str = "n") -> DataFrame:
    """Equal-frequency bins over a table with one row per value and its row count; equal values share a bin.

    The bin of a value is ``floor(rows with smaller value / all rows * bins)``.
    """
    total = counts.agg(F.sum(n)).scalar()
    below = running_below(counts, value, [n])
    return below.withColumn("bin", F.floor(F.col(f"{n}_below") * bins / total).cast("bigint")).drop(f"{n}_below")


def manual_bin(c: Column | str, edges: list[float]) -> Column:
    """0 below the first edge, then one more per edge reached."""
    out = F.lit(0).cast("bigint")
    for e in edges:
        out = out + (col(c) >= e).cast("bigint")
    return out


def gini(pos: Column, n: Column) -> Column:
    p = safe_ratio(pos, n)
    return 1.0 - p * p - (1.0 - p) * (1.0 - p)


def best_split(df: DataFrame, value: str, label: str, bins: int) -> DataFrame:
    """The pre-bin edge with the smallest weighted Gini impurity: values below it go left."""
    y = F.col(label).cast("bigint")
    counts = df.groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos"))
    per_bin = (
        frequency_bins(counts, bins)
        .groupBy("bin")
        .agg(F.min("value").alias("edge"), F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    )
    # At most ``bins`` rows from here on.
    order = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    sides = per_bin.select(
        "edge",
        F.sum("n").over(order).alias("nl"),
        F.sum("pos").over(order).alias("pl"),
        F.sum("n").over(everything).alias("n"),
        F.sum("pos").over(everything).alias("p"),
    ).filter(F.col("nl").isNotNull())
    nl, pl, n, p = (F.col(c) for c in ("nl", "pl", "n", "p"))
    impurity = (nl * gini(pl, nl) + (n - nl) * gini(p - pl, n - nl)) / n
    ranked = sides.withColumn("gini", impurity)
    return ranked.agg(F.min(F.struct(F.round("gini", 12).alias("gini"), "edge")).alias("b")).select("b.edge", "b.gini")


# Encoding ----------------------------------------------------------------------------------------------------------


def count_encoded(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    return spread_join(df, counts.withColumnRenamed("cnt", f"{column}_count"), column, weights=counts, nulls=True)


def number_encoding(df: DataFrame, column: str, most_frequent: bool = True) -> DataFrame:
    """Dictionary value -> 1..n, by frequency or by value. The window runs over distinct values."""
    from quillrank.plans.ranks import global_row_number

    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    order = [F.desc("cnt"), F.asc(column)] if most_frequent else [F.asc(column)]
    return global_row_number(counts, order, "code")


def one_hot(df: DataFrame, column: str, values: list) -> DataFrame:
    """One 0/1 column per listed value; all zero for other values."""
    return df.select("*", *[(F.col(column) == v).cast("int").alias(f"{column}_{v}") for v in values])


def hashed(df: DataFrame, column: str, buckets: int) -> DataFrame:
    return df.withColumn(f"{column}_hash", hash_feature(column, buckets))


def target_encoding(df: DataFrame, column: str, label: str, added: float, rate: float = 1.0) -> DataFrame:
    """Smoothed mean label per value of a column."""
    from quillrank.operators.ctr import smoothed_ctr

    counts = df.groupBy(column).agg(
        F.count(F.lit(1)).alias("exposure"), F.sum(F.col(label).cast("double")).alias("click")
    )
    return smoothed_ctr(counts, added, rate).withColumnRenamed("smoothed", "encoded")


def past_target_encoding(
    df: DataFrame, column: str, ts: str, tie: str, label: str, added: float, prior: float
) -> DataFrame:
    """Smoothed mean label of the earlier rows of a row's value: neither its own label nor later ones go in.

    ``prior`` is the rate that ``added`` rows before the first one are taken to have.
    """
    past = history(df, column, ts, tie, label)
    encoded = (F.col("past_sum") + prior * added) / (F.col("past_n") + F.lit(float(added)))
    return past.withColumn("encoded", encoded).drop("past_n", "past_sum", "past_mean")


def label_transfer(links: DataFrame, labels: DataFrame, owner: str, via: str, label: str) -> DataFrame:
    """Share of each label among an owner's links, labels taken over from the other side.

    Items hand their attributes to users, or users theirs to items, by swapping ``owner`` and ``via``. Links are
    counted per (owner, via) first.
    """
    counted = links.groupBy(owner, via).agg(F.count(F.lit(1)).alias("n"))
    tagged = spread_join(counted, labels.select(via, label), via)
    per_label = tagged.groupBy(owner, label).agg(F.sum("n").alias("n"))
    # One row per label of the owner.
    total = F.sum("n").over(W.partitionBy(owner))
    return per_label.withColumn("share", F.col("n").cast("double") / total)


def category_stats(df: DataFrame, category: str, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.groupBy(category).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.max(v).alias("max")
    )


def with_category_stats(df: DataFrame, category: str, value: str) -> DataFrame:
    """Every row with its category's statistics and the value over the category's mean."""
    stats = category_stats(df, category, value)
    joined = spread_join(df, stats, category, "left", weights=stats, weight="n", nulls=True)
    return joined.withColumn("ratio", safe_ratio(F.col(value), F.col("mean")))


def shares(df: DataFrame, key: str, within: str, value: str) -> DataFrame:
    """Sum per key, its share of the coarser key it lies in, and its rank there (1 + keys with a larger sum)."""
    per_key = stage(df.groupBy(within, key).agg(F.sum(value).alias("amount")), "amounts")
    totals = per_key.groupBy(within).agg(
        F.sum("amount").alias("__total"), F.count(F.lit(1)).alias("__keys"), F.count(F.lit(1)).alias("cnt")
    )
    peers = per_key.groupBy(within, "amount").agg(F.count(F.lit(1)).alias("__same"))
    below = running_below(peers, "amount", ["__same"], [within]).withColumn("__at", F.struct(within, "amount"))
    places = below.select("__at", (F.col("__same_below") + F.col("__same")).alias("__up_to"))
    rows = spread_join(per_key, totals.drop("cnt"), within, weights=totals)
    rows = spread_join(rows.withColumn("__at", F.struct(within, "amount")), places, "__at")
    return rows.select(
        within,
        key,
        "amount",
        safe_ratio(F.col("amount"), F.col("__total")).alias("share"),
        (F.col("__keys") - F.col("__up_to") + 1).alias("rank"),
    )


def trend(df: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Sum per period and the change from the period before, absolute and relative.

    Rows are summed first; the window sees one row per key and period.
    """
    sums = df.groupBy(*keys, period).agg(F.sum(value).alias("amount"))
    before = W.partitionBy(*keys).orderBy(period)
    out = sums.withColumn("change", F.col("amount") - F.lag("amount").over(before))
    return out.withColumn("growth", safe_ratio(F.col("change"), F.col("amount") - F.col("change")))


def crossed(a: Column | str, b: Column | str) -> Column:
    return F.concat_ws("_x_", col(a).cast("string"), col(b).cast("string"))


def time_features(ts: str) -> list[Column]:
    t = F.col(ts)
    return [
        F.hour(t).alias("hour"),
        F.dayofweek(t).alias("weekday"),
        F.dayofweek(t).isin(1, 7).cast("int").alias("weekend"),
        F.dayofmonth(t).alias("day"),
        F.month(t).alias("month"),
    ]


def grid_cell(x: Column | str, y: Column | str, size: float) -> Column:
    gx, gy = F.floor(col(x) / size).cast("bigint"), F.floor(col(y) / size).cast("bigint")
    return F.concat_ws("_", gx.cast("string"), gy.cast("string"))


# History -----------------------------------------------------------------------------------------------------------


def history(df: DataFrame, key: str, ts: str, tie: str, value: str, period: Column | None = None) -> DataFrame:
    """Count, sum and mean of a key's earlier rows, for every row; nothing from the row itself or later.

    A key's rows are summed per period first (day by default). A window inside (key, period) and the sums of earlier
    periods together give the same numbers as one window per key, and a hot key spreads over its periods.
    """
    period = F.date_trunc("day", F.col(ts)) if period is None else period
    rows = df.withColumn("__p", period)
    v = F.col(value).cast("double")
    sums = rows.groupBy(key, "__p").agg(F.count(F.lit(1)).alias("__n"), F.sum(v).alias("__s"))
    older = W.partitionBy(key).orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        key,
        "__p",
        F.coalesce(F.sum("__n").over(older), F.lit(0)).alias("__n0"),
        F.coalesce(F.sum("__s").over(older), F.lit(0.0)).alias("__s0"),
    )
    earlier = W.partitionBy(key, "__p").orderBy(ts, tie).rowsBetween(W.unboundedPreceding, -1)
    inside = rows.withColumn("__n1", F.count(F.lit(1)).over(earlier)).withColumn(
        "__s1", F.coalesce(F.sum(v).over(earlier), F.lit(0.0))
    )
    out = null_safe_join(inside, offsets, [key, "__p"])
    n, s = F.col("__n0") + F.col("__n1"), F.col("__s0") + F.col("__s1")
    return out.withColumns(
        {"past_n": n, "past_sum": s, "past_mean": safe_ratio(s, n)}
    ).drop("__p", "__n0", "__s0", "__n1", "__s1")


def user_value(df: DataFrame, user: str, day: Column, paid: Column) -> DataFrame:
    """Active days, first and last day, revenue and revenue per active day of each user."""
    per_day = df.groupBy(user, day.alias("day")).agg(F.sum(paid).alias("paid"), F.count(F.lit(1)).alias("n"))
    return per_day.groupBy(user).agg(
        F.count(F.lit(1)).alias("active_days"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.sum("n").alias("actions"),
        F.sum("paid").alias("ltv"),
        (F.sum("paid") / F.count(F.lit(1))).alias("arpu"),
    )


def retention(df: DataFrame, user: str, day: Column, after: int) -> DataFrame:
    """Share of a day's users who are active again ``after`` days later."""
    active = df.select(F.col(user), day.alias("day")).distinct()
    marks = active.select(user, "day", F.lit(1).alias("here"), F.lit(0).alias("back")).unionAll(
        active.select(user, F.date_sub("day", after).alias("day"), F.lit(0), F.lit(1))
    )
    per_user = marks.groupBy(user, "day").agg(F.max("here").alias("here"), F.max("back").alias("back"))
    return (
        per_user.filter("here = 1")
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("users"), F.sum("back").alias("returned"))
        .withColumn("rate", F.col("returned").cast("double") / F.col("users"))
    )


# Feature scores ----------------------------------------------------------------------------------------------------


def long_form(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, value, label, n): equal rows are counted, so a hot value is one row."""
    parts = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    return (
        df.select(F.inline(parts), F.col(label).cast("int").alias("label"))
        .groupBy("feature", "value", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def feature_auc(df: DataFrame, features: list[str], label: str) -> DataFrame:
    parts = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    rows = df.select(F.inline(parts), F.col(label).cast("int").alias("label"))
    return auc(rows, "value", "label", ["feature"])


def _xlnx(c: Column) -> Column:
    return F.when(c > 0, c * F.ln(c)).otherwise(F.lit(0.0))


def feature_information(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Gini gain, information gain, gain ratio and chi-square of each feature against a 0/1 label, in one job."""
    counts = (
        long_form(df, features, label)
        .groupBy("feature", "value")
        .agg(
            F.sum("n").cast("double").alias("n"),
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).cast("double").alias("pos"),
        )
    )
    n, pos = F.col("n"), F.col("pos")
    neg = n - pos
    sums = counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("levels"),
        F.sum(n).alias("n"),
        F.sum(pos).alias("pos"),
        F.sum(_xlnx(n)).alias("n_ln"),
        F.sum(_xlnx(pos) + _xlnx(neg)).alias("class_ln"),
        F.sum(n * gini(pos, n)).alias("gini_parts"),
        F.sum(pos * pos / n).alias("pos_sq"),
        F.sum(neg * neg / n).alias("neg_sq"),
    )
    total_neg = n - pos
    entropy = (_xlnx(n) - _xlnx(pos) - _xlnx(total_neg)) / n
    inner = (F.col("n_ln") - F.col("class_ln")) / n
    split = (_xlnx(n) - F.col("n_ln")) / n
    return sums.select(
        "feature",
        "levels",
        (gini(pos, n) - F.col("gini_parts") / n).alias("gini_gain"),
        (entropy - inner).alias("info_gain"),
        safe_ratio(entropy - inner, F.when(split > 1e-12, split)).alias("gain_ratio"),
        (n * (safe_ratio(F.col("pos_sq"), pos) + safe_ratio(F.col("neg_sq"), total_neg)) - n).alias("chi2"),
    )


def feature_moments(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Correlation with the label and between over within class variance, per feature."""
    parts = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    rows = df.select(F.inline(parts), F.col(label).cast("double").alias("label"))
    v, y = F.col("value"), F.col("label")
    sums = rows.groupBy("feature").agg(
        F.corr(v, y).alias("corr"),
        F.avg(v).alias("m"),
        *[
            a
            for k in (0, 1)
            for a in (
                F.count(F.when(y == k, v)).alias(f"n{k}"),
                F.avg(F.when(y == k, v)).alias(f"m{k}"),
                F.var_pop(F.when(y == k, v)).alias(f"v{k}"),
            )
        ],
    )
    def spread(k):
        d = F.col(f"m{k}") - F.col("m")
        return F.col(f"n{k}") * d * d

    between = spread(0) + spread(1)
    within = F.col("n0") * F.col("v0") + F.col("n1") * F.col("v1")
    return sums.select("feature", "corr", safe_ratio(between, within).alias("variance_ratio"))
