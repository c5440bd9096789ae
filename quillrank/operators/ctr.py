"""Click-through rates: smoothing, calibration and cost."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from quillrank.functions import col, logistic, logit, safe_ratio
from quillrank.operators.features import frequency_bins
from quillrank.session import stage


def item_ctr(df: DataFrame, keys: list[str], exposure: str = "exposure", click: str = "click") -> DataFrame:
    """Exposures, clicks and CTR per key: the popularity baseline when ordered by ctr."""
    sums = df.groupBy(*keys).agg(F.sum(exposure).alias("exposure"), F.sum(click).alias("click"))
    return sums.withColumn("ctr", safe_ratio(F.col("click"), F.col("exposure")))


def smoothed_ctr(
    counts: DataFrame, added: float, rate: float = 1.0, exposure: str = "exposure", click: str = "click"
) -> DataFrame:
    """(click + a) / (exposure + b) with b = ``added`` and a / b = global CTR * ``rate``."""
    prior = counts.agg(safe_ratio(F.sum(click), F.sum(exposure)) * rate).scalar()
    smooth = (F.col(click) + prior * added) / (F.col(exposure) + F.lit(float(added)))
    return counts.withColumn("smoothed", smooth)


def calibration_bins(df: DataFrame, bins: int, prob: str = "prob", label: str = "label") -> DataFrame:
    """Equal-frequency bins by predicted value with mean prediction and mean label."""
    y = F.col(label).cast("bigint")
    pooled = df.groupBy(F.col(prob).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos"))
    binned = frequency_bins(pooled, bins)
    n = F.sum("n")
    return binned.groupBy("bin").agg(
        n.alias("n"),
        F.sum("pos").alias("pos"),
        (F.sum(F.col("value") * F.col("n")) / n).alias("mean_prob"),
        (F.sum("pos") / n).alias("mean_label"),
    )


def isotonic_calibration(bins: DataFrame, x: str = "mean_prob", y: str = "mean_label", weight: str = "n") -> DataFrame:
    """Monotone calibrated value per bin. The fit sees one row per bin, not the samples."""
    bins = stage(bins, "calibration_bins")
    points = VectorAssembler(inputCols=[x], outputCol="__x").transform(
        bins.withColumn("__w", F.col(weight).cast("double"))
    )
    model = IsotonicRegression(featuresCol="__x", labelCol=y, weightCol="__w", predictionCol="calibrated").fit(points)
    return model.transform(points).drop("__x", "__w")


def power_calibration(p: Column | str, k: float, a: float, b: float = 0.0) -> Column:
    return F.lit(k) * F.pow(col(p), F.lit(a)) + F.lit(b)


def fit_power(bins: DataFrame, x: str = "mean_prob", y: str = "mean_label") -> DataFrame:
    """Slope and factor of ln y over ln x, from bins with both values above zero."""
    ok = bins.filter((F.col(x) > 0) & (F.col(y) > 0)).select(F.ln(x).alias("lx"), F.ln(y).alias("ly"))
    fit = ok.agg(
        (F.covar_samp("lx", "ly") / F.var_samp("lx")).alias("a"), F.avg("lx").alias("mx"), F.avg("ly").alias("my")
    )
    return fit.select("a", F.exp(F.col("my") - F.col("a") * F.col("mx")).alias("k"))


def undo_sampling(p: Column | str, w: float) -> Column:
    """Probability before the negatives were sampled at rate ``w``."""
    return col(p) / (col(p) + (1.0 - col(p)) / w)


def undo_sampling_logit(p: Column | str, w: float) -> Column:
    """The same correction as a shift of the logit by ln w."""
    return logistic(logit(p) + F.ln(F.lit(w)))


def tier(c: Column | str, edges: list[float]) -> Column:
    """Number of ``edges`` at or below the value."""
    out = F.lit(0)
    for e in edges:
        out = out + (col(c) >= e).cast("int")
    return out


def calibration_report(df: DataFrame, tiers: list[str], prob: str = "prob", label: str = "label") -> DataFrame:
    """Predicted over actual rate by tier."""
    y = F.col(label).cast("double")
    return df.groupBy(*tiers).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(prob).alias("predicted"),
        F.avg(y).alias("actual"),
        safe_ratio(F.avg(prob), F.avg(y)).alias("ratio"),
    )


def campaign_costs(df: DataFrame, keys: list[str], cost: Column, shown: Column, clicked: Column, acted: Column):
    """CPC, CPM and CPA per campaign."""
    sums = df.groupBy(*keys).agg(
        F.sum(cost).alias("cost"),
        F.count_if(shown).alias("exposures"),
        F.count_if(clicked).alias("clicks"),
        F.count_if(acted).alias("actions"),
    )
    return (
        sums.withColumn("cpc", safe_ratio(F.col("cost"), F.col("clicks")))
        .withColumn("cpm", safe_ratio(F.col("cost") * 1000.0, F.col("exposures")))
        .withColumn("cpa", safe_ratio(F.col("cost"), F.col("actions")))
    )
