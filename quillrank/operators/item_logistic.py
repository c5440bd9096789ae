"""Logistic regression on the one-hot item id, solved per item."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from quillrank.functions import logistic, logit, safe_ratio
from quillrank.session import stage

# Halvings of an item's interval, and rounds of the bias at most.
HALVINGS, ROUNDS = 64, 100
CLOSE = 1e-11


def _coefficient(n: Column, k: Column, bias: float, penalty: float) -> Column:
    """The root of n * logistic(bias + c) - k + penalty * c, which rises in c and lies in [(k - n) / penalty, k / penalty]."""

    def halved(ends: Column, _: Column) -> Column:
        low, high = ends["low"], ends["high"]
        middle = (low + high) / 2.0
        above = n * logistic(F.lit(bias) + middle) - k + F.lit(penalty) * middle > 0
        return F.struct(F.when(above, low).otherwise(middle).alias("low"), F.when(above, middle).otherwise(high).alias("high"))

    ends = F.struct(((k - n) / penalty).alias("low"), (k / penalty).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), ends, halved, lambda e: (e["low"] + e["high"]) / 2.0)


def _bias(shapes: DataFrame, rate: float, penalty: float) -> float:
    """The bias at which the coefficients of all items add up to zero: Newton steps inside a shrinking interval."""
    bias, low, high = math.log(rate / (1.0 - rate)), -math.inf, math.inf
    for _ in range(ROUNDS):
        solved = shapes.withColumn("c", _coefficient(F.col("n"), F.col("k"), bias, penalty))
        p = logistic(F.lit(bias) + F.col("c"))
        curve = F.col("n") * p * (1.0 - p)
        sums = solved.agg(
            F.sum(F.col("items") * F.col("c")).alias("rest"), F.sum(F.col("items") * curve / (curve + penalty)).alias("slope")
        ).first()
        if sums["rest"] > 0:
            low = bias
        else:
            high = bias
        step = sums["rest"] / sums["slope"]
        if abs(step) <= CLOSE * (1.0 + abs(bias)):
            return bias + step
        inside = low < bias + step < high
        bias = bias + step if inside else (low + high) / 2.0
    raise ArithmeticError(f"the bias did not settle in {ROUNDS} rounds")


def fit_items(rows: DataFrame, item: str, label: str = "label", penalty: float = 1.0) -> DataFrame:
    """(item, n, k, coefficient, bias, prob): shown and clicked rows of each item and its click probability.

    The model is logistic(bias + coefficient of the item); the loss is the negative log-likelihood plus penalty / 2 times
    the squared coefficients, the bias is free. Given the bias every item is solved alone, where its row lies, and items
    of equal counts have one solution; only the bias and two sums a round pass through the driver. Rows without a label are
    left out; null is an item. Without penalty, or where all labels are equal, prob is the item's (or the common) rate
    and the bias is 0 or null.
    """
    counts = rows.filter(F.col(label).isNotNull()).groupBy(item).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("k")
    )
    counts = stage(counts, "item_counts")
    number = lambda x: F.lit(x).cast("double")
    if penalty == 0:
        rate = safe_ratio(F.col("k"), F.col("n"))
        known = F.when((F.col("k") > 0) & (F.col("k") < F.col("n")), logit(rate))
        return counts.select(item, "n", "k", known.alias("coefficient"), number(0.0).alias("bias"), rate.alias("prob"))
    shapes = stage(counts.groupBy("n", "k").agg(F.count(F.lit(1)).alias("items")), "item_shapes")
    total = shapes.agg(F.sum(F.col("n") * F.col("items")).alias("n"), F.sum(F.col("k") * F.col("items")).alias("k")).first()
    if not total["k"] or total["k"] == total["n"]:
        common = number(1.0 if total["k"] else 0.0)
        return counts.select(item, "n", "k", number(0.0).alias("coefficient"), number(None).alias("bias"), common.alias("prob"))
    bias = _bias(shapes, total["k"] / total["n"], float(penalty))
    fitted = counts.withColumn("coefficient", _coefficient(F.col("n"), F.col("k"), bias, float(penalty)))
    return fitted.select(
        item, "n", "k", "coefficient", number(bias).alias("bias"), logistic(F.lit(bias) + F.col("coefficient")).alias("prob")
    )
