"""Ranking, probability and regression metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillrank.functions import clip, col, safe_ratio
from quillrank.plans.ranks import bucket_count, range_bucket, running_below, top_by
from quillrank.plans.skew import null_safe_join
from quillrank.session import stage


def by_score(df: DataFrame, score: str, label: str, group: list[str] = []) -> DataFrame:
    """One row per (group, score) with its positives and negatives: the input of all rank metrics."""
    y = F.col(label).cast("bigint")
    return df.groupBy(*group, F.col(score).alias("score")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def auc(df: DataFrame, score: str = "prob", label: str = "label", group: list[str] = []) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL where a group has one class only.

    Scores are summed inside range buckets, then the partial results of a group are put together, one per bucket, so
    neither one group nor the whole table is ever sorted by one task.
    """
    pooled = stage(by_score(df, score, label, group), "by_score")
    cut_up = range_bucket(pooled, "score", buckets=bucket_count(pooled.count()))
    below = W.partitionBy(*group, "bucket").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    area = F.col("pos") * (F.coalesce(F.sum("neg").over(below), F.lit(0)) + F.col("neg") / 2.0)
    parts = (
        cut_up.withColumn("area", area)
        .groupBy(*group, "bucket")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("area").alias("area"))
    )
    lower = W.partitionBy(*group).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    whole = parts.withColumn("area", F.col("area") + F.col("pos") * F.coalesce(F.sum("neg").over(lower), F.lit(0)))
    out = whole.groupBy(*group).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("area").alias("area")
    )
    return out.select(*group, "pos", "neg", safe_ratio(F.col("area"), F.col("pos") * F.col("neg")).alias("auc"))


def auc_histogram(df: DataFrame, score: str = "prob", label: str = "label", width: float = 0.2) -> DataFrame:
    """Approximate AUC: all scores of one bucket of ``width`` count as tied. Scores lie in [0, 1]."""
    bucket = F.floor(F.col(score) / width)
    return auc(df.withColumn("__h", bucket.cast("double")), "__h", label)


def weighted_auc(grouped: DataFrame) -> DataFrame:
    """Mean of group AUCs, plain and weighted by rows; groups of one class are left out."""
    valid = grouped.filter(F.col("auc").isNotNull())
    n = F.col("pos") + F.col("neg")
    return valid.agg(
        F.count(F.lit(1)).alias("groups"),
        F.avg("auc").alias("mean_auc"),
        (F.sum(F.col("auc") * n) / F.sum(n)).alias("weighted_auc"),
    )


def auc_at_k(
    df: DataFrame, k: int, group: list[str], tie: str, score: str = "prob", label: str = "label"
) -> DataFrame:
    """Group AUC over each group's ``k`` best scores."""
    return auc(top_by(df, group, [F.desc(score), F.asc(tie)], k), score, label, group)


def _mean_loss(prob: str, label: str, eps: float = 1e-15) -> Column:
    p, y = clip(prob, eps), F.col(label).cast("double")
    return F.avg(-(y * F.ln(p) + (1.0 - y) * F.ln(1.0 - p)))


def logloss(df: DataFrame, prob: str = "prob", label: str = "label", group: list[str] = [], eps: float = 1e-15):
    return df.groupBy(*group).agg(_mean_loss(prob, label, eps).alias("logloss"))


def regression_errors(df: DataFrame, pred: str, actual: str, weight: str) -> DataFrame:
    e = F.col(pred) - F.col(actual)
    y = F.col(actual).cast("double")
    return df.agg(
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1.0 - safe_ratio(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"),
        safe_ratio(F.sum(F.col(weight) * F.abs(e)), F.sum(weight)).alias("wmae"),
    )


def confusion(
    df: DataFrame, threshold: float, prob: str = "prob", label: str = "label", alpha: float = 2.0, group: list[str] = []
) -> DataFrame:
    """Counts at a threshold (prob >= threshold is positive) with precision, recall and their means."""
    hit, y = F.col(prob) >= threshold, F.col(label) == 1
    counts = df.groupBy(*group).agg(
        F.count_if(hit & y).alias("tp"),
        F.count_if(hit & ~y).alias("fp"),
        F.count_if(~hit & y).alias("fn"),
        F.count_if(~hit & ~y).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p, r = F.col("precision"), F.col("recall")
    return (
        counts.withColumn("precision", safe_ratio(tp, tp + fp))
        .withColumn("recall", safe_ratio(tp, tp + fn))
        .withColumn("f1", safe_ratio(2.0 * p * r, p + r))
        .withColumn("f_alpha", safe_ratio((1.0 + alpha * alpha) * p * r, alpha * alpha * p + r))
        .withColumn("accuracy", safe_ratio(tp + tn, tp + fp + fn + tn))
        .withColumn("error_rate", safe_ratio(fp + fn, tp + fp + fn + tn))
    )


def curve(df: DataFrame, score: str = "prob", label: str = "label") -> DataFrame:
    """One row per distinct score: positives and negatives at or above it, with the class totals."""
    counts = stage(by_score(df, score, label), "by_score")
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    below = running_below(counts, "score", ["pos", "neg"]).withColumn("t", totals)
    return below.select(
        "score",
        "pos",
        "neg",
        (F.col("t.p") - F.col("pos_below")).alias("tp"),
        (F.col("t.n") - F.col("neg_below")).alias("fp"),
        F.col("t.p").alias("p"),
        F.col("t.n").alias("n"),
    )


def roc_points(df: DataFrame, score: str = "prob", label: str = "label") -> DataFrame:
    return curve(df, score, label).select(
        "score", safe_ratio(F.col("fp"), F.col("n")).alias("fpr"), safe_ratio(F.col("tp"), F.col("p")).alias("tpr")
    )


def pr_points(df: DataFrame, score: str = "prob", label: str = "label") -> DataFrame:
    tp, fp = F.col("tp"), F.col("fp")
    return curve(df, score, label).select(
        "score", safe_ratio(tp, F.col("p")).alias("recall"), safe_ratio(tp, tp + fp).alias("precision")
    )


def aupr(df: DataFrame, score: str = "prob", label: str = "label") -> DataFrame:
    """Area under the precision-recall steps: the precision at each score times the recall it adds."""
    tp, fp = F.col("tp"), F.col("fp")
    step = safe_ratio(F.col("pos"), F.col("p")) * safe_ratio(tp, tp + fp)
    return curve(df, score, label).agg(F.sum(step).alias("aupr"))


def ranking_quality(
    df: DataFrame, k: int, query: list[str], item: str, score: str = "score", relevance: str = "rel"
) -> DataFrame:
    """P@k, average precision at k and nDCG at k per query.

    Only the first ``k`` rows of a query by score, and by relevance for the ideal order, leave a map task.
    """
    rel = F.col(relevance).cast("double")
    gain = F.pow(F.lit(2.0), rel) - 1.0
    discount = F.ln(F.lit(2.0)) / F.ln(F.col("rank") + 1.0)
    ranked = top_by(df, query, [F.desc(score), F.asc(item)], k)
    seen = W.partitionBy(*query).orderBy("rank")
    hit = (rel > 0).cast("bigint")
    actual = (
        ranked.withColumn("__hits", F.sum(hit).over(seen))
        .groupBy(*query)
        .agg(
            F.sum(hit).alias("hits"),
            F.sum(hit * F.col("__hits") / F.col("rank")).alias("precisions"),
            F.sum(gain * discount).alias("dcg"),
        )
    )
    best = top_by(df, query, [F.desc(relevance), F.asc(item)], k)
    ideal = best.groupBy(*query).agg(F.sum(gain * discount).alias("idcg"), F.sum(hit).alias("wanted"))
    return actual.join(ideal, query).select(
        *query,
        (F.col("hits") / F.lit(float(k))).alias("p_at_k"),
        safe_ratio(F.col("precisions"), F.col("wanted")).alias("ap_at_k"),
        safe_ratio(F.col("dcg"), F.col("idcg")).alias("ndcg_at_k"),
    )


def welch_t(df: DataFrame, value: str, first: Column, second: Column) -> DataFrame:
    """Welch's t statistic and degrees of freedom between two sets of rows."""

    def side(cond: Column, name: str):
        v = F.when(cond, F.col(value).cast("double"))
        return [
            F.count(v).alias(f"n{name}"),
            F.avg(v).alias(f"mean{name}"),
            (F.var_samp(v) / F.count(v)).alias(f"se{name}"),
        ]

    stats = df.agg(*side(first, "1"), *side(second, "2"))
    s1, s2 = F.col("se1"), F.col("se2")
    return stats.select(
        "n1",
        "n2",
        "mean1",
        "mean2",
        ((F.col("mean1") - F.col("mean2")) / F.sqrt(s1 + s2)).alias("t"),
        ((s1 + s2) * (s1 + s2) / (s1 * s1 / (F.col("n1") - 1) + s2 * s2 / (F.col("n2") - 1))).alias("dof"),
    )


def metric_report(df: DataFrame, segment: str, prob: str = "prob", label: str = "label") -> DataFrame:
    """AUC, logloss and predicted over actual rate per segment: shows where the two disagree."""
    ranks = auc(df, prob, label, [segment]).select(segment, "auc")
    rates = df.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n"),
        safe_ratio(F.avg(prob), F.avg(F.col(label).cast("double"))).alias("ratio"),
        _mean_loss(prob, label).alias("logloss"),
    )
    return null_safe_join(rates, ranks, [segment])


def average_score(df: DataFrame, score: Column | str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_count"), F.avg(col(score)).alias("average_score"))

