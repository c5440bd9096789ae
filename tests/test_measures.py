"""Metrics, click-through rates, features."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillrank.operators import ctr as K, features as X, metrics as E, sampling as P
from quillrank.plans import ranks, skew

SAMPLE = [(0.5, 0), (0.3, 1), (0.2, 0), (0.8, 1), (0.7, 1)]


def scored(spark, data):
    return spark.createDataFrame([(float(p), int(y)) for p, y in data], "prob double, label int")


def brute_auc(data):
    pos = [p for p, y in data if y]
    neg = [p for p, y in data if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_golden(spark):
    assert E.auc(scored(spark, SAMPLE)).first().auc == pytest.approx(0.8333333333)


def test_auc_matches_pairs_and_is_rank_based(spark):
    rnd = random.Random(1)
    data = [(round(rnd.random() ** 3, 2), rnd.random() < 0.3) for _ in range(800)]
    df = scored(spark, data)
    exact = brute_auc(data)
    assert E.auc(df).first().auc == pytest.approx(exact, abs=1e-12)
    assert E.auc(df.withColumn("prob", F.exp("prob") * 9 - 4)).first().auc == pytest.approx(exact, abs=1e-12)
    assert E.auc(df.withColumn("label", 1 - F.col("label"))).first().auc == pytest.approx(1 - exact, abs=1e-12)


def test_auc_with_a_hot_score_and_a_hot_group(spark):
    rnd = random.Random(2)
    rows = [("hot", 0.5, i % 3 == 0) for i in range(3000)]
    rows += [("hot" if rnd.random() < 0.5 else f"g{rnd.randint(0, 20)}", rnd.random(), rnd.random() < 0.4) for _ in range(3000)]
    df = spark.createDataFrame([(g, p, int(y)) for g, p, y in rows], "g string, prob double, label int")
    for r in E.auc(df, group=["g"]).collect():
        assert r.auc == pytest.approx(brute_auc([(p, y) for g, p, y in rows if g == r.g]), abs=1e-12)


GRID = [("A", [0, 1, 1, 1], 0.7), ("B", [0, 0, 1, 1], 0.6), ("C", [0, 0, 0, 1], 0.5)]


def test_grouped_auc_golden(spark):
    df = spark.createDataFrame(
        [(u, i + 1, p, y) for u, ys, p in GRID for i, y in enumerate(ys)], "user string, item int, prob double, label int"
    )
    assert {r.auc for r in E.auc(df, group=["user"]).collect()} == {0.5}
    items = {r.item: r.auc for r in E.auc(df, group=["item"]).collect()}
    assert items == {1: None, 2: 1.0, 3: 1.0, 4: None}
    assert E.auc(df).first().auc == pytest.approx(0.7222222222)
    assert E.weighted_auc(E.auc(df, group=["item"])).first().groups == 2


def test_auc_of_one_class_is_null(spark):
    assert E.auc(scored(spark, [(0.1, 1), (0.4, 1)])).first().auc is None


def test_logloss_clips(spark):
    got = E.logloss(scored(spark, [(0.0, 1), (1.0, 1)])).first().logloss
    assert got == pytest.approx(-math.log(1e-15) / 2, rel=1e-6)


def test_curves(spark):
    df = scored(spark, SAMPLE)
    roc = {r.score: (r.fpr, r.tpr) for r in E.roc_points(df).collect()}
    assert roc[0.7] == (0.0, pytest.approx(2 / 3)) and roc[0.2] == (1.0, 1.0)
    assert E.aupr(df).first().aupr == pytest.approx((1 + 1 + 3 / 4) / 3)


CALIB = [(0.8, i < 8) for i in range(10)] + [(0.5, i < 5) for i in range(10)] + [(0.3, i < 3) for i in range(10)]


def test_calibration_golden(spark):
    df = scored(spark, CALIB)
    bins = {round(r.mean_prob, 6): r.mean_label for r in K.calibration_bins(df, 3).collect()}
    assert bins == {0.8: 0.8, 0.5: 0.5, 0.3: 0.3}
    assert E.logloss(df).first().logloss == pytest.approx(0.6014713021)
    assert E.auc(df).first().auc == pytest.approx(0.7232142857)


def test_isotonic_is_monotone_and_keeps_the_mean(spark):
    rnd = random.Random(5)
    df = scored(spark, [(p := rnd.random(), rnd.random() < p * p) for _ in range(2000)])
    fit = K.isotonic_calibration(K.calibration_bins(df, 40)).orderBy("bin").collect()
    values = [r.calibrated for r in fit]
    assert values == sorted(values)
    assert sum(r.calibrated * r.n for r in fit) == pytest.approx(sum(r.pos for r in fit))


def test_smoothing_golden(spark):
    df = spark.createDataFrame([("A", 100000, 20000), ("B", 10000, 1000), ("C", 10, 5)], "item string, exposure bigint, click bigint")
    got = {r.item: r.smoothed for r in K.smoothed_ctr(df, 1000).collect()}
    assert got == {
        "A": pytest.approx(0.199910, abs=1e-6), "B": pytest.approx(0.108267, abs=1e-6), "C": pytest.approx(0.193997, abs=1e-6)
    }
    assert max(got, key=got.get) == "A"
    small = {r.item: r.smoothed for r in K.smoothed_ctr(df, 100).collect()}
    assert max(small, key=small.get) == "C" and small["C"] == pytest.approx(0.219034, abs=1e-6)
    prior = 21005 / 110010
    for item, e, c in (("A", 100000, 20000), ("B", 10000, 1000), ("C", 10, 5)):
        low, high = sorted((c / e, prior))
        assert low <= got[item] <= high


def test_undo_sampling_golden(spark):
    df = spark.sql("SELECT * FROM VALUES (0.1D), (0.5D), (0.9D) AS t(p)")
    got = df.select(K.undo_sampling("p", 0.1), K.undo_sampling_logit("p", 0.1)).collect()
    for (a, b), want in zip(got, (0.0109890110, 0.0909090909, 0.4736842105)):
        assert a == pytest.approx(want) and b == pytest.approx(want)


def test_running_below_and_row_number(spark):
    rnd = random.Random(7)
    values = sorted({round(rnd.random(), 3) for _ in range(900)} | {float(i) for i in range(50)})
    df = spark.createDataFrame([(v, i % 5 + 1) for i, v in enumerate(values)], "value double, n int").repartition(5)
    got = {r.value: r.n_below for r in ranks.running_below(df, "value", ["n"], buckets=32).collect()}
    total = 0
    for i, v in enumerate(values):
        assert got[v] == total
        total += i % 5 + 1
    numbered = ranks.global_row_number(df, [F.asc("n"), F.asc("value")]).orderBy("rank").collect()
    assert [r["rank"] for r in numbered] == list(range(1, len(values) + 1))
    assert [(r.n, r.value) for r in numbered] == sorted((r.n, r.value) for r in numbered)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("way", ["broadcast", "weighted", "uniform", "numbered"])
def test_spread_join_equals_a_plain_join(spark, rows, how, way, monkeypatch):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1500).alias("k"))
    right = spark.range(0, 1500, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    if way != "broadcast":
        monkeypatch.setattr(skew, "SMALL_ROWS", 10)
        monkeypatch.setattr(skew, "HEAVY", 7)
    more = {}
    if way == "weighted":
        more["weights"] = left.groupBy("k").agg(F.count(F.lit(1)).alias("cnt"))
    if way == "numbered":
        more["salt"] = F.monotonically_increasing_id()
    joined = skew.spread_join(left, right, "k", how, **more)
    assert rows(joined) == rows(left.join(right, "k", how))


def test_a_hot_key_is_spread_over_partitions(spark, monkeypatch):
    monkeypatch.setattr(skew, "SMALL_ROWS", 10)
    left = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    hot = skew.heavy_keys(left.groupBy("k").agg(F.count(F.lit(1)).alias("cnt")), "k", "cnt")
    per_salt = skew.salted(left, hot, "k", 32).filter("k = 0").groupBy("__salt").count().collect()
    assert len(per_salt) == 32 and max(r["count"] for r in per_salt) < 200


def test_running_below_within_groups(spark):
    rnd = random.Random(8)
    data = {(g, round(rnd.random(), 2)): rnd.randint(1, 5) for g in "aab" for _ in range(300)}
    df = spark.createDataFrame([(g, v, n) for (g, v), n in data.items()], "g string, value double, n int")
    for r in ranks.running_below(df, "value", ["n"], ["g"], buckets=32).collect():
        assert r.n_below == sum(n for (g, v), n in data.items() if g == r.g and v < r.value)


def test_shares_and_ranks(spark, rows):
    df = spark.createDataFrame([("g", "x", 2), ("g", "x", 1), ("g", "y", 3), ("g", "z", 4), ("h", "x", 5)], "g string, k string, v int")
    got = {(r.g, r.k): (r.amount, round(r.share, 3), r["rank"]) for r in X.shares(df, "k", "g", "v").collect()}
    assert got == {("g", "x"): (3, 0.3, 2), ("g", "y"): (3, 0.3, 2), ("g", "z"): (4, 0.4, 1), ("h", "x"): (5, 1.0, 1)}


SALTED = [
    "action_matrix", "recommend_items", "association_diverse", "tfidf", "pagerank", "label_transfer", "count_encode",
    "naive_bayes_predict", "anomaly_scores", "pooled_embeddings", "q_update", "skip_above", "share_rank",
]


@pytest.mark.parametrize("name", SALTED)
def test_queries_agree_on_the_salted_way(spark, name, monkeypatch):
    from compare import compare, duck

    monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    monkeypatch.setattr(skew, "HEAVY", 5)
    folder = "/root/testdata/sf0.001"
    assert compare(spark, duck(folder), folder, name, empty_ok=True) is None


def test_frequency_bins_hold_equal_shares(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("value"), F.lit(1).alias("n"))
    per_bin = X.frequency_bins(df, 8).groupBy("bin").count().collect()
    assert {r["count"] for r in per_bin} == {125}


def test_best_split_finds_the_step(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"), (F.col("id") >= 600).cast("int").alias("y"))
    row = X.best_split(df, "v", "y", 10).first()
    assert row.edge == 600.0 and row.gini == pytest.approx(0.0)


def test_history_sees_the_past_only(spark):
    rnd = random.Random(9)
    data = [(i, rnd.choice("aab"), rnd.randint(0, 5 * 86400), rnd.random()) for i in range(400)]
    df = spark.createDataFrame(data, "id int, k string, sec bigint, v double").withColumn("ts", F.timestamp_seconds("sec"))
    for r in X.history(df, "k", "ts", "id", "v").collect():
        past = [v for i, k, s, v in data if k == r.k and (s, i) < (r.sec, r.id)]
        assert r.past_n == len(past) and r.past_sum == pytest.approx(sum(past))
        assert (r.past_mean is None) if not past else r.past_mean == pytest.approx(sum(past) / len(past))


def test_missing_and_zero_stay_apart(spark):
    df = spark.createDataFrame([(1, 0.0), (2, None), (3, 3.0)], "id int, x double")
    got = {r.id: (r.x_missing, r.x_filled) for r in X.filled(df, "x").collect()}
    assert got == {1: (0, 0.0), 2: (1, 1.5), 3: (0, 3.0)}


def test_skip_above(spark, rows):
    df = spark.createDataFrame([(1, 1, 0), (1, 2, 1), (1, 3, 0), (2, 1, 0)], "q int, pos int, label int")
    assert rows(P.skip_above(df, "q", "pos", "label"), "q", "pos") == [(1, 1), (1, 2)]


def test_splits_are_stable_and_even(spark):
    df = spark.range(20000)
    arms = {r.arm: r["count"] for r in df.select(P.ab_group("id", "s", {"a": 10, "b": 50}).alias("arm")).groupBy("arm").count().collect()}
    assert abs(arms["a"] - 2000) < 200 and abs(arms["b"] - 10000) < 400
    mean = df.select(F.avg(P.bootstrap_weight("id"))).first()[0]
    assert mean == pytest.approx(1.0, abs=0.03)
    kept = P.drop_negatives(df.withColumn("label", (F.col("id") < 100).cast("int")), "id", "label", 0.1)
    assert kept.filter("label = 1").count() == 100 and abs(kept.count() - 2090) < 200


def test_ranking_quality(spark):
    df = spark.createDataFrame([("q", i, s, r) for i, s, r in ((1, 0.9, 0), (2, 0.8, 2), (3, 0.1, 1))], "query string, item int, score double, rel int")
    row = E.ranking_quality(df, 2, ["query"], "item").first()
    assert row.p_at_k == 0.5 and row.ap_at_k == pytest.approx(0.25)
    assert row.ndcg_at_k == pytest.approx((3 / math.log2(3)) / (3 + 1 / math.log2(3)))


def test_welch(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 9.0]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g string, v double")
    row = E.welch_t(df, "v", F.col("g") == "a", F.col("g") == "b").first()
    sa, sb = np.var(a, ddof=1) / 4, np.var(b, ddof=1) / 3
    assert row.t == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(sa + sb))
    assert row.dof == pytest.approx((sa + sb) ** 2 / (sa**2 / 3 + sb**2 / 2))


@pytest.mark.parametrize("weighted", [False, True])
def test_a_side_that_is_not_small_is_never_broadcast(spark, monkeypatch, weighted):
    monkeypatch.setattr(skew, "SMALL_ROWS", 10)
    left = spark.range(3000).select("id", (F.col("id") % 1500).alias("k"))
    right = spark.range(1500).select(F.col("id").alias("k"), F.col("id").alias("v"))
    more = {"weights": left.groupBy("k").agg(F.count(F.lit(1)).alias("cnt"))} if weighted else {}
    joined = skew.spread_join(left, right, "k", **more)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [k" in plan and joined.count() == 3000
    if not weighted:
        assert "Broadcast" not in plan


def test_a_side_of_few_long_rows_is_not_broadcast(spark):
    """18 MB of text in 3,000 rows: the driver would hold it several times over."""
    left = spark.range(6000).select("id", (F.col("id") % 3000).alias("k"))
    right = spark.range(3000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 6000).alias("v"))
    joined = skew.spread_join(left, right, "k")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 6000
