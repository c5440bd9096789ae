"""Exploration: epsilon-greedy, Thompson sampling, UCB, linear UCB, and Q values from logs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quillrank.functions import hash_slot, hash_unit, safe_ratio
from quillrank.operators.ctr import smoothed_ctr
from quillrank.functions.udfs import beta_sample
from quillrank.plans.skew import spread_join
from quillrank.session import stage


def epsilon_greedy(users: DataFrame, user: str, arms: list, best, epsilon: float, seed: int = 0) -> DataFrame:
    """The best arm, or with share ``epsilon`` a random one, both fixed per user."""
    pick = F.element_at(F.array(*[F.lit(a) for a in arms]), hash_slot(user, len(arms), f"{seed}a").cast("int") + 1)
    explore = hash_unit(user, seed) < epsilon
    return users.select(
        user, F.when(explore, pick).otherwise(F.lit(best)).alias("arm"), explore.cast("int").alias("explored")
    )


def greedy_by_ctr(
    users: DataFrame, user: str, counts: DataFrame, arm: str, epsilon: float, added: float, seed: int = 0
) -> DataFrame:
    """Epsilon-greedy over the arms of ``counts`` (arm, exposure, click); the best one has the highest smoothed CTR.

    Arms travel as one array, so there should be few of them; ties go to the smaller arm.
    """
    rated = smoothed_ctr(counts, added).select(F.struct((-F.col("smoothed")).alias("s"), F.col(arm).alias("arm")).alias("a"))
    ordered = F.transform(F.array_sort(F.collect_list("a")), lambda x: x["arm"])
    listed = stage(rated.agg(ordered.alias("arms")), "arms").first()["arms"]
    return epsilon_greedy(users, user, sorted(listed), listed[0], epsilon, seed)


def thompson(arms: DataFrame, arm: str, click: str = "click", exposure: str = "exposure", seed: int = 0) -> DataFrame:
    """One Beta(click + 1, miss + 1) draw per arm, repeatable per (arm, seed)."""
    key = F.xxhash64(F.col(arm), F.lit(seed))
    draw = beta_sample((F.col(click) + 1).cast("double"), (F.col(exposure) - F.col(click) + 1).cast("double"), key)
    return arms.withColumn("draw", draw)


def ucb(arms: DataFrame, click: str = "click", exposure: str = "exposure") -> DataFrame:
    """Mean plus sqrt(2 ln N / n); an arm that was never shown comes first, with an infinite value."""
    total = arms.agg(F.sum(exposure).cast("double")).scalar()
    n = F.col(exposure).cast("double")
    value = safe_ratio(F.col(click), n) + F.sqrt(safe_ratio(2.0 * F.ln(total), n))
    return arms.withColumn("ucb", F.when(n > 0, value).otherwise(F.lit(float("inf"))))


def lin_ucb(log: DataFrame, arm: str, features: list[str], reward: str, alpha: float = 1.0, ridge: float = 1.0):
    """Per arm: theta = (X'X + ridge I)^-1 X'r, and mean + alpha * width at the arm's mean context.

    X'X and X'r are sums, so Spark adds them up; the solver sees one row of numbers per arm.
    """
    d = len(features)
    x = [F.col(f).cast("double") for f in features]
    r = F.col(reward).cast("double")
    sums = log.groupBy(arm).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(x[i] * x[j]) for i in range(d) for j in range(d)]).alias("xx"),
        F.array(*[F.sum(x[i] * r) for i in range(d)]).alias("xr"),
        F.array(*[F.avg(x[i]) for i in range(d)]).alias("context"),
    )

    @F.pandas_udf("struct<theta:array<double>,score:double>")
    def solve(xx: pd.Series, xr: pd.Series, context: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, c in zip(xx, xr, context):
            m = np.asarray(a).reshape(d, d) + ridge * np.eye(d)
            theta = np.linalg.solve(m, np.asarray(b))
            c = np.asarray(c)
            out.append((theta.tolist(), float(theta @ c + alpha * np.sqrt(c @ np.linalg.solve(m, c)))))
        return pd.DataFrame(out, columns=["theta", "score"])

    return sums.withColumn("s", solve("xx", "xr", "context")).select(arm, "n", "s.theta", "s.score")


def q_values(
    log: DataFrame, rounds: int, lr: float = 0.8, gamma: float = 0.95, keep: int = 3
) -> DataFrame:
    """Q(s, a) from logged (s, a, r, s2): ``rounds`` sweeps of Q += lr * (mean(r + gamma * max Q(s2)) - Q).

    Transitions are counted per (s, a, s2) once; a state without actions has value 0.
    """
    moves = log.groupBy("s", "a", "s2").agg(F.count(F.lit(1)).alias("n"), F.sum("r").cast("double").alias("r"))
    moves = stage(moves, "moves")
    into = moves.groupBy("s2").agg(F.count(F.lit(1)).alias("cnt"))
    q = moves.groupBy("s", "a").agg(F.lit(0.0).alias("q"))
    for i in range(1, rounds + 1):
        value = q.groupBy(F.col("s").alias("s2")).agg(F.max("q").alias("v"))
        seen = spread_join(moves, value, "s2", "left", weights=into)
        target = F.sum(F.col("r") + gamma * F.col("n") * F.coalesce(F.col("v"), F.lit(0.0))) / F.sum("n")
        goals = seen.groupBy("s", "a").agg(target.alias("goal"))
        q = q.join(goals, ["s", "a"]).select("s", "a", (F.col("q") + lr * (F.col("goal") - F.col("q"))).alias("q"))
        if i % keep == 0 and i < rounds:
            q = stage(q, "q")
    return q


def greedy_action(q: DataFrame) -> DataFrame:
    best = q.groupBy("s").agg(F.max(F.struct("q", "a")).alias("b"))
    return best.select("s", F.col("b.a").alias("a"), "b.q")

