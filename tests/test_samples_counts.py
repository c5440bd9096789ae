"""Isotonic fit on samples, one-hot item regression, united user counts."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillrank.operators import distinct as D, isotonic as I
from quillrank.operators.item_logistic import fit_items
from quillrank.plans import ranks
from quillrank.streaming import counters
from quillrank.streaming.decayed import decayed_ctr


def max_min(points):
    """The isotonic fit by its textbook formula over (value, weight, total)."""
    points = sorted(points)
    out = {}
    for i, (value, _, _) in enumerate(points):
        best = -np.inf
        for a in range(i + 1):
            least = min(
                sum(p[2] for p in points[a : z + 1]) / sum(p[1] for p in points[a : z + 1]) for z in range(i, len(points))
            )
            best = max(best, least)
        out[value] = best
    return out


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_isotonic_is_the_max_min_fit(spark, monkeypatch, ranges):
    monkeypatch.setattr(I, "bucket_count", lambda rows: max(ranges, 2))
    rng = np.random.default_rng(ranges)
    score = rng.integers(0, 60, 400) / 60.0
    label = (rng.random(400) < np.sin(5 * score) ** 2).astype(int)
    weight = rng.integers(1, 4, 400).astype(float)
    df = spark.createDataFrame(list(zip(score.tolist(), label.tolist(), weight.tolist())), "prob double, label int, w double")
    got = {r["value"]: r["calibrated"] for r in I.isotonic(df, weight="w").collect()}
    points = [(s, weight[score == s].sum(), (weight * label)[score == s].sum()) for s in np.unique(score).tolist()]
    want = max_min(points)
    assert got.keys() == want.keys()
    assert all(abs(got[v] - want[v]) < 1e-9 for v in want)


def test_isotonic_of_rising_falling_and_no_rows(spark):
    schema = "prob double, label double"
    rising = I.isotonic(spark.createDataFrame([(i / 10, i * 1.0) for i in range(10)], schema)).collect()
    assert all(abs(r["calibrated"] - 10 * r["value"]) < 1e-9 for r in rising)
    falling = I.isotonic(spark.createDataFrame([(i / 10, -i * 1.0) for i in range(10)], schema)).collect()
    assert {r["calibrated"] for r in falling} == {-4.5}
    assert I.isotonic(spark.createDataFrame([(None, 1.0), (0.5, None)], schema)).collect() == []


def test_buckets_follow_the_rows():
    assert ranks.bucket_count(0) == ranks.bucket_count(10**8) == 256
    assert ranks.bucket_count(10**9) == 1000
    assert ranks.bucket_count(10**13) == ranks.MOST_BUCKETS


def test_running_sums_are_the_same_for_any_number_of_buckets(spark, rows):
    df = spark.range(500).select((F.col("id") * 7 % 501).cast("double").alias("v"), (F.col("id") % 5).alias("n"))
    wanted = rows(ranks.running_below(df, "v", ["n"]), "v", "n_below")
    for buckets in (300, 1000):
        assert rows(ranks.running_below(df, "v", ["n"], buckets=buckets), "v", "n_below") == wanted


def dense(n, k, penalty):
    """Newton steps on the bias and all coefficients together."""
    x = np.zeros(len(n) + 1)
    for _ in range(200):
        p = 1 / (1 + np.exp(-(x[0] + x[1:])))
        slope = np.append((n * p - k).sum(), n * p - k + penalty * x[1:])
        s = n * p * (1 - p)
        hessian = np.diag(np.append(s.sum(), s + penalty))
        hessian[0, 1:] = hessian[1:, 0] = s
        x -= np.linalg.solve(hessian, slope)
    return x


@pytest.mark.parametrize("penalty", [0.3, 1.0, 20.0])
def test_items_equal_the_dense_solution(spark, penalty):
    rng = np.random.default_rng(3)
    n = rng.integers(1, 40, 12)
    k = rng.binomial(n, 0.2)
    k[0] = n[0]
    data = [(None if i == 5 else f"i{i}", int(j < k[i])) for i in range(12) for j in range(n[i])]
    got = {r["item"]: r for r in fit_items(spark.createDataFrame(data, "item string, label int"), "item", penalty=penalty).collect()}
    want = dense(n, k, penalty)
    for i in range(12):
        row = got[None if i == 5 else f"i{i}"]
        assert (row["n"], row["k"]) == (n[i], k[i])
        assert abs(row["bias"] - want[0]) < 1e-8 and abs(row["coefficient"] - want[1 + i]) < 1e-8


def test_items_without_penalty_or_with_one_class(spark, rows):
    schema = "item string, label int"
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), (None, 1), ("c", None)], schema)
    assert sorted(((r["item"] or ""), r["prob"]) for r in fit_items(df, "item", penalty=0).collect()) == [("", 1.0), ("a", 0.5), ("b", 0.0)]
    none = fit_items(spark.createDataFrame([("a", 0), ("b", 0)], schema), "item")
    assert rows(none, "item", "prob", "bias") == [("a", 0.0, None), ("b", 0.0, None)]
    assert fit_items(spark.createDataFrame([], schema), "item").collect() == []


def test_users_of_many_days_from_daily_tables(spark, tmp_path):
    hits = spark.range(60_000).select(
        F.expr("timestamp'2024-01-01 05:00:00' + make_interval(0, 0, 0, cast(id % 10 as int))").alias("ts"),
        F.when(F.col("id") % 10 < 8, "hot").otherwise("other").alias("url"),
        (F.col("id") % 20_011).alias("user"),
    )
    path = str(tmp_path / "days")
    days = D.daily_sketches(hits, "ts", "user", ["url"])
    D.save_days(days, path)
    D.save_days(days.filter("day < '2024-01-04'"), path)
    table = spark.read.parquet(path)
    assert table.count() == 10
    week = F.date_trunc("week", "day").cast("date")
    exact = hits.groupBy(F.date_trunc("week", "ts").cast("date").alias("period")).agg(
        F.count("*").alias("pv"), F.countDistinct("user").alias("users")
    )
    both = D.united(table, week).join(exact.withColumnRenamed("pv", "hits"), "period").collect()
    assert len(both) == 2
    for r in both:
        assert r["pv"] == r["hits"] and abs(r["uv"] - r["users"]) <= 0.02 * r["users"]
    site = D.united(table).first()
    assert site["pv"] == 60_000 and abs(site["uv"] - 20_011) <= 400


def test_users_that_are_null_and_no_hits(spark):
    day = datetime.datetime(2024, 1, 1)
    hits = spark.createDataFrame([(day, None), (day, 1), (day, 1), (None, 2)], "ts timestamp, user long")
    row = D.united(D.daily_sketches(hits, "ts", "user")).first()
    assert (row["pv"], row["uv"]) == (3, 1)
    assert D.united(D.daily_sketches(hits.limit(0), "ts", "user"), F.col("day")).collect() == []


def hits_file(spark, folder, number, data):
    spark.createDataFrame(data, "item string, ts timestamp, clicked int").coalesce(1).write.parquet(f"{folder}/{number}.parquet")


def test_faded_rates_of_batches_in_any_order_and_the_time_out(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    at = lambda s: start + datetime.timedelta(seconds=s)
    source, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    half, time_out = 100.0, 1000.0

    def run():
        schema = "item string, ts timestamp, clicked int"
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        live = decayed_ctr(stream, "ts", "item", "clicked", half, time_out, late="300 seconds")
        query = counters.to_versions(live, table, state)
        query.awaitTermination()
        kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
        return {r["item"]: r for r in counters.latest(spark, table, "item").collect()}, kept[-1]

    first = [("a", at(200), 1), ("a", at(50), 0), ("b", at(10), None), (None, at(5), 1), ("a", None, 1)]
    hits_file(spark, source, 1, first)
    got, kept = run()
    assert kept == 2 and set(got) == {"a", "b"}
    hits_file(spark, source, 2, [("a", at(120), 1)])
    got, _ = run()
    w = [2 ** (-(200 - s) / half) for s in (200, 50, 120)]
    assert abs(got["a"]["exposure"] - sum(w)) < 1e-9 and abs(got["a"]["ctr"] - (w[0] + w[2]) / sum(w)) < 1e-9
    assert got["a"]["last"] == at(200) and got["b"]["ctr"] == 0.0
    hits_file(spark, source, 3, [("c", at(5000), 0)])
    run()
    hits_file(spark, source, 4, [("a", at(5100), 0)])
    got, kept = run()
    assert got["a"]["exposure"] == 1.0 and got["a"]["ctr"] == 0.0
    assert kept == 2
