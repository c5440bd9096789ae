"""Models, exploration, reports, sources, sinks, streams."""

import datetime
import os

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillrank.functions.udfs import register
from quillrank.operators import bandits as B, models as M, reports as R
from quillrank.operators.item_logistic import fit_items
from quillrank.operators.metrics import auc
from quillrank.sources import readers, sinks
from quillrank.streaming import counters, kmeans

TRAIN = (
    "id bigint, label int, user_features array<string>, user_weights array<double>, "
    "ads_features array<string>, ads_weights array<double>"
)


def test_sparse_features_add_up_weights(spark):
    df = spark.createDataFrame([(1, 0, ["u"], [1.0], ["a", "b", "a"], [1.0, 2.0, 0.5])], TRAIN)
    v = M.sparse_features(df, "ads_features", "ads_weights", "wide", 50_000).first().wide
    assert sorted(v.values) == [1.5, 2.0] and v.size == 50_000


def test_wide_deep_learns_both_parts(spark):
    rnd = np.random.default_rng(1)
    table = spark.createDataFrame([(i, rnd.normal(size=4).tolist()) for i in range(64)], "slot int, embedding array<double>")
    data = []
    for i in range(600):
        a, u = int(rnd.integers(0, 6)), int(rnd.integers(0, 6))
        data.append((i, int(a >= 3), [f"u{u}"], [1.0], [f"a{a}"], [1.0]))
    model = M.WideDeep(table, buckets=256, iterations=30, hidden=(8, 4))
    rows = model.prepare(spark.createDataFrame(data, TRAIN))
    report = M.evaluate(model.fit(rows).predict(rows)).first()
    assert report.auc > 0.95 and report.total_count == 600
    assert report.average_score == pytest.approx(np.mean([d[1] for d in data]), abs=0.1)


def test_item_and_column_models(spark):
    rnd = np.random.default_rng(2)
    data = [(float(x), str(int(x > 0)), int(rnd.random() < (0.9 if x > 0 else 0.1))) for x in rnd.normal(size=500)]
    df = spark.createDataFrame(data, "x double, item string, label int")
    model = M.fit_classifier(df, "boosting", ["x"], maxIter=3)
    for scored in (M.class_prob(model, df), df.join(fit_items(df, "item"), "item")):
        assert auc(scored).first().auc > 0.85
    leaves = M.leaf_features(df, ["x"], trees=2, depth=2).select("leaves").distinct().count()
    assert leaves > 1


def test_stacking_predicts_every_row_once(spark):
    rnd = np.random.default_rng(3)
    df = spark.createDataFrame([(i, float(x), int(x > 0)) for i, x in enumerate(rnd.normal(size=200))], "id int, x double, label int")
    out = M.stacked(df, "id", ["x"], ["logistic", "forest"], folds=2)
    assert out.count() == 200 and out.select("id").distinct().count() == 200
    assert auc(out).first().auc > 0.9


def test_naive_bayes_laplace(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 0), (4, "c", 0)], "id int, f string, y int")
    p = {(r.value, r.label): r.prob for r in M.naive_bayes_table(df, ["f"], "y").collect()}
    assert p[("a", 1)] == pytest.approx(3 / 5) and p[("b", 1)] == pytest.approx(1 / 5) and len(p) == 6
    table = M.naive_bayes_table(df, ["f"], "y")
    got = M.naive_bayes_predict(df, table, M.class_priors(df, "y"), "id", ["f"])
    assert {r.id: r.predicted for r in got.collect()} == {1: 1, 2: 1, 3: 0, 4: 0}


def test_lin_ucb_against_numpy(spark):
    rnd = np.random.default_rng(4)
    x, r = rnd.normal(size=(300, 3)), rnd.random(300)
    arm = rnd.integers(0, 3, 300)
    df = spark.createDataFrame([(int(a), *map(float, v), float(y)) for a, v, y in zip(arm, x, r)], "arm int, a double, b double, c double, r double")
    for row in B.lin_ucb(df, "arm", ["a", "b", "c"], "r").collect():
        xa, ra = x[arm == row.arm], r[arm == row.arm]
        inv = np.linalg.inv(xa.T @ xa + np.eye(3))
        theta, c = inv @ xa.T @ ra, xa.mean(axis=0)
        assert row.theta == pytest.approx(theta.tolist())
        assert row.score == pytest.approx(theta @ c + np.sqrt(c @ inv @ c))


def test_thompson_draws(spark):
    arms = spark.createDataFrame([(i, 80, 100) for i in range(300)], "arm int, click int, exposure int")
    draws = [r.draw for r in B.thompson(arms, "arm", seed=1).collect()]
    assert draws == [r.draw for r in B.thompson(arms, "arm", seed=1).collect()]
    assert np.mean(draws) == pytest.approx(81 / 102, abs=0.01) and len(set(draws)) == 300
    register(spark)
    assert 0 < spark.sql("SELECT beta_dist_sample(2D, 3D, 5L)").first()[0] < 1


def test_epsilon_share(spark):
    got = B.epsilon_greedy(spark.range(5000), "id", ["a", "b"], "best", 0.3)
    assert got.agg(F.avg("explored")).first()[0] == pytest.approx(0.3, abs=0.03)


def test_q_values_reach_the_discounted_reward(spark):
    log = spark.createDataFrame([("s0", 0, 0.0, "s1"), ("s0", 1, 0.2, "end"), ("s1", 0, 1.0, "end")], "s string, a int, r double, s2 string")
    q = B.q_values(log, 25)
    values = {(r.s, r.a): r.q for r in q.collect()}
    assert values[("s0", 0)] == pytest.approx(0.95, abs=1e-4) and values[("s0", 1)] == pytest.approx(0.2, abs=1e-4)
    assert {r.s: r.a for r in B.greedy_action(q).collect()} == {"s0": 0, "s1": 0}


def test_month_snapshot_carries_forward(spark, rows):
    data = [("k", "2024-01-05", 1), ("k", "2024-01-20", 2), ("k", "2024-04-01", 3), ("j", "2024-05-31", 9)]
    df = spark.createDataFrame(data, "k string, d string, v int").withColumn("ts", F.to_timestamp("d"))
    got = [(k, str(m), v) for k, m, v in rows(R.month_snapshot(df, "k", "ts", "v", ["v"]))]
    assert got == [
        ("j", "2024-05-31", 9), ("k", "2024-01-31", 2), ("k", "2024-02-29", 2), ("k", "2024-03-31", 2),
        ("k", "2024-04-30", 3), ("k", "2024-05-31", 3),
    ]


def test_reading_and_tags(spark, rows):
    df = spark.createDataFrame([(1, "<p>one two-three</p>", ["x", "y", "x"]), (2, "", ["x"])], "id int, t string, tags array<string>")
    assert rows(R.reading_time(df, "id", "t", rate=2, html=True)) == [(1, 3, 2), (2, 0, 0)]
    assert rows(R.tag_counts(df, F.col("tags"))) == [("x", 2, 1), ("y", 1, 2)]


# Sources and sinks -------------------------------------------------------------------------------------------------


def test_training_csv_defaults(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1.0,a;b,1.0;2.5,c,0.5\n,,,,\n0.9,x,1,y,2\n")
    got = readers.training_csv(spark, str(tmp_path)).collect()
    by = {tuple(r.user_features): r for r in got}
    assert by[("a", "b")].user_weights == [1.0, 2.5] and by[("a", "b")].label == 1
    empty = by[("0",)]
    assert (empty.label, empty.user_weights, empty.ads_features, empty.ads_weights) == (0, [0.0], ["0"], [0.0])
    assert by[("x",)].label == 0


def test_line_readers(spark, tmp_path):
    (tmp_path / "docs").write_text("d1\tw1\tw2\nd2\tw3\n")
    assert {r.doc: r.words for r in readers.word_lines(spark, str(tmp_path / "docs")).collect()} == {"d1": ["w1", "w2"], "d2": ["w3"]}
    (tmp_path / "topics").write_text("pkg,name,7,0.1,0.9,1.0\nbad,line\n")
    row = readers.topic_vectors(spark, str(tmp_path / "topics"), topics=2).collect()
    assert len(row) == 1 and row[0].topics == [0.1, 0.9] and row[0].id == 7 and row[0]["sum"] == 1.0


def test_partitions_are_replaced_alone(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    make = lambda d: spark.createDataFrame(d, "v int, ds string, item_type int")
    sinks.overwrite_partitions(make([(1, "20240101", 1), (2, "20240102", 1)]), path)
    sinks.overwrite_partitions(make([(9, "20240102", 1)]), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]


def test_retention_and_dates(spark):
    df = spark.createDataFrame([("20240101",), ("20240108",), ("20240109",)], "ds string")
    assert sinks.retained(df, "20240108", 7).count() == 2
    assert [r.ds for r in sinks.expired(df, "20240108", 7).collect()] == ["20240101"]
    assert tuple(sinks.run_dates(spark, "20240108").first()) == ("20240108", "2024-01-08", "20240101", "20240101")
    yesterday = sinks.run_dates(spark).first().day
    assert yesterday == (datetime.datetime.now(datetime.timezone.utc).date() - datetime.timedelta(days=1)).isoformat()


# Streams -----------------------------------------------------------------------------------------------------------


def test_counter_over_several_batches_equals_batch(spark, tmp_path):
    source, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "url string"
    total = {}
    for part in range(3):
        urls = [f"/p{(i * (part + 1)) % 5}" for i in range(20)]
        for u in urls:
            total[u] = total.get(u, 0) + 1
        spark.createDataFrame([(u,) for u in urls], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        counters.to_versions(counters.hit_counts(stream), table, state).awaitTermination()
    counts = counters.latest(spark, table)
    assert {r.url: r.time for r in counts.collect()} == total
    asked = spark.createDataFrame([("/p1",), ("/unseen",)], "url string")
    assert {r.url: r.time for r in counters.looked_up(asked, counts).collect()} == {"/p1": total["/p1"], "/unseen": 0}


def test_all_windows_come_out(spark, tmp_path):
    source = str(tmp_path / "in")
    base = datetime.datetime(2024, 1, 1)
    data = [(base + datetime.timedelta(minutes=m), m % 4, int(m % 3 == 0)) for m in range(0, 180, 2)]
    spark.createDataFrame(data, "ts timestamp, u int, c int").write.parquet(source)
    stream = spark.readStream.schema("ts timestamp, u int, c int").parquet(source)
    got = counters.drained(counters.window_ctr(stream, "ts", [], "c", "1 hour", "1 hour"), ["start", "end"], "ctr").collect()
    assert sorted((r.start.hour, r.exposure, r.click) for r in got) == [(0, 30, 10), (1, 30, 10), (2, 30, 10)]


def test_kmeans_update_and_forgetting(spark, tmp_path):
    schema = "v array<double>"
    source, table, state = (str(tmp_path / n) for n in ("in", "c", "s"))
    first = spark.createDataFrame([(0, [0.0], 2.0), (1, [10.0], 1.0), (2, [99.0], 4.0)], "id bigint, centre array<double>, n double")
    for values in ([1.0, 2.0, 9.0], [0.0]):
        spark.createDataFrame([([v],) for v in values], schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    kmeans.start(stream, first, table, state, "v", 0.5).awaitTermination()
    assert len([d for d in os.listdir(table) if d.startswith("batch=")]) == 3
    got = {r.id: (r.centre[0], r.n) for r in kmeans.latest_centres(spark, table).collect()}
    one = ((0.0 * 1 + 3.0) / 3, 3.0)
    assert got[0] == (pytest.approx(one[0] * 1.5 / 2.5), pytest.approx(2.5))
    assert got[1] == (pytest.approx((10 * 0.5 + 9) / 1.5), pytest.approx(0.75))
    assert got[2] == (99.0, 1.0)


def test_vector_columns(spark):
    df = spark.createDataFrame([(1, 0, ["u"], [1.0], ["a"], [2.0])], TRAIN)
    table = spark.createDataFrame([(0, [1.0, 2.0])], "slot int, embedding array<double>")
    row = M.WideDeep(table, buckets=8).prepare(df).select(vector_to_array("deep").alias("d")).first()
    assert row.d == pytest.approx([1.0, 2.0, 1.0, 2.0])


def test_a_fit_holds_a_bounded_number_of_rows_a_task(spark, monkeypatch):
    seen, fit = [], M.Pipeline.fit
    monkeypatch.setattr(M, "ROWS_A_TASK", 100, raising=False)
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    x = F.col("id").cast("double")
    rows = spark.range(0, 1000, 1, 1).select("id", x.alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    M.fit_classifier(rows, "logistic", ["x"], maxIter=1)
    assert M.leaf_features(rows, ["x"], trees=1).count() == 1000
    assert min(seen) >= 10
    monkeypatch.setattr(M, "ROWS_A_TASK", 1000)
    M.fit_classifier(rows, "logistic", ["x"], maxIter=1)
    assert seen[-1] == 1
