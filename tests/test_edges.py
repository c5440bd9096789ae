"""Null keys, zero divisors, long orders, and tables that are one file or a folder of part files."""

import math
import shutil

import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from quillrank.functions import as_number, dirichlet_mode, version_at_least
from quillrank.operators import actions as A, bandits as B, features as X, metrics as E, models as M, search as Q
from quillrank.plans.ranks import running_below
from quillrank.plans.skew import spread_join

KEYED = [("a", 1.0), ("a", 3.0), (None, 5.0), (None, 9.0)]


def test_null_keys_stay(spark):
    df = spark.createDataFrame(KEYED, "k string, v double")
    counted = X.count_encoded(df, "k").collect()
    assert sorted((r["k"] or "", r["k_count"]) for r in counted) == [("", 2), ("", 2), ("a", 2), ("a", 2)]
    z = M.anomaly_scores(df, "k", "v").collect()
    assert len(z) == 4 and {round(abs(r["z"]), 6) for r in z} == {round(1 / math.sqrt(2), 6)}


def test_null_keys_in_history_and_sums(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1, 1.0D), ('a', 2, 3.0D), (NULL, 1, 5.0D), (NULL, 3, 9.0D) t(k, d, v)")
    df = df.withColumn("ts", F.expr("timestamp'2024-01-01' + make_dt_interval(d)"))
    past = {(r["k"], r["d"]): (r["past_n"], r["past_sum"]) for r in X.history(df, "k", "ts", "d", "v").collect()}
    assert past == {("a", 1): (0, 0.0), ("a", 2): (1, 1.0), (None, 1): (0, 0.0), (None, 3): (1, 5.0)}
    below = running_below(df.select("k", "d", "v"), "d", ["v"], ["k"]).collect()
    assert {(r["k"], r["d"]): r["v_below"] for r in below} == {("a", 1): 0.0, ("a", 2): 1.0, (None, 1): 0.0, (None, 3): 5.0}


def test_null_segment_in_report(spark):
    rows = [(s, p, y) for s in ("x", None) for p, y in ((0.2, 0), (0.7, 1), (0.4, 1))]
    got = E.metric_report(spark.createDataFrame(rows, "s string, prob double, label int"), "s").collect()
    assert {r["s"] for r in got} == {"x", None} and all(r["n"] == 3 and r["auc"] == 1.0 for r in got)


def test_null_keys_only_meet_where_asked(spark):
    left, right = spark.createDataFrame(KEYED, "k string, v double"), spark.createDataFrame([("a", 1), (None, 2)], "k string, w int")
    assert spread_join(left, right, "k").count() == 2
    assert sorted(r["w"] for r in spread_join(left, right, "k", nulls=True).collect()) == [1, 1, 2, 2]


def test_zero_divisors(spark):
    same = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    assert sorted(str(r["bin"]) for r in X.width_bins(same, "v", 4).collect()) == ["1", "1", "None"]
    arms = spark.createDataFrame([("a", 10, 2), ("b", 0, 0)], "arm string, exposure int, click int")
    assert {r["arm"]: r["ucb"] for r in B.ucb(arms).collect()}["b"] == math.inf
    flat = spark.createDataFrame([(1.0, 2.0, 1.0)] * 2, "p double, y double, w double")
    row = E.regression_errors(flat, "p", "y", "w").first()
    assert row["r2"] is None and row["mse"] == 1.0
    assert spark.range(1).select(dirichlet_mode(F.array(F.lit(1.0), F.lit(1.0))).alias("m")).first()["m"] == [None, None]
    blank = spark.createDataFrame([(1, ""), (2, " ")], "doc_id int, text string")
    assert Q.bm25(blank, ["red ring"]).count() == 0


def test_numbers_and_versions(spark):
    df = spark.createDataFrame([("60000.5",), ("12",), ("x",), (None,), ("9007199254740993",)], "s string")
    assert [r[0] for r in df.select(as_number("s")).collect()] == [60000, 12, None, None, 9007199254740993]
    v = spark.createDataFrame([("6",), ("6.0",), ("5.9",), ("10.1.2",)], "v string")
    assert [r[0] for r in v.select(version_at_least("v", "6.0", "version")).collect()] == [True, True, False, True]


def test_blank_search_has_no_snippets(spark):
    docs = spark.createDataFrame([(1, "t", "some text")], "id int, title string, content string")
    assert Q.snippets(docs, "  ").count() == 0


def test_one_item_type_and_window(spark):
    rows = [("1", "2", 1, "70000", "20240105", 1), ("1", "3", 1, "70000", "20240105", 2), ("1", "4", 1, "70000", "20231201", 1)]
    df = spark.createDataFrame(rows, "user_id string, item_id string, action int, extend string, ds string, item_type int")
    assert A.play_threshold(df).count() == 3
    assert [r["item_id"] for r in A.play_threshold(df, date="20240105", days=3, item_type=1).collect()] == ["2"]


def test_best_arm_by_smoothed_rate(spark):
    users = spark.range(400).withColumnRenamed("id", "u")
    counts = spark.createDataFrame([("a", 100000, 20000), ("b", 10000, 1000), ("c", 10, 5)], "arm string, exposure int, click int")
    got = B.greedy_by_ctr(users, "u", counts, "arm", 0.0, added=1000).select("arm").distinct().collect()
    assert [r["arm"] for r in got] == ["a"]


@pytest.fixture(scope="module")
def long_order(tmp_path_factory):
    """The smallest tables with one order of 150 lines more."""
    import duckdb

    folder = tmp_path_factory.mktemp("tables")
    for name in ("lineitem", "part"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", folder / f"{name}.parquet")
    con = duckdb.connect()
    path = folder / "lineitem.parquet"
    con.execute(f"CREATE TABLE l AS SELECT * FROM read_parquet('{path}')")
    con.execute(
        "INSERT INTO l SELECT x.* REPLACE (10000000 AS l_orderkey, CAST(i AS INTEGER) AS l_linenumber, i AS l_partkey) "
        "FROM (SELECT * FROM l LIMIT 1) x, range(1, 151) r(i)"
    )
    path.unlink()
    con.execute(f"COPY l TO '{path}' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", ["pagerank", "related_queries"])
def test_long_orders_count(spark, long_order, name):
    import compare as C

    tables = C.TABLES
    try:
        C.TABLES = ["lineitem", "part"]
        con = duck(long_order)
    finally:
        C.TABLES = tables
    assert compare(spark, con, long_order, name) is None


@pytest.mark.parametrize("name", ["stream_counts", "stream_ctr", "stream_views", "stream_kmeans"])
def test_streams_over_folder_tables(spark, tmp_path, name):
    from quillrank.catalog import QUERIES

    single = "/root/testdata/sf0.001"
    for table in ("events", "embeddings"):
        spark.read.parquet(f"{single}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))

    def rows(folder):
        return sorted(tuple(r) for r in QUERIES[name](spark, folder).collect())

    got = rows(str(tmp_path))
    assert got and got == rows(single)
