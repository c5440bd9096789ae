"""Action log, association rules and lists on small hand-made tables."""

import math

import pytest
from pyspark.sql import functions as F

from quillrank import fixed as X
from quillrank.operators import actions as A, corpus as C, recommend as R, rules as U
from quillrank.session import stage


def log_row(event, item="7", ms="60001", version="6.0", user="u1", day="2024-01-05", time=1700000000123):
    params = {}
    if item is not None:
        params["songid"] = item
    if ms is not None:
        params["songtime"] = ms
    return (user, event, time, params, version, day)


LOG = "imei string, event_id string, event_time bigint, params map<string,string>, app_version_name string, day string"
PLAY = X.PLAY_EVENTS[0]


def test_action_codes_payload_and_versions(spark, rows):
    log = spark.createDataFrame(
        [
            log_row(PLAY),
            log_row(X.DOWNLOAD_EVENTS[0]),
            log_row(X.FAVOR_EVENTS[0], user=None),
            log_row(X.SHARE_EVENTS[3]),
            log_row("000|000|00|000"),
            log_row(PLAY, version="10.0"),
            log_row(PLAY, item=None),
            log_row(PLAY, item="unknown"),
        ],
        LOG,
    )
    items = spark.createDataFrame([("7",), ("7",)], "song_id string")
    got = rows(A.user_item_action(log, items), "user_id", "item_id", "action", "tmstamp", "extend", "ds")
    assert got == sorted(
        [
            ("u1", "7", 1, 17000000001, "60001", "20240105"),
            ("u1", "7", 2, 17000000001, "", "20240105"),
            ("-1", "7", 3, 17000000001, "", "20240105"),
            ("u1", "7", 5, 17000000001, "", "20240105"),
        ]
    )
    assert A.user_item_action(log, items, version_order="version").count() == 5
    with_unknown = items.unionAll(spark.createDataFrame([("-1",)], "song_id string"))
    assert A.user_item_action(log, with_unknown).filter("item_id = '-1'").count() == 1


ACTION = "user_id string, item_id string, action int, extend string, ds string"


def play(extend, user="1", item="7", action=1, ds="20240105"):
    return (user, item, action, extend, ds)


@pytest.mark.parametrize(
    "extend,kept", [("", False), ("x", False), ("59999", False), ("60000", False), ("60001", True), (None, False)]
)
def test_play_threshold_is_strict(spark, extend, kept):
    df = spark.createDataFrame([play(extend)], ACTION)
    assert A.play_threshold(df).count() == int(kept)


@pytest.mark.parametrize(
    "extend,kept", [("59999", 0), ("60000", 1), ("600000", 1), ("600001", 0), ("", 0), ("x", 0)]
)
def test_prior_bounds_are_closed(spark, extend, kept):
    df = spark.createDataFrame([play(extend)], ACTION)
    assert R.candidate_priors(df, "20240105").count() == kept


def test_prior_window_and_ids(spark, rows):
    df = spark.createDataFrame(
        [
            play("70000", ds="20231229"),
            play("70000", ds="20231228"),
            play("70000", ds="20240106"),
            play("70000", user="0"),
            play("70000", user="abc"),
            play("70000", item="-1"),
            play("70000", item="8"),
            play("70000", item="8"),
        ],
        ACTION,
    )
    assert rows(R.candidate_priors(df, "20240105")) == [("1", "7", 1), ("1", "8", 2)]
    assert rows(R.candidate_priors(df, "20240105", k=1)) == [("1", "8", 2)]


def matrix(spark, baskets):
    return spark.createDataFrame([(u, i) for u, items in baskets.items() for i in items], "user_id string, item_id string")


@pytest.mark.parametrize("size,kept", [(1, 0), (2, 2), (100, 100), (101, 0)])
def test_basket_bounds_are_closed(spark, size, kept):
    df = matrix(spark, {"u": [f"i{n}" for n in range(size)]})
    assert U.filter_users(df).count() == kept


@pytest.mark.parametrize("users,kept", [(2, 0), (3, 3), (9, 9), (10, 0), (11, 0)])
def test_item_bounds_are_open(spark, users, kept):
    df = matrix(spark, {f"u{n}": ["i"] for n in range(users)})
    assert U.filter_items(df, 2, 10).count() == kept


def test_pair_bounds_are_closed_and_symmetric(spark, rows):
    df = matrix(spark, {"a": "xyz", "b": "xyz", "c": "xz", "d": "xw"})
    assert rows(U.pair_counts(df, 2, 2)) == [("x", "y", 2), ("y", "x", 2), ("y", "z", 2), ("z", "y", 2)]
    assert ("x", "z", 3) in rows(U.pair_counts(df))
    assert all(p[2] > 1 for p in rows(U.pair_counts(df)))


def test_rule_metrics_golden(spark):
    # a = 4, b = 5, ab = 3, n = 10
    baskets = {f"ab{i}": "ab" for i in range(3)} | {"a1": "a", "b1": "b", "b2": "b"}
    baskets |= {f"c{i}": "c" for i in range(4)}
    m = matrix(spark, baskets)
    row = U.association_metrics(U.pair_counts(m), m).filter("item_prior = 'a'").first()
    assert (row.prior_cnt, row.posterior_cnt, row.pair_cnt, row["rank"]) == (4, 5, 3, 1)
    assert row.confidence == pytest.approx(0.75) and row.max_conf == pytest.approx(0.75)
    assert row.min_conf == pytest.approx(0.6) and row.lift == pytest.approx(1.5)
    assert row.kulc == pytest.approx(0.675) and row.ir == pytest.approx(1 / 6)
    assert row.confidence * math.log(1 + row.lift) == pytest.approx(0.6872180489)


def test_fused_rules_equal_the_steps(spark, rows):
    import random

    rnd = random.Random(3)
    m = matrix(spark, {f"u{u}": {f"i{int(rnd.paretovariate(1.0)) % 40}" for _ in range(12)} for u in range(150)})
    users, items, pairs = (2, 9), (3, 140), (2, 60)
    kept = U.filter_items(U.filter_users(m, *users), *items)
    steps = U.association_metrics(U.pair_counts(kept, *pairs), kept, 7)
    fused = U.mine_rules(m, users, items, pairs, 7)
    assert rows(steps) == rows(fused) and steps.count() > 0
    for r in fused.collect():
        assert r.min_conf <= r.kulc <= r.max_conf and 0 <= r.ir <= 1 and r["rank"] <= 7


@pytest.mark.parametrize("shift", [0, 1 << 40])
def test_pairs_are_made_where_they_are_counted(spark, rows, monkeypatch, shift):
    """Users send lists of items and not pairs; repeated rows, nulls, hot items and long ids count as in a self join."""
    cells = [(u, i + shift) for u in range(30) for i in range(40) if (u * 7 + i * 3) % 5 < 2 or i < 3]
    cells += [(1, shift), (1, shift), (2, None), (None, shift), (None, 1 + shift)]
    counts = {}
    for u in {u for u, _ in cells if u is not None}:
        own = [i for v, i in cells if v == u and i is not None]
        for a in own:
            for b in own:
                if a != b:
                    counts[a, b] = counts.get((a, b), 0) + 1
    monkeypatch.setattr("quillrank.plans.skew.HEAVY", 5)
    got = U.pair_counts(spark.createDataFrame(cells, "user_id long, item_id long"))
    assert got.dtypes == [("item_prior", "bigint"), ("item_posterior", "bigint"), ("pair_cnt", "bigint")]
    assert rows(got) == sorted((a, b, n) for (a, b), n in counts.items() if n >= 2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Inner, (user_id" not in plan and "collect_list" in plan


def test_oversized_hot_basket_is_dropped(spark):
    hot = {"hot": [f"i{n}" for n in range(5000)]} | {f"u{n}": ["i1", "i2"] for n in range(20)}
    assert U.filter_users(matrix(spark, hot)).select("user_id").distinct().count() == 20


INFO = "song_id string, song_name string, singer_id string, singer_name string"
RULE = (
    "item_prior string, item_posterior string, prior_cnt bigint, posterior_cnt bigint, pair_cnt bigint, "
    "confidence double, max_conf double, min_conf double, lift double, kulc double, ir double, rank bigint"
)


def rule(prior, posterior, rank):
    return (prior, posterior, 4, 4, 2, 0.5, 0.5, 0.5, 1.0, 0.5, 0.0, rank)


def test_diversify(spark, rows):
    info = spark.createDataFrame(
        [("p", "title", "s1", "S1"), ("a", "other", "s1", "S1"), ("b", "title", "s2", "S2"), ("c", "new", "s2", "S2"),
         ("d", "fresh", "s3", "S3")], INFO,
    )
    rules = spark.createDataFrame(
        [rule("p", "a", 1), rule("p", "b", 2), rule("p", "c", 3), rule("p", "x", 4), rule("p", "y", 5), rule("p", "d", 6)],
        RULE,
    )
    got = rows(U.diversify_rules(rules, info), "item_posterior", "rank", "debug_info", "singer_posterior")
    # a: same singer. b: same title, and it was the best of s2, so c is not taken for it. y: second unknown singer.
    assert got == [("d", 2, "p|title|s1|S1,d|fresh|s3|S3", "s3"), ("x", 1, "p|title|s1|S1,|||", "")]


def test_recommend_keeps_three_separate_maxima(spark, rows):
    priors = spark.createDataFrame([("u", "a", 4), ("u", "b", 1)], "user_id string, item_id string, prior bigint")
    rules = spark.createDataFrame(
        [("a", "x", 1, "d1", "s1"), ("b", "x", 1, "d9", "s0"), ("a", "y", 2, "d2", "s1"), ("a", "z", 11, "d", "s")],
        "item_prior string, item_posterior string, rank bigint, debug_info string, singer_posterior string",
    )
    got = rows(R.recommend(priors, rules), "item_id", "rank", "rec_reason", "debug_info", "singer_id")
    assert got == [("x", 1, "b", "d9", "s1"), ("y", 2, "a", "d2", "s1")]
    assert rows(R.recommend(priors, rules, per_singer=1), "item_id") == [("x",)]
    seen = priors.unionAll(spark.createDataFrame([("u", "x", 1)], priors.schema))
    assert rows(R.recommend(seen, rules, exclude_seen=True), "item_id") == [("y",)]


def test_fill_and_pack(spark, rows):
    lists = spark.createDataFrame(
        [("u", "b", 2), ("u", "a", 1), ("u", "late", 301), ("v", "c", 1)], "user_id string, item_id string, rank bigint"
    )
    hot = spark.createDataFrame([("h2", 2), ("a", 1), ("h3", 3)], "item_id string, rank bigint")
    default = spark.createDataFrame([("default",), ("u",), ("late_only",)], "user_id string")
    got = dict(rows(R.fill_and_pack(lists, hot, "k_", defaults=default)))
    assert got == {"k_u": "a,b,a,h2,h3", "k_v": "c,a,h2,h3", "k_default": "a,h2,h3", "k_late_only": "a,h2,h3"}
    short = dict(rows(R.fill_and_pack(lists, hot, "k_", k=2)))
    assert short == {"k_u": "a,b", "k_v": "c,a"}


def test_default_list_rank_and_exclusion(spark, rows):
    acts = spark.createDataFrame(
        [play("", item=i, ds="20240105") for i, n in (("1", 5), ("2", 3), ("3", 9), ("4", 4)) for _ in range(n)], ACTION
    )
    info = spark.createDataFrame(
        [("1", "t1", "s1", "S1"), ("2", "t2", "s1", "S1"), ("3", "t3", "s2", "kids"), ("4", "t1", "s3", "S3")], INFO
    )
    got = rows(R.default_list(acts, info, "20240105", 2, excluded_singer="kids"), "item_id", "rank", "singer_id")
    assert got == [("2", 1, "s1"), ("4", 2, "s3")]
    assert R.default_list(acts, info, "20240105", 3, excluded_singer="kids").count() == 1


def test_random_hot_is_repeatable_and_whole(spark, rows):
    acts = spark.createDataFrame([play("70000", item=str(i), ds="20240105") for i in range(1, 40)], ACTION)
    first, second = rows(R.random_hot(acts, "20240105", seed=1)), rows(R.random_hot(acts, "20240105", seed=1))
    assert first == second and sorted(r[1] for r in first) == list(range(1, 40))
    assert rows(R.random_hot(acts, "20240105", seed=2)) != first


@pytest.mark.parametrize("items,kept", [(4, 0), (5, 1), (50, 1), (51, 0)])
def test_corpus_bounds(spark, items, kept):
    df = spark.createDataFrame([play("90001", item=str(n)) for n in range(items)], ACTION)
    assert C.basket_corpus(df).count() == kept


def test_top_buyers(spark, rows):
    df = spark.createDataFrame(
        [(u, "i", 2, t) for u in range(15) for t in range(100 - u, 100 - u + 1 + u % 5)] + [(99, "i", 1, 1)],
        "user_id int, item_id string, action int, timestamp bigint",
    )
    got = A.top_buyers_first_purchase(df).orderBy("rnk").collect()
    assert [r.user_id for r in got] == [4, 9, 14, 3, 8, 13, 2, 7, 12, 1]
    assert got[0].first_time == 96


def test_merge_recall_first_source_wins(spark, rows):
    make = lambda d: spark.createDataFrame([("q", i, s) for i, s in d], "q string, item_id string, score double")
    got = rows(R.merge_recall({"picked": make([("a", 1.0)]), "found": make([("a", 9.0), ("b", 5.0), ("c", 7.0)])}, ["q"], 2))
    assert [(r[1], r[3]) for r in got] == [("a", "picked"), ("c", "found")]


def test_bid_ranking(spark, rows):
    ads = spark.createDataFrame([("r", "a", 0.1, 2.0), ("r", "b", 0.4, 1.0)], "r string, ad string, pctr double, cpc double")
    assert [r[1] for r in rows(R.bid_ranking(ads, ["r"], "ad", 1))] == ["b"]
    assert [r[1] for r in rows(R.bid_ranking(ads, ["r"], "ad", 1, power=0.1))] == ["a"]


def test_version_pointer(spark):
    row = R.version_pointer(spark.createDataFrame([("20240105",)], "d string"), "v1").first()
    assert tuple(row) == ("v1", "1,20240105,20240105", 1, "daily_rec")


def test_max_of_rows(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 2), (2, 3), (3, 4) AS t(a, b)")
    assert tuple(df.agg(F.max("a"), F.max("b")).first()) == (3, 4)


def test_default_list_does_not_broadcast_the_item_table(spark, monkeypatch):
    plans, number = [], R.global_row_number

    def seen(df, order):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return number(df, order)

    monkeypatch.setattr(R, "global_row_number", seen)
    acts = spark.createDataFrame([play("", item=str(i % 5), ds="20240105") for i in range(30)], ACTION)
    info = stage(spark.createDataFrame([(str(i), f"t{i}", "s", "S") for i in range(9)], INFO), "info")
    assert R.default_list(acts, info, "20240105", 2).count() == 5
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
