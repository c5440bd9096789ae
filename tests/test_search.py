"""Search, vectors, topics."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillrank.functions import dirichlet_mean, dirichlet_mode, json_items, version_at_least
from quillrank.operators import corpus as C, search as Q, vectors as V

DOCS = "id int, title string, content string"


def docs(spark, *rows):
    return spark.createDataFrame([(i + 1, t, c) for i, (t, c) in enumerate(rows)], DOCS)


def test_counts_words_and_phrase(spark, rows):
    df = docs(
        spark,
        ("Deep learning", "<p>Deep net, deep-learning</p>"),
        ("Other", "nothing here"),
        ("", "deep learning"),
        ("Net", "learning <b>deep</b> learning"),
    )
    got = {r.id: (r.phrase_count, r.hit_count) for r in Q.keyword_search(df, ["Deep Learning"]).collect()}
    # deep, learning and the phrase are counted each
    assert got == {1: (1, 3 + 2 + 1), 4: (1, 1 + 2 + 1)}


def test_order_and_pages(spark):
    df = docs(spark, *[(f"t{i}", "word " * (i % 4)) for i in range(30)])
    pages = Q.hit_pages(Q.keyword_search(df, ["word"]), size=5, pages=2).orderBy("rank").collect()
    assert len(pages) == 10 and pages[0].n_hits == 22
    assert [p.id for p in pages[:2]] == [28, 24] and [p.page for p in pages] == [0] * 5 + [1] * 5


def test_hit_counts_against_brute_force(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab -c") for _ in range(rnd.randint(1, 60))) for _ in range(150)]
    queries = ["a b", "ab", "ca-b", "b", "abc a"]
    df = docs(spark, *[("t", x) for x in texts])
    got = {(r.query, r.id): r.hit_count for r in Q.keyword_search(df, queries).collect()}
    for q in queries:
        phrase, words = Q.query_words(q)
        for i, x in enumerate(texts):
            n = sum(x.strip().count(w) + "t".count(w) for w in words if w)
            assert got.get((q, i + 1), 0) == n


def test_phrase_hits_and_snippets_agree(spark):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["deep", "learning", "net", "deeplearning"]) for _ in range(40)) for _ in range(40)]
    df = docs(spark, *[("t", x) for x in texts])
    found = {r.id: r.phrase_count for r in Q.keyword_search(df, ["deep learning"]).collect()}
    for i, text in enumerate(texts):
        hits = re.findall("deep learning|learning|deep", text)
        assert found.get(i + 1, 0) == hits.count("deep learning")
    whole = Q.snippets(df, "deep learning", top=-1).groupBy("id").agg(F.sum("phrase_count").alias("n")).collect()
    assert {r.id: r.n for r in whole} == {i: n for i, n in found.items()}


def test_snippet_window_and_marks(spark):
    text = "x" * 50 + "key" + "y" * 200 + "key word key" + "z" * 10
    rows = Q.snippets(docs(spark, ("t", text)), "key word", top=-1).collect()
    assert [(r.start, r.stop, r.phrase_count, r.hits) for r in rows] == [(233, 275, 1, 2), (30, 130, 0, 1)]
    assert rows[0].snippet.endswith("<b>key word</b> <b>key</b>" + "z" * 10)
    assert len(Q.snippets(docs(spark, ("t", text)), "key word", top=1).collect()) == 1


def test_snippets_mark_titles_and_serve_several_queries(spark):
    df = docs(spark, ("A Key here", "nothing"), ("plain", "one key two"), ("none", "none"), ("", "key"), ("key word", "Key " * 200), ("key", None))
    rows = Q.snippets(df, ["key", "word two", " "], top=1).collect()
    got = {(r.query, r.id): (r.title, r.snippet) for r in rows}
    assert got["key", 1] == ("A <b>Key</b> here", None) and got["key", 6] == ("<b>key</b>", None)
    assert got["key", 2] == ("plain", "one <b>key</b> two") and got["word two", 2] == ("plain", "one key <b>two</b>")
    assert got["word two", 5] == ("key <b>word</b>", None) and set(got) == {("key", k) for k in (1, 2, 5, 6)} | {("word two", k) for k in (2, 5)}
    assert got["key", 5][1].startswith("<b>Key</b> <b>Key</b>") and len(rows) == 6


def test_title_match(spark):
    df = spark.createDataFrame([("spark",), ("sparks fly",), ("spork",), ("storm",)], "title string")
    got = {r.title: r.match for r in Q.title_match(df, "title", "Spark", 1).collect()}
    assert got == {"spark": "exact", "sparks fly": "prefix", "spork": "edit"}


def test_tfidf_and_bm25_by_hand(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "c")], "doc_id int, text string")
    w = {(r.doc_id, r.term): r.tfidf for r in Q.tfidf(df).collect()}
    assert w[(1, "a")] == pytest.approx(2 * math.log(3)) and w[(2, "b")] == pytest.approx(math.log(1.5))
    score = {r.doc_id: r.score for r in Q.bm25(df, ["a c"]).collect()}
    idf_a, idf_c = math.log(2.5 / 1.5 + 1), math.log(1.5 / 2.5 + 1)
    assert score[1] == pytest.approx(idf_a * 2 * 2.2 / (2 + 1.2 * (0.25 + 0.75 * 3 / 2)))
    assert score[3] == pytest.approx(idf_c * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 1 / 2)))


def test_pagerank_sums_to_one_with_dead_ends(spark):
    edges = spark.createDataFrame([(1, 2, 1), (1, 3, 1), (2, 3, 2), (4, 1, 1), (1, 2, 1)], "src int, dst int, weight int")
    got = {r.node: r["rank"] for r in Q.pagerank(edges, 40).collect()}
    assert sum(got.values()) == pytest.approx(1.0)
    m = np.zeros((5, 5))
    m[2, 1], m[3, 1], m[3, 2], m[1, 4] = 2 / 3, 1 / 3, 1, 1
    p = np.full(5, 0.25)
    p[0] = 0
    for _ in range(40):
        lost = p[3]
        p = 0.15 / 4 + 0.85 * (m @ p + lost / 4)
        p[0] = 0
    assert [got[i] for i in (1, 2, 3, 4)] == pytest.approx(list(p[1:]))


def test_query_log_products(spark, rows):
    log = spark.createDataFrame([("red car", 0), ("red car", 10), ("red cat", 20), ("bad word", 0)], "q string, sec bigint")
    log = log.withColumn("ts", F.timestamp_seconds("sec"))
    assert rows(Q.hot_queries(log, "q", 1)) == [("red car", 2, 1)]
    best = Q.suggestions(log, "q", 1).filter("prefix = 'red ca'").first()
    assert best.q == "red car"
    banned = spark.createDataFrame([("Bad",)], "word string")
    assert Q.without_banned(log, banned, "q").count() == 3
    assert Q.one_click_per(log, ["q"], "ts", 60).count() == 3
    entropy = Q.click_entropy(spark.createDataFrame([("q", "a"), ("q", "b"), ("p", "a")], "query string, item string"))
    assert {r.query: round(r.entropy, 6) for r in entropy.collect()} == {"q": round(math.log(2), 6), "p": 0.0}


def test_vocabulary(spark, rows):
    df = spark.createDataFrame([("a a b",), ("A b-c",)], "text string")
    vocab = C.vocabulary(df, min_count=2)
    assert rows(vocab) == [("a", 3), ("b", 2)]
    assert tuple(C.kept_words(vocab).first()) == (2, 5)
    probs = {r.word: r.prob for r in C.negative_sampling(vocab).collect()}
    assert probs["a"] == pytest.approx(3**0.75 / (3**0.75 + 2**0.75))


@pytest.mark.parametrize("kind", ["dot", "l1"])
def test_nearest_against_numpy(spark, kind):
    rnd = np.random.default_rng(0)
    m = rnd.normal(size=(200, 8)).round(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id bigint, embedding array<double>").repartition(3)
    queries = df.filter("vec_id < 5").withColumnRenamed("vec_id", "query_id")
    got = {(r.query_id, r["rank"]): r.vec_id for r in V.nearest(df, queries, 3, kind).collect()}
    for q in range(5):
        s = m @ m[q] if kind == "dot" else (100 - np.abs(m - m[q])).sum(axis=1)
        s[q] = -np.inf
        assert [got[(q, k)] for k in (1, 2, 3)] == np.argsort(-s)[:3].tolist()


def test_nearest_refuses_too_many_queries(spark):
    df = spark.createDataFrame([(i, [1.0]) for i in range(5)], "vec_id bigint, embedding array<double>")
    with pytest.raises(ValueError):
        V.nearest(df, df.withColumnRenamed("vec_id", "query_id"), max_queries=4)


def test_nearest_in_blocks_asks_for_all(spark):
    m = np.random.default_rng(1).normal(size=(50, 4)).round(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id bigint, embedding array<double>")
    queries = df.withColumnRenamed("vec_id", "query_id")
    want = sorted(map(tuple, V.nearest(df, queries, 2).collect()))
    assert sorted(map(tuple, V.nearest_in_blocks(df, queries, 2, block=20).collect())) == want and len(want) == 100


def test_hashed_counts_drop_no_word(spark):
    """More different words than slots, each once: every one counts in the vectors, and in the topics."""
    df = spark.createDataFrame([(d, [f"w{d}x{k}" for k in range(300)]) for d in range(8)], "doc int, words array<string>")
    got = V.count_embedding(df, "words", 2)
    sums = got.select(F.aggregate(vector_to_array("counts"), F.lit(0.0), lambda a, x: a + x).alias("s")).collect()
    assert [r.s for r in sums] == [300.0] * 8
    model = V.fit_topics(df, "words", k=2, iterations=1)
    assert model.names.count() > 2300


def test_pooling_divides_by_root_of_squares(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "k int, embedding array<double>")
    lines = spark.createDataFrame([("r", 1, 3.0), ("r", 2, 4.0), ("s", 2, -1.0), ("t", 1, 1.0), ("t", 1, 1.0)], "id string, k int, w double")
    got = {r.id: r.pooled for r in V.pooled(lines, table, "id", "k", "w").collect()}
    assert got["r"] == pytest.approx([0.6, 1.6]) and got["s"] == pytest.approx([0.0, -2.0])
    assert got["t"] == pytest.approx([2 / math.sqrt(2), 0.0])


def test_topics_split_two_themes(spark):
    themes = (["football", "goal", "team"], ["market", "stock", "price"])
    data = [(d, (themes[d % 2] * 6)) for d in range(8)]
    df = spark.createDataFrame(data, "doc int, words array<string>")
    model = V.fit_topics(df, "words", k=2, iterations=40, alpha=0.2, min_df=1, vocabulary=50)
    topic = {r.doc: r.topic for r in V.doc_topics(model, df, "doc").collect()}
    assert len({topic[d] for d in (0, 2, 4, 6)}) == 1 and len({topic[d] for d in (1, 3, 5, 7)}) == 1
    assert topic[0] != topic[1]
    words = {(r.topic, r.word) for r in V.topic_words(model, 3).collect()}
    assert {w for t, w in words if t == topic[0]} == set(themes[0])


def test_word2vec_neighbours_share_contexts(spark):
    rnd = random.Random(0)
    groups = [[f"a{i}" for i in range(5)], [f"b{i}" for i in range(5)]]
    data = [([rnd.choice(groups[n % 2]) for _ in range(12)],) for n in range(400)]
    df = spark.createDataFrame(data, "words array<string>")
    vectors = V.word_vectors(V.fit_word2vec(df, "words", size=8, maxIter=5, stepSize=0.05)).withColumnRenamed("word", "vec_id")
    near = V.nearest(vectors, vectors.withColumnRenamed("vec_id", "query_id"), 1).collect()
    assert sum(r.query_id[0] == r.vec_id[0] for r in near) >= 9


def test_small_functions(spark):
    row = spark.range(1).select(
        dirichlet_mean(F.array(F.lit(2), F.lit(2))).alias("m"),
        dirichlet_mode(F.array(F.lit(3), F.lit(2))).alias("o"),
        json_items(F.lit('["x","y"]')).alias("j"),
        version_at_least(F.lit("10.0"), "6.0").alias("s"),
        version_at_least(F.lit("10.0"), "6.0", "version").alias("v"),
        version_at_least(F.lit("6.0"), "6.0", "version").alias("e"),
    ).first()
    assert row.m == [0.5, 0.5] and row.o == pytest.approx([2 / 3, 1 / 3]) and row.j == ["x", "y"]
    assert (row.s, row.v, row.e) == (False, True, True)


def test_term_counts_shuffle_texts_and_not_their_words(spark, rows):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b"), (1, "B c"), (None, "a"), (3, None)], "doc_id int, text string")
    counts = C.term_counts(docs)
    shuffles = [x for x in counts._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x]
    assert len(shuffles) == 1 and "term" not in shuffles[0]
    got = {(r.doc_id, r.term): r.tf for r in counts.collect()}
    assert got == {(1, "a"): 2, (1, "b"): 2, (1, "c"): 1, (2, "b"): 1, (None, "a"): 1}


def test_pooling_shuffles_no_vectors(spark):
    """A small table is broadcast to the lines of each row id; above that join nothing is shuffled."""
    lines = spark.createDataFrame([(1, 0, 2.0), (1, 0, 1.0), (None, 1, 1.0), (2, 9, 1.0), (2, None, 1.0)], "id int, k int, w double")
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0])], "k int, embedding array<double>")
    out = V.pooled(lines, table, "id", "k", "w")
    got = {r.id: r.pooled for r in out.collect()}
    assert set(got) == {1, None} and got[None] == [0.0, 2.0]
    assert got[1] == pytest.approx([3.0 / 5.0**0.5, 0.0])
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    above = plan[: plan.index("BroadcastHashJoin")]
    assert "Aggregate" in above and "Exchange" not in above
