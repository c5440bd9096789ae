"""Vector index, inverted index, edit-distance join and Gibbs topics against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillrank.functions import tokens
from quillrank.operators import fuzzy, gibbs, inverted, search, vector_index, vectors

EMBEDDINGS = "/root/testdata/sf0.1/embeddings.parquet"


def brute(pairs, asked, k):
    out = {}
    for q, x in asked:
        scored = sorted((-float(np.dot(x, y)), i) for i, y in pairs if i != q)[:k]
        out[q] = [i for _, i in scored]
    return out


def ranked(rows, value="id"):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r[value])
    return out


def test_vector_index_on_clusters(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK", 40)
    monkeypatch.setattr(vector_index, "QUERIES", 7)
    rng = np.random.default_rng(0)
    middle = rng.normal(size=(12, 8)) * 3
    pairs = [(i, (middle[i % 12] + rng.normal(size=8) * 0.3).tolist()) for i in range(600)]
    # A third of all rows are copies of one vector; lengths differ.
    pairs += [(1000 + i, pairs[0][1]) for i in range(300)] + [(2000, [0.0] * 8), (2001, [30.0] + [0.0] * 7)]
    df = spark.createDataFrame([*pairs, (None, pairs[0][1]), (7777, None)], "vec_id long, embedding array<float>")
    pairs = [(r.vec_id, r.embedding) for r in df.dropna().collect()]
    asked = [p for p in pairs if p[0] % 20 == 0]
    queries = spark.createDataFrame([*asked, (9999, None)], "query_id long, embedding array<float>")
    index = vector_index.build_index(df, cells=12)
    assert max(len(r.ids) for r in index.blocks.collect()) < 120
    assert sorted(i for r in index.blocks.collect() for i in r.ids) == sorted(p[0] for p in pairs)
    want = brute(pairs, asked, 5)
    assert ranked(vector_index.search_index(index, queries, 5, probes=1, exact=True).collect()) == want
    # More neighbours than one cell has.
    assert ranked(vector_index.search_index(index, queries, 400, probes=1, exact=True).collect()) == brute(pairs, asked, 400)
    assert ranked(vector_index.search_index(index, queries, 5, probes=12).collect()) == want


def test_vector_index_recall(spark):
    df = spark.read.parquet(EMBEDDINGS)
    index = vector_index.build_index(df)
    everyone = df.select(F.col("vec_id").alias("query_id"), "embedding")
    probes = vector_index.probes_for(index, everyone, 10)
    asked = everyone.filter("query_id % 100 = 0")
    got = vector_index.search_index(index, asked, 10, probes=probes).collect()
    want = {(r.query_id, r.vec_id) for r in vectors.nearest(df, asked, 10).collect()}
    assert len({(r.query_id, r.id) for r in got} & want) >= 0.9 * len(want)


def test_vector_index_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    index = vector_index.build_index(none)
    asked = spark.createDataFrame([(1, [1.0])], "query_id long, embedding array<double>")
    assert vector_index.search_index(index, asked.limit(0), 3).count() == 0


def apart(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a):
        p, d[0] = d[0], i + 1
        for j, y in enumerate(b):
            p, d[j + 1] = d[j + 1], min(p + (x != y), d[j] + 1, d[j + 1] + 1)
    return d[-1]


@pytest.mark.parametrize("distance, letters, longest", [(0, "ab", 5), (1, "abä", 7), (2, "ab", 9), (2, "abcde", 14), (3, "ab", 10)])
def test_edit_join(spark, distance, letters, longest):
    rnd = random.Random(distance)
    make = lambda: ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, longest))) for _ in range(120)]
    a, b = make() + ["x" * 3000, "same", "same"], make() + ["x" * 3000 + "y", "same"]
    left = spark.createDataFrame([(x,) for x in [*a, None]], "q string")
    right = spark.createDataFrame([(x,) for x in [*b, None]], "t string")
    got = sorted(map(tuple, fuzzy.edit_join(left, right, "q", "t", distance).collect()))
    near = {(x, y) for x in set(a) for y in set(b) if abs(len(x) - len(y)) <= distance}
    assert got == sorted((x, y, n) for x, y in near if (n := apart(x, y) if len(x) < 100 else len(y) - len(x)) <= distance)
    assert fuzzy.edit_join(left.limit(0), right, "q", "t", distance).count() == 0


def corpus(spark):
    rnd = random.Random(2)
    words = ["the"] * 30 + [f"w{i}" for i in range(60)]
    made = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 40)))) for i in range(500)]
    made += [(600 + i, "same text of copies the the w1") for i in range(250)]
    made += [(900, None), (901, ""), (902, "lone"), (903, "the w3 " * 3000), (904, "a b a b a")]
    return made, spark.createDataFrame(made, "doc_id long, text string").repartition(5)


def plain_bm25(made, query):
    docs = {i: re.findall(r"[^\s\-]+", (t or "").lower()) for i, t in made}
    mean = sum(map(len, docs.values())) / len(docs)
    counts = {i: Counter(w) for i, w in docs.items()}
    df = Counter(w for c in counts.values() for w in c)
    out = Counter()
    for w in set(query.lower().split()):
        idf = math.log((len(docs) - df[w] + 0.5) / (df[w] + 0.5) + 1)
        for i, c in counts.items():
            if c[w]:
                out[i] += idf * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * len(docs[i]) / mean))
    return sorted((-round(s, 6), i) for i, s in out.items())


@pytest.mark.parametrize("block, first", [(16, 1), (4096, 2)])
def test_inverted_index(spark, monkeypatch, block, first):
    monkeypatch.setattr(inverted, "BLOCK", block)
    monkeypatch.setattr(inverted, "FIRST", first)
    made, df = corpus(spark)
    index = inverted.build_inverted(df)
    asked = [(1, "the w1 w2"), (2, "lone"), (3, "unknown words"), (4, "w5 W5 the"), (5, None), (6, ""), (7, "copies same")]
    queries = spark.createDataFrame(asked, "query_id long, query string")
    got = {}
    for r in inverted.search_inverted(index, queries, 7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.key))
    for i, q in asked:
        want = plain_bm25(made, q or "")[:7]
        assert [k for _, k in got.get(i, [])] == [k for _, k in want] and np.allclose([s for s, _ in got.get(i, [])], [s for s, _ in want], atol=2e-6)
    phrases = spark.createDataFrame([(1, "the w3"), (2, "a b a"), (3, "same text of"), (4, "the the"), (5, "nothing here"), (6, None)], "query_id long, query string")
    found = {(r.query_id, r.key): r.n for r in inverted.phrases_inverted(index, phrases).collect()}
    want = {}
    for i, q in [(1, ["the", "w3"]), (2, ["a", "b", "a"]), (3, ["same", "text", "of"]), (4, ["the", "the"])]:
        for d, t in made:
            w = (t or "").split()
            n = sum(w[j : j + len(q)] == q for j in range(len(w)))
            if n:
                want[i, d] = n
    assert found == want


def test_inverted_index_takes_many_queries(spark):
    made, df = corpus(spark)
    rnd = random.Random(7)
    asked = [(i, " ".join(rnd.choices(["the", "w1", "w2", "w7", "lone", "copies"], k=2))) for i in range(10_000)]
    found = inverted.search_inverted(inverted.build_inverted(df), spark.createDataFrame(asked, "query_id long, query string"), 3)
    rows = {(r.query_id, r["rank"]): (r.key, r.score) for r in found.collect()}
    single = {q: [(k, s) for s, k in plain_bm25(made, q)[:3]] for q in {q for _, q in asked}}
    for i, q in asked:
        for n, (key, score) in enumerate(single[q], 1):
            assert rows[i, n][0] == key and abs(rows[i, n][1] + score) < 2e-6
    literal = search.bm25(df, ["the w1"]).orderBy(F.round("score", 6).desc(), "doc_id").limit(3).collect()
    number = next(i for i, q in asked if set(q.split()) == {"the", "w1"})
    assert [r.doc_id for r in literal] == [rows[number, n][0] for n in (1, 2, 3)]


def test_an_index_is_built_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(inverted, "BLOCK", 64)
    monkeypatch.setattr(inverted, "BLOCK_WORDS", 2000)
    made = [(i, "once " * 50 + f"w{i % 7}") for i in range(300)] + [(300, "long " * 9000), (301, "after"), (302, "")]
    seen = []
    monkeypatch.setattr(inverted, "stage", lambda df, name, keep=inverted.stage: seen.append((name, df)) or keep(df, name))
    index = inverted.build_inverted(spark.createDataFrame(made, "doc_id long, text string").coalesce(3))
    plan = dict(seen)["postings"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    rows = index.blocks.filter("term = 'once'").collect()
    sizes = [len(r["gaps"]) for r in rows]
    assert sum(sizes) == 300 and max(sizes) == 2000 // 51 and len({r["block"] for r in rows}) == len(rows)
    # The long document may follow others in a block only if it fits.
    assert all(r["gaps"][1:] == [1] * (n - 1) and r["counts"] == [50] * n and r["lengths"] == [51] * n for r, n in zip(rows, sizes))
    assert all(r["places"] == ([0] + [1] * 49) * n for r, n in zip(rows, sizes))
    assert index.blocks.filter("term = 'long'").first()["places"] == [0] + [1] * 8999
    assert sorted(r["key"] for r in index.docs.collect()) == list(range(303)) and index.docs.select("number").distinct().count() == 303
    # A block gives the best documents of a query and what ties with them, not every one that has a word of it.
    some = spark.createDataFrame([(1, "once w1")], "query_id long, query string").select("query_id", F.explode(tokens("query")).alias("term"))
    wanted = index.blocks.select("term", "block").join(some, "term").withColumn("idf", F.lit(1.0))
    scored = inverted._scores(index, wanted, 1, 3).groupBy(F.floor(F.col("number") / 64)).count().collect()
    assert scored and max(r["count"] for r in scored) < 20
    # A phrase meets a block once: no row for each place of its words.
    asked = spark.createDataFrame([(i, "once once") for i in range(50)], "query_id long, query string")
    found = inverted.phrases_inverted(index, asked)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.query_id, r.key, r.n) for r in found.collect()) == [(q, d, 49) for q in range(50) for d in range(300)]


def test_inverted_index_of_nothing(spark):
    index = inverted.build_inverted(spark.createDataFrame([], "doc_id long, text string"))
    asked = spark.createDataFrame([(1, "word")], "query_id long, query string")
    assert inverted.search_inverted(index, asked).count() == 0 and inverted.phrases_inverted(index, asked).count() == 0


def test_gibbs_finds_planted_topics(spark):
    rnd = random.Random(0)
    themes = [[f"{t}{i}" for i in range(25)] + ["common"] for t in "abc"]
    made = [(i, rnd.choices(themes[i % 3], k=rnd.randint(3, 40))) for i in range(240)] + [(240, None), (241, []), (242, ["a1", None])]
    made += [(243, themes[0] * 80)]
    df = spark.createDataFrame(made, "doc_id long, words array<string>")
    model = gibbs.fit_gibbs(df, "words", k=3, sweeps=25, part=1200, seed=1)
    # It rises, and stays up.
    assert model.likelihood[-1] > model.likelihood[0] + 0.5 and model.likelihood[-1] > model.likelihood[5]
    topics = {r.doc: r.topic for r in model.doc_topics().collect()}
    found = [Counter(topics[i] for i in range(t, 240, 3)).most_common(1)[0] for t in range(3)]
    assert len({t for t, _ in found}) == 3 and sum(n for _, n in found) >= 0.95 * 240
    rows = model.tokens().collect()
    want = Counter((i, p, w) for i, ws in made for p, w in enumerate(x for x in ws or [] if x is not None))
    assert Counter((r.doc, r.place, r.word) for r in rows) == want
    words = {(r.word, r.topic): r.n for r in model.word_topics().collect()}
    assert words == Counter((r.word, r.topic) for r in rows)
    best = model.topic_words(5).collect()
    assert all({r.word[0] for r in best if r.topic == t} <= {"abc"[k], "c"} for k, (t, _) in enumerate(found))


def test_gibbs_sends_no_copies_of_counts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(gibbs, "stage", lambda df, name, keep=gibbs.stage: seen.append((name, df)) or keep(df, name))
    made = spark.createDataFrame([(i, [f"w{(i * j) % 97}" for j in range(30)]) for i in range(200)], "doc_id long, words array<string>")
    model = gibbs.fit_gibbs(made, "words", k=50, sweeps=2, part=1000)
    plan = [df for name, df in seen if name == "topics"][-1]._jdf.queryExecution().executedPlan().toString()
    assert "__salt" not in plan and "cells" in plan
    rows = model.tokens().groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc").alias("docs"))
    # One shuffle of documents, one of counts; none of words with their documents.
    assert rows._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(word") == 1
    want = Counter(f"w{(i * j) % 97}" for i in range(200) for j in range(30))
    assert {r.word: r.n for r in rows.collect()} == want


def test_gibbs_of_nothing(spark):
    none = gibbs.fit_gibbs(spark.createDataFrame([], "doc_id long, words array<string>"), "words", k=2, sweeps=2)
    assert none.tokens().count() == 0 and none.likelihood == []
    made = spark.createDataFrame([("x", "Some words some")], "doc_id string, text string").select("doc_id", tokens("text").alias("words"))
    assert gibbs.fit_gibbs(made, "words", k=2, sweeps=1).tokens().count() == 3


def test_the_sample_of_an_index_is_bounded_before_it_is_sorted(spark):
    rows = spark.range(0, 20_000, 1, 16).select("id")
    place = F.xxhash64("id", F.lit(0))
    some = vector_index._lowest(rows, place, 100, 20_000)
    assert [r["id"] for r in some.collect()] == [r["id"] for r in rows.orderBy(place, "id").limit(100).collect()]
    assert "xxhash64" in some._jdf.queryExecution().optimizedPlan().toString().split("Filter", 1)[1].split("\n")[0]
    # Copies of one id have one hash: where too few rows lie below the bound, all are looked at.
    copies = spark.range(1000).select(F.lit(7).alias("id"))
    assert vector_index._lowest(copies, F.xxhash64("id", F.lit(0)), 10, 1000).count() == 10
