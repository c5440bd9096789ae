"""Queries: text search, vocabulary, vectors."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from quillrank.catalog import stand_ins as S
from quillrank.catalog.base import Tables, query, rounded
from quillrank.functions import dirichlet_mean, dirichlet_mode, doubles, tokens
from quillrank.operators import corpus as C, fuzzy as Z, gibbs as G, inverted as N, recommend as R, rules as U, search as Q
from quillrank.operators import vector_index as I, vectors as V
from quillrank.plans.skew import spread_join
from quillrank.session import stage

def texts(t: Tables):
    return t.documents.select("doc_id", "text")


WORDS = ["leaux the", "hein-en", "queeaux"]
WHITE = r"[ \t\n\x0b\f\r]"


def site(t: Tables):
    """pages as search entries: the title element, the raw page, the address."""
    return t.pages.select("page_id", "html", "url").select(
        F.col("page_id").alias("id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("content"),
        "url",
    )


SITE = r"""
site AS (
  SELECT page_id AS id, regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '^\s+|\s+$', '', 'g')
           AS title,
         lower(regexp_replace(regexp_replace(html, '^\s+|\s+$', '', 'g'), '<[^>]+>', '', 'g')) AS c
  FROM pages),
texts AS (SELECT id, title, lower(title) AS t, c FROM site WHERE length(title) > 0)"""


def _count(text: str, word: str) -> str:
    return f"(length({text}) - length(replace({text}, '{word}', ''))) // {len(word)}"


def _hits_sql() -> str:
    parts = []
    for q in WORDS:
        phrase, words = Q.query_words(q)
        hits = " + ".join(_count(x, w) for x in ("t", "c") for w in words)
        pattern = "|".join(sorted(set(words), key=lambda w: (-len(w), w))).replace("-", r"\-")
        exact = " + ".join(
            f"len(list_filter(regexp_extract_all({x}, '{pattern}'), lambda h: h = '{phrase}'))" for x in ("t", "c")
        )
        parts.append(
            f"SELECT id, title, '{q}' AS query, CAST({exact} AS BIGINT) AS phrase_count, "
            f"CAST({hits} AS BIGINT) AS hit_count FROM texts"
        )
    return f"hits AS (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE hit_count > 0)"


HITS = f"{SITE}, {_hits_sql()}"


@query("keyword_search", f"WITH {HITS} SELECT * FROM hits")
def keyword_search(t: Tables):
    return Q.keyword_search(site(t), WORDS)


@query(
    "search_pages",
    f"""WITH {HITS}, r AS (SELECT *, row_number() OVER (PARTITION BY query
      ORDER BY phrase_count DESC, hit_count DESC, id DESC) AS rank, count(*) OVER (PARTITION BY query) AS n_hits
      FROM hits)
    SELECT *, (rank - 1) // 10 AS page FROM r WHERE rank <= 50""",
)
def search_pages(t: Tables):
    return Q.hit_pages(Q.keyword_search(site(t), WORDS), size=10, pages=5)


@query("search_snippets")
def search_snippets(t: Tables):
    return Q.snippets(site(t), WORDS, top=2)


@query(
    "edit_match",
    """SELECT p_partkey, p_name, CASE WHEN p_name = 'red widge' THEN 'exact' WHEN starts_with(p_name, 'red widge')
      THEN 'prefix' ELSE 'edit' END AS match FROM part
    WHERE starts_with(p_name, 'red widge') OR levenshtein(p_name, 'red widge') <= 3""",
)
def edit_match(t: Tables):
    return Q.title_match(t.part.select("p_partkey", "p_name"), "p_name", "red widge", 3)


TERMS = r"""
words AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[\s\-]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE length(term) > 0 GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)"""


@query(
    "tfidf",
    f"""WITH {TERMS} SELECT doc_id, term, tf, df,
    round(tf * ln((SELECT count(*) FROM documents)::DOUBLE / df), 6) AS tfidf FROM tf JOIN df USING (term)""",
)
def tfidf(t: Tables):
    return rounded(Q.tfidf(texts(t)))


@query(
    "tfidf_log",
    f"""WITH {TERMS} SELECT doc_id, term, tf, df,
    round((1 + ln(tf)) * ln(1 + (SELECT count(*) FROM documents)::DOUBLE / df), 6) AS tfidf FROM tf JOIN df USING (term)""",
)
def tfidf_log(t: Tables):
    return rounded(Q.tfidf(texts(t), tf="log", idf="smooth"))


SEARCHES = ["the of tion", "les de la", "nicht und"]


def _bm25_sql() -> str:
    terms = list(dict.fromkeys(w for q in SEARCHES for w in q.split()))
    pairs = ", ".join(f"('{q}', '{w}')" for q in SEARCHES for w in q.split())
    return rf"""
    docs AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\s\-]+'), lambda w: length(w) > 0) AS w
             FROM documents),
    l AS (SELECT doc_id, len(w) AS length, w FROM docs),
    f AS (SELECT doc_id, length, term, len(list_filter(w, lambda x: x = term)) AS tf
          FROM l, (SELECT unnest({terms}) AS term)),
    d AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM f GROUP BY 1),
    s AS (SELECT count(*) AS n, avg(length) AS av FROM l),
    p AS (SELECT doc_id, f.term, ln((n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE) + 1) * tf * 2.2::DOUBLE
             / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / av)) AS part
          FROM f JOIN d ON d.term = f.term, s),
    bm AS (SELECT doc_id, query, sum(part) AS score FROM p
           JOIN (SELECT * FROM (VALUES {pairs}) v(query, word)) ON word = term
           GROUP BY 1, 2 HAVING sum(part) > 0)"""


@query("bm25", f"WITH {_bm25_sql()} SELECT doc_id, query, round(score, 6) AS score FROM bm")
def bm25(t: Tables):
    return rounded(Q.bm25(texts(t), SEARCHES))


@query(
    "search_blend",
    f"""WITH {_bm25_sql()}, i AS (SELECT doc_id, CAST(quality AS DOUBLE) + 1 AS importance FROM labels),
    b AS (SELECT query, bm.doc_id, (1.0::DOUBLE - 0.3::DOUBLE) * score / max(score) OVER (PARTITION BY query)
             + 0.3::DOUBLE * coalesce(importance / (SELECT max(importance) FROM i), 0) AS score
          FROM bm LEFT JOIN i ON i.doc_id = bm.doc_id)
    SELECT query, doc_id, round(score, 6) AS score, rank
    FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank FROM b) WHERE rank <= 50""",
)
def search_blend(t: Tables):
    importance = t.labels.select("doc_id", (F.col("quality").cast("double") + 1.0).alias("importance"))
    return rounded(Q.blended(Q.bm25(texts(t), SEARCHES), importance, "doc_id", 0.3, 50))


ROUNDS = 5


def _pagerank_sql() -> str:
    head = """
    e AS (SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst
          FROM lineitem),
    links AS (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS part FROM (
      SELECT src, dst, CAST(count(*) AS DOUBLE) AS w FROM e WHERE src <> dst GROUP BY 1, 2)),
    nodes AS (SELECT DISTINCT x AS node FROM (SELECT src AS x FROM links UNION ALL SELECT dst FROM links)),
    n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes),
    r0 AS MATERIALIZED (SELECT node, 1 / n AS rank FROM nodes, n)"""
    for i in range(ROUNDS):
        head += f""",
    r{i + 1} AS MATERIALIZED (
      SELECT node, 0.15::DOUBLE / n + 0.85::DOUBLE * (coalesce(got, 0) + lost / n) AS rank
      FROM nodes LEFT JOIN (SELECT dst, sum(rank * part) AS got FROM links JOIN r{i} ON node = src GROUP BY 1)
        ON dst = node,
        n, (SELECT coalesce(sum(rank), 0) AS lost FROM r{i} WHERE node NOT IN (SELECT src FROM links)))"""
    return head


@query("pagerank", f"WITH {_pagerank_sql()} SELECT node, round(rank, 9) AS rank FROM r{ROUNDS}")
def pagerank(t: Tables):
    """Links from each line of an order to the next one: as many as there are lines, however long an order is."""
    after = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    edges = t.lineitem.select(F.col("l_partkey").alias("src"), F.lead("l_partkey").over(after).alias("dst"))
    edges = edges.filter("src <> dst").withColumn("weight", F.lit(1))
    return rounded(Q.pagerank(edges, ROUNDS), 9)


# Query log: part names as queries of the customers who bought them --------------------------------------------------


def searches(t: Tables):
    return t.lineitem.join(t.part.select("p_partkey", "p_name", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))


@query(
    "click_entropy",
    """WITH c AS (SELECT p_name AS query, p_brand AS item, count(*) AS n FROM lineitem JOIN part
                  ON p_partkey = l_partkey GROUP BY 1, 2),
    p AS (SELECT *, n / sum(n) OVER (PARTITION BY query) AS p FROM c)
    SELECT query, CAST(sum(n) AS BIGINT) AS clicks, count(*) AS items, round(-sum(p * ln(p)), 6) AS entropy
    FROM p GROUP BY 1""",
)
def click_entropy(t: Tables):
    clicks = searches(t).select(F.col("p_name").alias("query"), F.col("p_brand").alias("item"))
    return rounded(Q.click_entropy(clicks))


LOG = "log AS (SELECT l_orderkey, l_shipdate, p_name FROM lineitem JOIN part ON p_partkey = l_partkey)"


@query(
    "hot_queries",
    f"""WITH {LOG}, c AS (SELECT p_name, count(*) AS n FROM log GROUP BY 1)
    SELECT * FROM (SELECT *, row_number() OVER (ORDER BY n DESC, p_name) AS rank FROM c) WHERE rank <= 20""",
)
def hot_queries(t: Tables):
    return Q.hot_queries(searches(t), "p_name", 20)


@query(
    "suggestions",
    f"""WITH {LOG}, c AS (SELECT p_name, count(*) AS n FROM log GROUP BY 1),
    p AS (SELECT substr(p_name, 1, CAST(i AS BIGINT)) AS prefix, p_name, n
          FROM (SELECT *, unnest(range(1, length(p_name) + 1)) AS i FROM c))
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY n DESC, p_name) AS rank FROM p)
    WHERE rank <= 5""",
)
def suggestions(t: Tables):
    return Q.suggestions(searches(t), "p_name", 5)


@query(
    "related_queries",
    f"""WITH {LOG}, m AS (SELECT DISTINCT l_orderkey AS user_id, p_name AS item_id FROM log),
    mi AS (SELECT * FROM m), {S.pairs_sql(2, None)}
    SELECT * FROM pairs""",
)
def related_queries(t: Tables):
    matrix = searches(t).select(F.col("l_orderkey").alias("user_id"), F.col("p_name").alias("item_id")).distinct()
    return U.pair_counts(matrix, high=None)


@query(
    "query_cleaning",
    f"""WITH {LOG}, kept AS (SELECT * FROM log WHERE len(list_intersect(string_split(p_name, ' '),
      (SELECT list(DISTINCT lower(p_type)) || ['red', 'ring'] FROM part))) = 0),
    one AS (SELECT DISTINCT l_orderkey, p_name, CAST(l_shipdate AS DATE) AS slot FROM kept)
    SELECT p_name, count(*) AS n FROM one GROUP BY 1""",
)
def query_cleaning(t: Tables):
    banned = t.part.select(F.lower("p_type").alias("word")).unionAll(
        t.spark.sql("SELECT * FROM VALUES ('red'), ('ring') AS v(word)")
    )
    clean = Q.without_banned(searches(t).select("l_orderkey", "l_shipdate", "p_name"), banned, "p_name")
    once = Q.one_click_per(clean, ["l_orderkey", "p_name"], "l_shipdate", 86_400)
    return once.groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))


SEASON = [1.0, 1.0, 0.8, 0.8, 0.9, 1.2, 1.5, 1.5, 1.1, 1.0, 1.4, 2.0]


@query(
    "season_weighting",
    f"""WITH {LOG} SELECT p_name, count(*) AS n, round(sum(CAST({SEASON}[month(l_shipdate)] AS DOUBLE)), 4) AS weighted
    FROM log GROUP BY 1""",
)
def season_weighting(t: Tables):
    return rounded(Q.season_weighted(searches(t), "l_shipdate", SEASON, ["p_name"]), 4)


@query(
    "category_recall",
    """WITH sold AS (SELECT p_brand, p_partkey, CAST(sum(l_quantity) AS DOUBLE) AS score FROM lineitem
      JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS rank
             FROM sold) WHERE rank <= 10),
    q AS (SELECT DISTINCT p_name, p_brand FROM part)
    SELECT p_brand, p_name, p_partkey, round(score, 4) AS score, rank FROM q JOIN best USING (p_brand)""",
)
def category_recall(t: Tables):
    sold = searches(t).groupBy("p_brand", "p_partkey").agg(F.sum("l_quantity").alias("score"))
    queries = t.part.select("p_name", "p_brand").distinct()
    return rounded(Q.category_recall(queries, sold, "p_brand", "p_name", "p_partkey", "score", 10), 4)


# Vocabulary --------------------------------------------------------------------------------------------------------

VOCAB = r"""
vocab AS (SELECT word, count(*) AS cn FROM
  (SELECT unnest(regexp_split_to_array(lower(text), '[\s\-]+')) AS word FROM documents)
  WHERE length(word) > 0 GROUP BY 1 HAVING count(*) >= 5)"""


@query("vocab_counts", f"WITH {VOCAB} SELECT word, cn FROM vocab")
def vocab_counts(t: Tables):
    return C.vocabulary(texts(t))


@query(
    "vocab_total",
    f"WITH {VOCAB} SELECT count(*) AS vocab_size, CAST(sum(cn) AS BIGINT) AS train_words FROM vocab",
)
def vocab_total(t: Tables):
    return C.kept_words(C.vocabulary(texts(t)))


@query(
    "neg_sampling_dist",
    f"""WITH {VOCAB.replace("vocab AS", "vocab AS MATERIALIZED")}, total AS (SELECT sum(pow(cn, 0.75)) AS total FROM vocab)
    SELECT word, cn, round(pow(cn, 0.75) / total, 9) AS prob FROM vocab, total""",
)
def neg_sampling_dist(t: Tables):
    return rounded(C.negative_sampling(stage(C.vocabulary(texts(t)), "vocabulary")), 9)


# Vectors -----------------------------------------------------------------------------------------------------------


def leads(t: Tables):
    """The first vector of each label, as query vectors."""
    first = t.embeddings.groupBy("label").agg(F.min(F.struct("vec_id", "embedding")).alias("v"))
    return first.select(F.col("v.vec_id").alias("query_id"), F.col("v.embedding").alias("embedding"))


def _nearest_sql(score: str, k: int) -> str:
    return f"""
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    q AS (SELECT vec_id AS query_id, e AS f FROM v WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label)),
    s AS (SELECT query_id, vec_id, {score} AS score FROM q, v WHERE vec_id <> query_id)
    SELECT query_id, vec_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id
      ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {k}"""


@query("nearest_vectors", _nearest_sql("list_inner_product(e, f)", 5))
def nearest_vectors(t: Tables):
    return rounded(V.nearest(t.embeddings, leads(t), 5))


@query(
    "nearest_vectors_l1",
    _nearest_sql("list_sum(list_transform(range(1, 65), lambda i: 100::DOUBLE - abs(e[i] - f[i])))", 5),
)
def nearest_vectors_l1(t: Tables):
    return rounded(V.nearest(t.embeddings, leads(t), 5, similarity="l1"))


@query(
    "analogy",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    x AS (SELECT list_transform(range(1, 65), lambda i: a.e[i] - b.e[i] + c.e[i]) AS f FROM v a, v b, v c
          WHERE a.vec_id = 1 AND b.vec_id = 2 AND c.vec_id = 3)
    SELECT CAST(1 AS BIGINT) AS query_id, vec_id, round(score, 6) AS score, rank FROM (
      SELECT vec_id, list_inner_product(e, f) AS score,
             row_number() OVER (ORDER BY list_inner_product(e, f) DESC, vec_id) AS rank
      FROM v, x WHERE vec_id NOT IN (1, 2, 3)) WHERE rank <= 10""",
)
def analogy(t: Tables):
    return rounded(V.analogy(t.embeddings, 1, 2, 3, 10))


@query(
    "vector_names",
    """SELECT vec_id, coalesce(name, 'null') AS name, len(embedding) AS dims FROM embeddings
    LEFT JOIN (SELECT doc_id, 'quality ' || CAST(quality AS VARCHAR) AS name FROM labels) ON doc_id = vec_id""",
)
def vector_names(t: Tables):
    """Names from a table that knows some of the vectors only."""
    name = F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("name")
    names = t.labels.select(F.col("doc_id").alias("vec_id"), name)
    sized = t.embeddings.select("vec_id", F.size("embedding").cast("bigint").alias("dims"))
    return V.with_names(sized, names, "vec_id", "name")


@query(
    "dirichlet",
    """WITH a AS (SELECT l_suppkey, list(n ORDER BY l_linenumber) AS a FROM (
      SELECT l_suppkey, l_linenumber, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1)
    SELECT l_suppkey, round(a[1] / list_sum(a), 6) AS mean_first,
           round((a[1] - 1) / (list_sum(a) - len(a)), 6) AS mode_first FROM a""",
)
def dirichlet(t: Tables):
    counts = t.lineitem.groupBy("l_suppkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    # One entry per line number, of which there are seven.
    rows = counts.groupBy("l_suppkey").agg(R.ordered_items(F.col("l_linenumber"), F.col("n")).alias("a"))
    return rounded(
        rows.select(
            "l_suppkey", dirichlet_mean("a")[0].alias("mean_first"), dirichlet_mode("a")[0].alias("mode_first")
        )
    )


@query("lda_doc_topics")
def lda_doc_topics(t: Tables):
    docs = texts(t).select("doc_id", tokens("text").alias("words"))
    return V.doc_topics(V.fit_topics(docs, "words", k=4, iterations=5, min_df=1), docs, "doc_id")


@query("lda_topic_words")
def lda_topic_words(t: Tables):
    docs = texts(t).select("doc_id", tokens("text").alias("words"))
    return V.topic_words(V.fit_topics(docs, "words", k=4, iterations=5, min_df=1), 10)


@query("word2vec_neighbours")
def word2vec_neighbours(t: Tables):
    """Neighbours of all items of the catalogue; each reads the cells that hold 95 % of the neighbours of a sample."""
    corpus = C.basket_corpus(S.actions(t), low=2, ms=0).select(F.split("list", " ").alias("words"))
    vectors = stage(V.word_vectors(V.fit_word2vec(corpus, "words", size=16, min_count=2, maxIter=3)), "word_vectors")
    numbered = vectors.select(F.col("word").cast("bigint").alias("vec_id"), "embedding")
    queries = numbered.withColumnRenamed("vec_id", "query_id")
    index = I.build_index(numbered)
    found = I.search_index(index, queries, 5, probes=I.probes_for(index, queries, 5))
    return found.select("query_id", F.col("id").alias("vec_id"), "score", "rank")


@query(
    "index_neighbours",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score FROM v q, v
          WHERE q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id)
    SELECT query_id, vec_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id
      ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""",
)
def index_neighbours(t: Tables):
    """The exact neighbours of the stated query set, by the index."""
    asked = t.embeddings.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    found = I.search_index(I.build_index(t.embeddings), asked, 10, exact=True)
    return rounded(found.select("query_id", F.col("id").alias("vec_id"), "score", "rank"))


TITLES = """
titles AS (SELECT page_id AS query_id, lower(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS q FROM pages)"""


def titles(t: Tables):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return t.pages.select(F.col("page_id").alias("query_id"), title.alias("query"))


@query(
    "index_search",
    rf"""WITH {TITLES},
    w AS (SELECT DISTINCT query_id, term FROM (SELECT query_id, unnest(regexp_split_to_array(q, '[\s\-]+')) AS term FROM titles) WHERE length(term) > 0),
    d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\s\-]+'), lambda x: length(x) > 0) AS l FROM documents),
    tf AS (SELECT doc_id, length, term, count(*) AS tf FROM (SELECT doc_id, len(l) AS length, unnest(l) AS term FROM d) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    s AS (SELECT count(*) AS n, avg(len(l)) AS av FROM d),
    p AS (SELECT query_id, doc_id, round(sum(ln((n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE) + 1) * tf * 2.2::DOUBLE
            / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / av))), 6) AS score
          FROM w JOIN tf USING (term) JOIN df USING (term), s GROUP BY 1, 2)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM p) WHERE rank <= 10""",
)
def index_search(t: Tables):
    """The titles of all pages as queries to all documents."""
    found = N.search_inverted(N.build_inverted(texts(t)), titles(t), 10)
    return found.select("query_id", F.col("key").alias("doc_id"), "score", "rank")


@query(
    "index_phrases",
    rf"""WITH {TITLES},
    w AS (SELECT query_id, list_filter(regexp_split_to_array(q, '[\s\-]+'), lambda x: length(x) > 0) AS w FROM titles),
    two AS (SELECT query_id, w[1] AS a, w[2] AS b FROM w WHERE len(w) > 1),
    d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\s\-]+'), lambda x: length(x) > 0) AS l FROM documents),
    r AS (SELECT doc_id, l[i] AS a, l[i + 1] AS b, count(*) AS n FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM d) GROUP BY ALL)
    SELECT query_id, doc_id, n FROM two JOIN r USING (a, b)""",
)
def index_phrases(t: Tables):
    """The first two words of every page title, as a phrase, in all documents."""
    words = tokens("query")
    two = titles(t).filter(F.size(words) > 1).select("query_id", F.array_join(F.slice(words, 1, 2), " ").alias("query"))
    return N.phrases_inverted(N.build_inverted(texts(t)), two).select("query_id", F.col("key").alias("doc_id"), "n")


@query(
    "spelling_candidates",
    r"""WITH v AS (SELECT term, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[\s\-]+')) AS term FROM documents)
      WHERE length(term) > 0 GROUP BY 1),
    q AS (SELECT DISTINCT term AS query FROM (SELECT unnest(regexp_split_to_array(lower(text), '[\s\-]+')) AS term FROM benchmark) WHERE length(term) > 0),
    dq AS (SELECT query, i, substr(query, 1, i - 1) || substr(query, i + 1) AS rest
      FROM (SELECT query, CAST(unnest(range(1, length(query) + 1)) AS BIGINT) AS i FROM q)),
    dv AS (SELECT term, i, substr(term, 1, i - 1) || substr(term, i + 1) AS rest
      FROM (SELECT term, CAST(unnest(range(1, length(term) + 1)) AS BIGINT) AS i FROM v)),
    near AS (SELECT query, term FROM q JOIN v ON query = term UNION SELECT query, term FROM dq JOIN v ON rest = term
      UNION SELECT query, term FROM q JOIN dv ON query = rest UNION SELECT query, term FROM dq JOIN dv USING (i, rest))
    SELECT query, term AS title, CAST(query <> term AS BIGINT) AS distance, n FROM near JOIN v USING (term)""",
)
def spelling_candidates(t: Tables):
    """All words of the documents within one edit of a word of the benchmark, with their counts."""
    vocabulary = stage(C.term_counts(texts(t), "doc_id", "text").groupBy("term").agg(F.sum("tf").alias("n")), "vocabulary")
    asked = t.benchmark.select(F.explode(tokens("text")).alias("query"))
    near = Z.edit_join(asked, vocabulary, "query", "term", 1)
    return spread_join(vocabulary.withColumnRenamed("term", "title"), near, "title").select("query", "title", "distance", "n")


@query(
    "gibbs_word_counts",
    r"""SELECT term AS word, count(*) AS n, count(DISTINCT doc_id) AS docs, CAST(50 AS BIGINT) AS k
    FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[\s\-]+')) AS term FROM documents) WHERE length(term) > 0 GROUP BY 1""",
)
def gibbs_word_counts(t: Tables):
    """Counts of words over all topics of a sampled model: every token has one topic of fifty."""
    model = G.fit_gibbs(texts(t).select("doc_id", tokens("text").alias("words")), "words", k=50, sweeps=2)
    rows = model.tokens().filter((F.col("topic") >= 0) & (F.col("topic") < 50))
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc").alias("docs"), F.lit(50).cast("bigint").alias("k"))


@query("gibbs_topic_words")
def gibbs_topic_words(t: Tables):
    model = G.fit_gibbs(texts(t).select("doc_id", tokens("text").alias("words")), "words", k=50, sweeps=5)
    return rounded(model.topic_words(10))


@query("bag_of_words_components")
def bag_of_words_components(t: Tables):
    from pyspark.ml.functions import vector_to_array

    docs = texts(t).select("doc_id", tokens("text").alias("words"))
    parts = V.count_embedding(docs, "words", 4)
    return parts.select("doc_id", vector_to_array("components").alias("components"), doubles(F.array(F.size("words"))).alias("n"))
