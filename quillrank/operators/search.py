"""Text search: keyword hits, snippets, TF-IDF, BM25, link importance, query log products."""

from __future__ import annotations

import re

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from quillrank import fixed as X
from quillrank.functions import col, occurrences, safe_ratio, strip_html, tokens, trim_all
from quillrank.operators.corpus import term_counts
from quillrank.plans.ranks import top_by
from quillrank.plans.skew import heavy_keys, repeated, salted, spread_join
from quillrank.session import stage


# Keyword search ----------------------------------------------------------------------------------------------------


def query_words(query: str) -> tuple[str, list[str]]:
    """The trimmed lower-case phrase and its words; with more than one word the phrase counts as one too."""
    phrase = query.strip().lower()
    words = re.split(X.KEYWORD_SPLIT, phrase)
    return phrase, words + [phrase] if len(words) > 1 else words


def _alternation(words: list[str]) -> str:
    # Longest first, so that the leftmost longest word wins where hits overlap.
    longest = sorted({w for w in words if w}, key=lambda w: (-len(w), w))
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in longest)


def _phrase_hits(text: Column, phrase: str, words: list[str]) -> Column:
    if len({w for w in words if w}) <= 1:
        return occurrences(text, phrase)
    found = F.regexp_extract_all(text, F.lit(f"({_alternation(words)})"), F.lit(1))
    return F.size(F.filter(found, lambda h: h == phrase)).cast("bigint")


def keyword_search(
    docs: DataFrame, queries: list[str], doc: str = "id", title: str = "title", content: str = "content"
) -> DataFrame:
    """Documents with a title that hold at least one word of a query.

    hit_count adds the occurrences of every word in title and content, phrase_count those of the whole query after
    overlapping hits are merged. Results order by phrase_count, hit_count, id, all descending. The queries are
    literals, so one pass over the documents serves all of them without a join.
    """
    plain = docs.select(
        doc, trim_all(title).alias("title"), F.lower(strip_html(trim_all(content))).alias("__c")
    ).filter(F.length("title") > 0)
    plain = plain.withColumn("__t", F.lower("title"))
    answers = []
    for q in queries:
        phrase, words = query_words(q)
        if not phrase:
            continue
        hits, exact = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
        for text in (F.col("__t"), F.col("__c")):
            for w in words:
                hits = hits + occurrences(text, w)
            exact = exact + _phrase_hits(text, phrase, words)
        answers.append(F.struct(F.lit(q).alias("query"), exact.alias("phrase_count"), hits.alias("hit_count")))
    rows = plain.select(doc, "title", F.inline(F.array(*answers)))
    return rows.filter(F.col("hit_count") > 0)


def hit_pages(hits: DataFrame, doc: str = "id", size: int = 10, pages: int = 10) -> DataFrame:
    """The first ``pages`` result pages per query with rank, page number and the number of all hits."""
    hits = stage(hits, "hits")
    order = [F.desc("phrase_count"), F.desc("hit_count"), F.desc(doc)]
    best = top_by(hits, ["query"], order, size * pages)
    total = hits.groupBy("query").agg(F.count(F.lit(1)).alias("n_hits"))
    return best.join(total, "query").withColumn("page", F.floor((F.col("rank") - 1) / size).cast("bigint"))


def _once(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hits(text: Column, pattern: str) -> Column:
    """Begin, end and word of every hit, from the lengths of the words and of what stands between them."""
    low = F.lower(text)
    words = F.regexp_extract_all(low, F.lit(f"({pattern})"), F.lit(1))
    pairs = F.slice(F.arrays_zip(F.split(low, pattern, -1).alias("gap"), words.alias("word")), F.lit(1), F.size(words))
    none = F.array().cast("array<struct<begin:int,end:int,word:string>>")

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["word"])
        hit = F.struct(begin.alias("begin"), end.alias("end"), pair["word"].alias("word"))
        return F.struct(end.alias("at"), F.concat(state["hits"], F.array(hit)).alias("hits"))

    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("hits")), step, lambda state: state["hits"])


def _marked(text: Column, hits: Column, start: Column, stop: Column) -> Column:
    """``text`` from ``start`` to ``stop`` with its hits in bold."""

    def part(begin: Column, end: Column) -> Column:
        return F.substring(text, begin + 1, end - begin)

    def step(state: Column, hit: Column) -> Column:
        bold = F.concat(F.lit("<b>"), part(hit["begin"], hit["end"]), F.lit("</b>"))
        return F.struct(hit["end"].alias("at"), F.concat(state["out"], part(state["at"], hit["begin"]), bold).alias("out"))

    first = F.struct(start.cast("int").alias("at"), F.lit("").alias("out"))
    return F.aggregate(hits, first, step, lambda state: F.concat(state["out"], part(state["at"], stop)))


def _pieces(text: Column, hits: Column, phrase: str, top: int) -> Column:
    """The best pieces of a text: every hit is given the number of its piece, and the hits of each number are put together."""
    none = F.array().cast("array<struct<piece:int,stop:int,begin:int,end:int,word:string>>")

    def step(state: Column, hit: Column) -> Column:
        fresh = hit["end"] > state["stop"]
        reach = F.least(F.greatest(hit["begin"] + X.SNIPPET_AFTER, hit["end"]), F.length(text))
        piece, stop = state["piece"] + fresh.cast("int"), F.when(fresh, reach).otherwise(state["stop"])
        numbered = F.struct(piece.alias("piece"), stop.alias("stop"), hit["begin"], hit["end"], hit["word"])
        return F.struct(piece.alias("piece"), stop.alias("stop"), F.concat(state["out"], F.array(numbered)).alias("out"))

    first = F.struct(F.lit(0).alias("piece"), F.lit(-1).alias("stop"), none.alias("out"))
    numbered = F.aggregate(hits, first, step, lambda state: state["out"])

    def whole(own: Column) -> Column:
        start, stop = F.greatest(own[0]["begin"] - X.SNIPPET_BEFORE, F.lit(0)), own[0]["stop"]
        phrases = F.size(F.filter(own, lambda h: h["word"] == phrase))
        # Sorted by its fields: most phrases, then most hits, then the first.
        return F.struct(
            (-phrases).alias("p"), (-F.size(own)).alias("h"), start.alias("start"), stop.alias("stop"), _marked(text, own, start, stop).alias("snippet")
        )

    def grouped(marks: Column) -> Column:
        numbers = F.array_distinct(F.transform(marks, lambda h: h["piece"]))
        return F.transform(numbers, lambda n: _once(F.filter(marks, lambda h: h["piece"] == n), whole))

    best = F.sort_array(_once(numbered, grouped))
    kept = best if top < 0 else F.slice(best, 1, top)
    return F.transform(
        kept,
        lambda x: F.struct(
            x["start"].alias("start"), x["stop"].alias("stop"), (-x["p"]).alias("phrase_count"), (-x["h"]).alias("hits"), x["snippet"].alias("snippet")
        ),
    )


def snippets(
    docs: DataFrame, queries: str | list[str], top: int = 1, doc: str = "id", title: str = "title", content: str = "content"
) -> DataFrame:
    """For every query the matching documents with their marked title and their best ``top`` text pieces (-1: all).

    A piece starts 20 characters before its first hit and ends 80 after the hit's start. A document with hits in its title
    alone has one row without a piece; documents without a title are left out. One scan serves all queries.
    """
    plain = docs.select(doc, trim_all(title).alias("__t"), strip_html(trim_all(content)).alias("__c")).filter(F.length("__t") > 0)
    answers = []
    for query in [queries] if isinstance(queries, str) else queries:
        phrase, words = query_words(query)
        if not phrase:
            continue
        pattern = _alternation(words)
        named, found = _hits(F.col("__t"), pattern), _hits(F.col("__c"), pattern)
        marked = _marked(F.col("__t"), named, F.lit(0), F.length("__t"))
        matching = F.lower("__t").rlike(pattern) | F.lower(F.coalesce("__c", F.lit(""))).rlike(pattern)
        pieces = _pieces(F.col("__c"), found, phrase, top)
        answers.append(F.when(matching, F.struct(F.lit(query).alias("query"), marked.alias("title"), pieces.alias("pieces"))))
    if not answers:
        kind = f"{doc} {dict(docs.dtypes)[doc]}"
        return docs.sparkSession.createDataFrame([], f"{kind}, query string, title string, start int, stop int, phrase_count int, hits int, snippet string")
    rows = plain.select(doc, F.explode(F.filter(F.array(*answers), lambda a: a.isNotNull())).alias("__a"))
    return rows.select(doc, "__a.query", "__a.title", F.inline_outer("__a.pieces"))


def title_match(titles: DataFrame, title: str, query: str, distance: int = 2) -> DataFrame:
    """Titles equal to the query, starting with it, or within an edit distance; the length test runs first."""
    q = query.strip().lower()
    t = F.lower(F.col(title))
    near = (F.abs(F.length(t) - len(q)) <= distance) & (F.levenshtein(t, F.lit(q), distance) >= 0)
    kind = F.when(t == q, "exact").when(t.startswith(q), "prefix").when(near, "edit")
    return titles.withColumn("match", kind).filter(F.col("match").isNotNull())


# Relevance ---------------------------------------------------------------------------------------------------------

TF = {"binary": lambda tf: F.lit(1.0), "count": lambda tf: tf, "log": lambda tf: 1.0 + F.ln(tf)}
IDF = {"plain": lambda n, d: F.ln(n / d), "smooth": lambda n, d: F.ln(1.0 + n / d)}


def tfidf(docs: DataFrame, doc: str = "doc_id", text: str = "text", tf: str = "count", idf: str = "plain") -> DataFrame:
    """Weight of every (document, term). A term found in most documents is split over several tasks."""
    counts = stage(term_counts(docs, doc, text), "term_counts")
    df = stage(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "document_counts")
    joined = spread_join(counts, df, "term", weights=df, weight="df")
    n = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    weight = TF[tf](F.col("tf").cast("double")) * IDF[idf](n, F.col("df").cast("double"))
    return joined.select(doc, "term", "tf", "df", weight.alias("tfidf"))


def bm25(
    docs: DataFrame, queries: list[str], doc: str = "doc_id", text: str = "text", k1: float = 1.2, b: float = 0.75
) -> DataFrame:
    """BM25 of documents for each query, idf = ln((N - n + 0.5) / (n + 0.5) + 1).

    The texts are read once: length and the counts of the query words are all that is kept of them.
    """
    words = {q: list(dict.fromkeys(w for w in re.split(X.KEYWORD_SPLIT, q.strip().lower()) if w)) for q in queries}
    terms = list(dict.fromkeys(w for ws in words.values() for w in ws))

    def uses(term: str) -> Column:
        return F.size(F.filter("__w", lambda x: x == term))

    split = docs.select(doc, tokens(text).alias("__w"))
    counted = split.select(
        doc,
        F.size("__w").alias("length"),
        *[uses(t).alias(f"tf_{i}") for i, t in enumerate(terms)],
    )
    counted = stage(counted, "query_term_counts")
    stats = counted.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.avg("length").alias("avg"),
            *[F.count_if(F.col(f"tf_{i}") > 0).alias(f"df_{i}") for i in range(len(terms))],
        )
    ).scalar()
    rows = counted.withColumn("s", stats)
    norm = k1 * (1.0 - b + b * F.coalesce(safe_ratio(F.col("length"), F.col("s.avg")), F.lit(0.0)))

    def part(i: int) -> Column:
        tf, df, n = F.col(f"tf_{i}").cast("double"), F.col(f"s.df_{i}"), F.col("s.n")
        return F.ln((n - df + 0.5) / (df + 0.5) + 1.0) * tf * (k1 + 1.0) / (tf + norm)

    answers = []
    for q, ws in words.items():
        score = F.lit(0.0)
        for w in ws:
            score = score + part(terms.index(w))
        answers.append(F.struct(F.lit(q).alias("query"), score.alias("score")))
    return rows.select(doc, F.inline(F.array(*answers))).filter(F.col("score") > 0)


def blended(relevance: DataFrame, importance: DataFrame, doc: str, weight: float, k: int) -> DataFrame:
    """(1 - weight) * relevance + weight * importance, both over the largest value; top ``k`` per query."""
    top_rel = relevance.groupBy("query").agg(F.max("score").alias("top"))
    top_imp = importance.agg(F.max("importance")).scalar()
    rows = relevance.join(top_rel, "query").join(importance, doc, "left")
    share = F.coalesce(safe_ratio(F.col("importance"), top_imp), F.lit(0.0))
    score = (1.0 - weight) * F.col("score") / F.col("top") + weight * share
    return top_by(rows.select("query", doc, score.alias("score")), ["query"], [F.desc("score"), F.asc(doc)], k)


def pagerank(edges: DataFrame, iterations: int = 10, damping: float = 0.85, salts: int = 32) -> DataFrame:
    """PageRank over (src, dst, weight); rank of nodes without links out is spread evenly.

    Links are laid out by source once and kept, so a round shuffles the ranks and the sums they send, not the links.
    Sources with very many links are split over several partitions. Every round ends in a staged table. What dead
    ends hold is one minus all that was sent.
    """
    spark = edges.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    summed = stage(edges.groupBy("src", "dst").agg(F.sum("weight").cast("double").alias("weight")), "edges")
    out = summed.groupBy("src").agg(F.sum("weight").alias("out"), F.count(F.lit(1)).alias("cnt"))
    out = stage(out, "out_weights")
    hot = stage(heavy_keys(out, "src", "cnt"), "hot_sources")
    shares = spread_join(summed, out.select("src", "out"), "src", weights=out).select(
        "src", "dst", (F.col("weight") / F.col("out")).alias("part")
    )
    links = salted(shares, hot, "src", salts).repartition(parts, "src", "__salt").persist(StorageLevel.MEMORY_AND_DISK)
    ends = F.explode(F.array("src", "dst")).alias("node")
    nodes = stage(summed.select(ends).distinct().withColumn("got", F.lit(0.0)), "nodes")
    n = float(nodes.count())
    ranks = nodes.select("node", F.lit(1.0 / n).alias("rank")) if n else nodes.select("node", F.col("got").alias("rank"))
    for _ in range(iterations):
        source = repeated(ranks.select(F.col("node").alias("src"), "rank"), hot, "src", salts)
        sent = links.join(source.hint("shuffle_hash"), ["src", "__salt"]).select(
            F.col("dst").alias("node"), (F.col("rank") * F.col("part")).alias("got")
        )
        got = stage(sent.unionAll(nodes).groupBy("node").agg(F.sum("got").alias("got")), "ranks")
        lost = 1.0 - got.agg(F.sum("got")).scalar()
        ranks = got.select("node", ((1.0 - damping) / n + damping * (F.col("got") + lost / n)).alias("rank"))
    if iterations:
        links.unpersist()
    return ranks


# Query log ---------------------------------------------------------------------------------------------------------


def click_entropy(clicks: DataFrame, query: str = "query", item: str = "item") -> DataFrame:
    """-sum p ln p over the clicked items of a query, from two sums per query."""
    n = F.col("n").cast("double")
    counted = clicks.groupBy(query, item).agg(F.count(F.lit(1)).alias("n"))
    sums = counted.groupBy(query).agg(
        F.sum("n").alias("clicks"), F.count(F.lit(1)).alias("items"), F.sum(n * F.ln(n)).alias("__nln")
    )
    total = F.col("clicks").cast("double")
    return sums.withColumn("entropy", F.ln(total) - F.col("__nln") / total).drop("__nln")


def hot_queries(log: DataFrame, query: str, k: int) -> DataFrame:
    from quillrank.plans.ranks import top_rows

    counted = log.groupBy(query).agg(F.count(F.lit(1)).alias("n"))
    return top_rows(counted, [F.desc("n"), F.asc(query)], k)


def suggestions(log: DataFrame, query: str, k: int) -> DataFrame:
    """The ``k`` most frequent queries for every prefix of a query.

    Queries are counted before their prefixes are spelled out.
    """
    counted = log.groupBy(query).agg(F.count(F.lit(1)).alias("n"))
    prefixes = counted.filter(F.length(query) > 0).select(
        F.explode(F.transform(F.sequence(F.lit(1), F.length(query)), lambda i: F.substring(F.col(query), F.lit(1), i))).alias("prefix"),
        query,
        "n",
    )
    return top_by(prefixes, ["prefix"], [F.desc("n"), F.asc(query)], k)


def without_banned(log: DataFrame, banned: DataFrame, query: str, word: str = "word") -> DataFrame:
    """Queries that hold none of the banned words. Distinct queries are tested, not log rows."""
    distinct = log.select(query).distinct()
    bad = (
        distinct.select(query, F.explode(tokens(query)).alias(word))
        .join(banned.select(F.lower(word).alias(word)), word, "left_semi")
        .select(query)
    )
    return log.join(bad, query, "left_anti")


def one_click_per(log: DataFrame, keys: list[str], ts: str, seconds: int) -> DataFrame:
    """Spam cleaning: repeated clicks of the same keys within one time slot count once."""
    slot = F.window(F.col(ts).cast("timestamp"), f"{seconds} seconds")["start"]
    return log.groupBy(*keys, slot.alias("slot")).agg(F.min(ts).alias(ts)).drop("slot")


def season_weighted(log: DataFrame, ts: str, weights: list[float], keys: list[str]) -> DataFrame:
    """Counts weighted by the month of each row; twelve weights."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.month(ts))
    return log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(w).alias("weighted"))


def category_recall(queries: DataFrame, items: DataFrame, category: str, query: str, item: str, score: str, k: int):
    """The best ``k`` items of each query's category: the cut comes before the join."""
    best = top_by(items, [category], [F.desc(score), F.asc(item)], k)
    return queries.join(best.select(category, item, score, "rank"), category)


