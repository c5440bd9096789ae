"""Quality classifier: perplexity under interpolated modified Kneser-Ney models trained on all trusted text.

Two models judge a document. One has word bigrams (see ``word_ngrams``): its tables are sharded and grow with the text, and
the distinct bigrams of all documents are looked up in them. It sees word lists and texts without order, which are made of
ordinary letters, and, by the counts of a document's own bigrams, words that are written over and over. The other has
character trigrams: the ALPHABET - 2 most frequent characters of the trusted text, one token for all others and one for
the start of a text. Its tables have a size bound that no corpus can exceed (ALPHABET ** 3 trigrams, 8 MB as floats), so the
finished model may be broadcast at any scale; it judges words that the word model has never seen. All trusted documents
are counted in both.

Tasks count their own n-grams before anything is shuffled. Count tables are sharded by context; discounts, continuation
counts, back-off weights and interpolated probabilities are aggregates and joins of those tables.

Limits are quantiles of each language's trusted documents: QUANTILE of the mean negative log-probabilities, and
REPEATS_QUANTILE of what a text's own repeats save a word, but REPEATS_LEAST nats at least. Means are pulled
towards their language's median by PRIOR characters or WORD_PRIOR words before they are held against the limits, which keeps
short clean texts. The quantiles were chosen on the labelled rows of sf0.1.

Defined cases: null texts count as empty; empty texts have no perplexity and are kept; a language without trusted
documents (null is a language) takes the limits over all trusted documents; without trusted text all is kept; labels may
repeat, and a document is trusted if all its labels say so; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from quillrank.llm import word_ngrams
from quillrank.plans.skew import spread_join
from quillrank.session import stage

ALPHABET = 128
START, OTHER = 0, 1
PRIOR = 200
WORD_PRIOR = 50
QUANTILE = 0.99
REPEATS_QUANTILE, REPEATS_LEAST = 0.999, 0.5
# Trusted keys that are broadcast, of eight bytes each.
IDS = 4_000_000
_POINTS = 0x110000


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after two starts (0), and the number of characters of each."""
    sizes = np.array([len(t or "") for t in texts], dtype=np.int64)
    whole = "".join("\0\0" + (t or "").replace("\0", "�") for t in texts)
    return np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), sizes


def _count_rows(counts: np.ndarray) -> pa.RecordBatch:
    seen = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen].astype(np.int64))], ["key", "n"])


def _trusted_texts(batch: pa.RecordBatch, shared) -> list[str]:
    """Of a batch (doc_id, again, text)."""
    marks = word_ngrams.marks(batch.column(0), batch.column(1), shared.value)
    return batch.column(2).filter(pa.array(marks > 0)).to_pylist()


def _characters(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_POINTS, dtype=np.int64)
        for batch in batches:
            codes, _ = _codes(_trusted_texts(batch, shared))
            if len(codes):
                part = np.bincount(codes)
                total[: len(part)] += part
        total[0] = 0
        yield _count_rows(total)

    return count


def _trigram_keys(codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all windows that end in a character of a text, and where they end."""
    ids = table[codes].astype(np.int64)
    ends = np.flatnonzero(ids != START)
    return (ids[ends - 2] * ALPHABET + ids[ends - 1]) * ALPHABET + ids[ends], ends


def _trigrams(table: np.ndarray, shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting = np.zeros(ALPHABET**3, dtype=np.int64), []
        for batch in batches:
            waiting.append(_trigram_keys(_codes(_trusted_texts(batch, shared))[0], table)[0])
            if sum(map(len, waiting)) > len(total):
                total += np.bincount(np.concatenate(waiting), minlength=len(total))
                waiting = []
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=len(total))
        yield _count_rows(total)

    return count


def counted(texts: DataFrame, function) -> DataFrame:
    parts = texts.mapInArrow(function, "key long, n long")
    return parts.groupBy("key").agg(F.sum("n").alias("n"))


def _discounts(few: Sequence[int]) -> list[float]:
    """The modified Kneser-Ney discounts of the counts 1, 2 and more, from how many counts are 1, 2, 3 and 4."""
    n = [max(int(x), 1) for x in few]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.05), k + 0.95) for k in range(3)]


def _discount(counts: DataFrame) -> Column:
    """The discount of a count n."""
    d = _discounts(counts.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first())
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def _interpolated(counts: DataFrame, lower: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Probabilities (key, p) of the seen n-grams, and back-off weights (context, weight).

    ``counts`` has key, context, low (the key without its first token) and n; ``lower`` has (low, q) of the next order.
    """
    less = _discount(counts)
    contexts = counts.groupBy("context").agg(F.sum("n").alias("total"), F.sum(less).alias("mass"))
    weights = contexts.select("context", "total", (F.col("mass") / F.col("total")).alias("weight"))
    p = (F.col("n") - less) / F.col("total") + F.col("weight") * F.col("q")
    seen = counts.join(weights, "context").join(lower, "low").select("key", p.alias("p"))
    return seen, weights.select("context", "weight")


def model(trigrams: DataFrame) -> np.ndarray:
    """log p(z | x y) for every trigram key (x, y, z), from the counts (key, n) of all trusted text."""
    a = ALPHABET

    def number(column: Column) -> Column:
        return column.cast("long")

    third = trigrams.select("key", number(F.floor(F.col("key") / a)).alias("context"), (F.col("key") % (a * a)).alias("low"), "n")
    second = third.groupBy(F.col("low").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    second = second.select("key", number(F.floor(F.col("key") / a)).alias("context"), (F.col("key") % a).alias("low"), "n")
    first = second.groupBy(F.col("low").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    first = first.select("key", F.lit(0).alias("context"), F.lit(0).alias("low"), "n")
    uniform = first.sparkSession.range(1).select(F.lit(0).alias("low"), F.lit(1.0 / a).alias("q"))
    p1, w1 = _interpolated(first, uniform)
    p2, w2 = _interpolated(second, p1.select(F.col("key").alias("low"), F.col("p").alias("q")))
    p3, w3 = _interpolated(third, p2.select(F.col("key").alias("low"), F.col("p").alias("q")))

    def dense(seen: DataFrame, weights: DataFrame, lower: np.ndarray, contexts: int) -> np.ndarray:
        """At most ALPHABET ** 3 numbers: unseen n-grams take the weighted lower order."""
        back = np.ones(contexts)
        got = weights.toPandas()
        back[got["context"].to_numpy(dtype=np.int64)] = got["weight"].to_numpy()
        # The lower order's row of a context is that of its last token.
        table = (back[:, None] * np.resize(lower, (contexts, a))).reshape(-1)
        got = seen.toPandas()
        table[got["key"].to_numpy(dtype=np.int64)] = got["p"].to_numpy()
        return table

    one = dense(p1, w1, np.full(a, 1.0 / a), 1)
    two = dense(p2, w2, one, a)
    three = dense(p3, w3, two, a * a)
    return np.log(three).astype(np.float32)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents whose labels all say quality 1."""
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = F.min(F.when(F.col("quality") == 1, 1).otherwise(0))
    return known.agg(good.alias("good")).filter("good = 1").select("doc_id")


def marked(docs: DataFrame, trusted: DataFrame) -> tuple[DataFrame, Broadcast]:
    """``docs`` with a column ``again`` (null: look into the broadcast), and the trusted keys with whether several rows have
    them. No text is shuffled for up to IDS trusted keys; beyond that the column says it, and the broadcast is empty."""
    rows = docs.filter("text <> '' and doc_id is not null").groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("again"))
    known = stage(rows.join(trusted, "doc_id"), "trusted_rows")
    context = docs.sparkSession.sparkContext
    if known.count() > IDS:
        return spread_join(docs, known, "doc_id", "left", salt=word_ngrams.row_id()), context.broadcast(None)
    table = known.toArrow().sort_by("doc_id")
    ids, again = (table.column(c).to_numpy() for c in ("doc_id", "again"))
    return docs.withColumn("again", F.lit(None).cast("boolean")), context.broadcast((ids, again))


def perplexities(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """(rid, doc_id, lang, n, nll): characters and summed negative log-probability of every document (doc_id, lang, text)."""
    texts = docs.filter("text <> ''").select("doc_id", "again", "text")
    top = counted(texts, _characters(shared)).orderBy(F.desc("n"), "key").limit(ALPHABET - 2).collect()
    table = np.full(_POINTS, OTHER, dtype=np.uint8)
    table[0] = START
    table[[r["key"] for r in top]] = np.arange(2, 2 + len(top))
    trigrams = stage(counted(texts, _trigrams(table, shared)), "trigrams")
    judge = docs.sparkSession.sparkContext.broadcast((table, model(trigrams)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs = judge.value
        for batch in batches:
            codes, sizes = _codes(batch.column(3).to_pylist())
            keys, ends = _trigram_keys(codes, known)
            owner = np.repeat(np.arange(len(sizes)), sizes + 2)[ends]
            nll = -np.bincount(owner, weights=logs[keys], minlength=len(sizes))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes), pa.array(nll + 0.0)], ["rid", "doc_id", "lang", "n", "nll"]
            )

    named = docs.select(word_ngrams.row_id().alias("rid"), "doc_id", "lang", "text")
    return named.mapInArrow(score, "rid long, doc_id long, lang string, n long, nll double")


def classify(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, lang, n_chars, perplexity, limit (both per character), n_words, word_perplexity, word_limit, repeats,
    repeats_limit (both in nats a word) and kept.

    Trains on the documents that ``labels`` (doc_id, quality) trusts. Writes tables below the shared folder, the texts as
    packed word numbers among them, and runs jobs while it builds its result.
    """
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.col(lang).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    trusted = stage(trusted_ids(labels), "trusted")
    docs, shared = marked(docs, trusted)
    chars = perplexities(docs, shared)
    by_words = word_ngrams.scored(docs, shared, _discounts)
    scores = stage(chars.join(by_words, "rid", "left"), "scores")
    mean, word_mean = F.col("nll") / F.col("n"), F.col("word_nll") / F.col("n_words")
    repeats = F.col("word_saved") / (F.col("n_words") + WORD_PRIOR)
    sample = spread_join(scores.filter("n > 0"), trusted, "doc_id")
    limits = {
        "chars": (mean, [0.5, QUANTILE]),
        "words": (word_mean, [0.5, QUANTILE]),
        "repeats": (repeats, [REPEATS_QUANTILE]),
    }
    found = [F.percentile_approx(x, shares, 10000).alias(name) for name, (x, shares) in limits.items()]
    # One row a language, and one for all under a null group beside the null language.
    language = F.struct(F.coalesce("lang", F.lit("")).alias("l"), F.col("lang").isNull().alias("none")).alias("l")
    by_lang = sample.groupBy("lang").agg(*found).select(language, *limits)
    whole = sample.agg(*found).first()
    rows = spread_join(scores.withColumn("l", language), by_lang, "l", "left", salt=F.xxhash64("doc_id"))

    def at(name: str, k: int) -> Column:
        wide = F.lit(None).cast("double") if whole[name] is None else F.lit(whole[name][k])
        return F.coalesce(F.get(name, F.lit(k)), wide)

    middle, limit = at("chars", 0), at("chars", 1)
    word_middle, word_limit = at("words", 0), at("words", 1)
    most = F.greatest(at("repeats", 0), F.lit(REPEATS_LEAST))
    pulled = (F.col("nll") + PRIOR * middle) / (F.col("n") + PRIOR)
    word_pulled = (F.col("word_nll") + WORD_PRIOR * word_middle) / (F.col("n_words") + WORD_PRIOR)
    judged = middle.isNotNull() & (F.col("n") > 0)
    bad = (pulled > limit) | F.coalesce((word_pulled > word_limit) | (repeats > most), F.lit(False))
    return rows.select(
        "doc_id",
        "lang",
        F.col("n").alias("n_chars"),
        F.when(F.col("n") > 0, F.exp(mean)).alias("perplexity"),
        F.exp(limit).alias("limit"),
        F.coalesce("n_words", F.lit(0)).alias("n_words"),
        F.exp(word_mean).alias("word_perplexity"),
        F.exp(word_limit).alias("word_limit"),
        repeats.alias("repeats"),
        most.alias("repeats_limit"),
        ~F.coalesce(judged & bad, F.lit(False)),
    ).toDF(
        "doc_id", "lang", "n_chars", "perplexity", "limit", "n_words", "word_perplexity", "word_limit", "repeats", "repeats_limit", "kept"
    )
