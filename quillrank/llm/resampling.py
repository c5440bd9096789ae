"""Target-distribution importance resampling over hashed word runs, with a head-tail vocabulary.

A feature is a run of one to three words; its bucket is the CRC-32 of its bytes modulo BUCKETS. The CRC of a run follows
from the CRC states of its parts: appending a word of n bytes to a state is a linear map that depends on n alone, kept as
four tables of 256 entries per n, so that all runs of a batch are found by array look-ups.

The head is broadcast: HEAD_WORDS frequent words with their exact states, and HEAD_PAIRS frequent pairs of them with
their states and buckets. All texts are counted for it; a task keeps the largest counts only and sends at most FREQUENT words
and pairs, which are summed. All other words, the tail, take the CRC of their bytes directly, and pairs outside the head
are put together from states. So the head decides the time only, and the bucket totals are exact.

Three passes read the texts: for the head, for the bucket totals of documents and of the target, and for the weights.
Only the totals (at most BUCKETS numbers) and the head (bounded, see above) pass through the driver. Ranks come from a
range sort of all rows' scores.

Defined cases: a null text has no words; words are cut from the bytes of the whole text; a document without words has
weight 0; a null key counts as an empty text in the random draw and stands last among equal scores; repeated rows are
drawn each, and equal ones stand side by side in any order; an empty target or corpus has totals of 0; an empty table
gives an empty result; all other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillrank.llm.bpe import Codes
from quillrank.llm.common import documents
from quillrank.plans.ranks import global_row_number
from quillrank.session import stage

BUCKETS = 10_000
LEAST_WORDS, PERCENT, SEED = 20, 5, 42
HEAD_WORDS, HEAD_PAIRS, FREQUENT = 32_768, 32_768, 16_384
# A worker remembers this many tail words.
TAIL = 300_000
# Words up to this length have their tables; longer ones are rare and take the CRC step by step.
LONGEST = 63
_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
# Upper case becomes lower case; what is no part of a word becomes a space.
_FOLD = bytes(b if b in _KEPT else 32 for b in bytes(range(256)).lower())


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _shifts() -> np.ndarray:
    """[n, k, b]: what byte k = b of a CRC becomes when n more bytes follow."""
    value = np.arange(256, dtype=np.uint32)
    step = value.copy()
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    out = np.empty((LONGEST + 2, 4, 256), dtype=np.uint32)
    out[0] = [value << np.uint32(8 * k) for k in range(4)]
    for n in range(1, LONGEST + 2):
        out[n] = (out[n - 1] >> np.uint32(8)) ^ step[out[n - 1] & np.uint32(255)]
    return out


_SHIFTS = _shifts().ravel()


class Head:
    """Frequent words and pairs, and the states of all words that a worker knows."""

    def __init__(self, head: list[bytes], pairs: list[tuple[int, int]]):
        self.head = head
        self.forget()
        first = np.array([a for a, _ in pairs], np.int64)
        second = np.array([b for _, b in pairs], np.int64)
        keys = first * len(head) + second
        order = np.argsort(keys)
        self.pairs = keys[order]
        self.pair_state = self.follow(self.state[first], second)[order]
        self.pair_bucket = (self.pair_state % BUCKETS).astype(np.int16)

    def forget(self) -> None:
        """Keep the head alone."""
        self.codes = Codes(zip(self.head, range(len(self.head))))
        self.listed: list[bytes] = []
        self.state = self.spaced = np.empty(0, np.uint32)
        self.size = np.empty(0, np.int64)
        self.learn(self.head)

    def learn(self, new: list[bytes]) -> None:
        """Add words, which ``codes`` has numbered on."""
        self.listed += new
        crc = zlib.crc32
        self.state = np.append(self.state, np.array([crc(w) for w in new], np.uint32))
        # The separator counts as the first byte of what follows it.
        self.spaced = np.append(self.spaced, np.array([crc(b" " + w) for w in new], np.uint32))
        self.size = np.append(self.size, np.array([len(w) + 1 for w in new], np.int64))

    def follow(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """States after a space and the words ``code``."""
        size = self.size[code]
        at = np.minimum(size, LONGEST + 1) * 1024
        low = state.astype(np.int64)
        out = (
            _SHIFTS[at + (low & 255)]
            ^ _SHIFTS[at + 256 + (low >> 8 & 255)]
            ^ _SHIFTS[at + 512 + (low >> 16 & 255)]
            ^ _SHIFTS[at + 768 + (low >> 24)]
            ^ self.spaced[code]
        )
        for k in np.flatnonzero(size > LONGEST + 1).tolist():
            out[k] = zlib.crc32(b" " + self.listed[code[k]], int(state[k]))
        return out

    def coded(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words, and the number of words of each text."""
        cut = [words(t) for t in texts]
        if self.full():
            self.forget()
        code = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(cut)), np.int64)
        self.learn(list(islice(self.codes, len(self.listed), None)))
        return code, np.array([len(c) for c in cut], np.int64)

    def full(self) -> bool:
        return len(self.listed) > len(self.head) + TAIL

    def buckets(self, code: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(number of the text, bucket) of all features, by the number of words in a feature."""
        text = np.repeat(np.arange(len(sizes)), sizes)
        one = self.state[code]
        out = [(text, one % BUCKETS)]
        start = np.flatnonzero(text[1:] == text[:-1])
        a, b = code[start], code[start + 1]
        if len(self.pairs):
            both = (a < len(self.head)) & (b < len(self.head))
            key = np.where(both, a * len(self.head) + b, -1)
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            known = self.pairs[at] == key
        else:
            at, known = np.zeros(len(start), np.int64), np.zeros(len(start), bool)
        two, bucket = np.empty(len(start), np.uint32), np.empty(len(start), np.int64)
        two[known], bucket[known] = self.pair_state[at[known]], self.pair_bucket[at[known]]
        rest = ~known
        two[rest] = self.follow(one[start[rest]], b[rest])
        bucket[rest] = two[rest] % BUCKETS
        out.append((text[start], bucket))
        longer = np.flatnonzero(text[start[1:] + 1] == text[start[:-1]]) if len(start) > 1 else start[:0]
        longer = longer[start[longer + 1] == start[longer] + 1]
        three = self.follow(two[longer], code[start[longer] + 2])
        return [*out, (text[start[longer]], three % BUCKETS)]


class Tally:
    """Counts of the most frequent of many numbers: at most 16 FREQUENT of them are kept at any time."""

    def __init__(self):
        self.named: dict[tuple[bytes, bytes | None], int] = {}
        self.waiting: list[np.ndarray] = []
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        if sum(map(len, self.waiting)) > 64 * FREQUENT:
            self.sum()

    def sum(self) -> None:
        new, n = np.unique(np.concatenate([np.empty(0, np.int64), *self.waiting]), return_counts=True)
        keys, at = np.unique(np.concatenate([self.keys, new]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([self.counts, n]), minlength=len(keys)).astype(np.int64)
        if len(keys) > 16 * FREQUENT:
            kept = np.argpartition(-counts, 16 * FREQUENT)[: 16 * FREQUENT]
            keys, counts = keys[kept], counts[kept]
        self.keys, self.counts, self.waiting = keys, counts, []

    def name(self, of) -> None:
        """Put words in the place of numbers, before the numbers change; only the most frequent stay."""
        self.sum()
        best = np.argsort(-self.counts, kind="stable")[:FREQUENT]
        for key, n in zip(self.keys[best].tolist(), self.counts[best].tolist()):
            words = of(key)
            self.named[words] = self.named.get(words, 0) + n
        if len(self.named) > 4 * FREQUENT:
            self.named = dict(sorted(self.named.items(), key=lambda x: -x[1])[:FREQUENT])
        self.keys, self.counts = self.keys[:0], self.counts[:0]


def _bytes(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.col("text").cast("binary").alias("text"))


def head(texts: DataFrame) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The most frequent words, and the most frequent pairs of them by their places in that list."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Head([], [])
        ones, twos = Tally(), Tally()

        def name() -> None:
            ones.name(lambda v: (known.listed[v], None))
            twos.name(lambda v: (known.listed[v >> 32], known.listed[v & 0xFFFFFFFF]))

        for batch in batches:
            if known.full():
                name()
            code, sizes = known.coded(batch.column(1).to_pylist())
            text = np.repeat(np.arange(len(sizes)), sizes)
            ones.add(code)
            start = np.flatnonzero(text[1:] == text[:-1])
            twos.add(code[start] << 32 | code[start + 1])
        name()
        for counts in (ones.named, twos.named):
            best = sorted(counts.items(), key=lambda x: -x[1])[:FREQUENT]
            a, b, n = [k[0] for k, _ in best], [k[1] for k, _ in best], [c for _, c in best]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], ["a", "b", "n"])

    counts = stage(_bytes(texts).mapInArrow(count, "a binary, b binary, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "head")
    short = F.length("a") <= LONGEST
    frequent = counts.filter(F.col("b").isNull() & short).orderBy(F.desc("n"), "a").limit(HEAD_WORDS)
    listed = [bytes(r["a"]) for r in frequent.select("a").collect()]  # at most HEAD_WORDS of LONGEST bytes
    place = {w: k for k, w in enumerate(listed)}
    pairs = counts.filter(F.col("b").isNotNull() & short & (F.length("b") <= LONGEST)).orderBy(F.desc("n"), "a", "b").limit(HEAD_PAIRS)
    found = [(bytes(r["a"]), bytes(r["b"])) for r in pairs.select("a", "b").collect()]  # at most HEAD_PAIRS
    return listed, [(place[a], place[b]) for a, b in found if a in place and b in place]


def totals(texts: DataFrame, known) -> np.ndarray:
    """Features by bucket. ``known`` is the broadcast head."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        table = _head(known)
        for batch in batches:
            for _, bucket in table.buckets(*table.coded(batch.column(1).to_pylist())):
                sums += np.bincount(bucket, minlength=BUCKETS)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(sums[used], pa.int64())], ["bucket", "n"])

    rows = _bytes(texts).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)  # one row per bucket at most
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


_HEADS: dict[int, Head] = {}


def _head(known) -> Head:
    """One table per worker and broadcast."""
    if known.value[2] not in _HEADS:
        _HEADS.clear()
        _HEADS[known.value[2]] = Head(*known.value[:2])
    return _HEADS[known.value[2]]


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of shares) of every bucket."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row, staged."""
    spark = df.sparkSession
    corpus = documents(df, key, text)
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col(target_text), F.lit("")).alias("text"))
    listed, pairs = head(corpus)
    known = spark.sparkContext.broadcast((listed, pairs, hash((tuple(listed), tuple(pairs)))))
    gain = spark.sparkContext.broadcast(gains(totals(corpus, known), totals(wanted, known)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, by = _head(known), gain.value.astype(np.float64)
        for batch in batches:
            code, sizes = table.coded(batch.column(1).to_pylist())
            number, weight = np.zeros(len(sizes), np.int64), np.zeros(len(sizes))
            for text, bucket in table.buckets(code, sizes):
                number += np.bincount(text, minlength=len(sizes))
                weight += np.bincount(text, weights=by[bucket], minlength=len(sizes))
            columns = [batch.column(0), pa.array(sizes), pa.array(number), pa.array(weight.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return stage(_bytes(corpus).mapInArrow(score, "doc_id long, n_words long, n_features long, weight long"), "weights")


def noise(key: Column, seed: int = SEED) -> Column:
    """floor(1000 x a Gumbel number) from the first 32 bits of a hash of the key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(weights: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``weights`` with score, and the rank of the rows that are drawn: ``percent`` of those with enough words."""
    enough = F.col("n_words") >= least_words
    drawn = weights.filter(enough).count() * percent // 100
    scored = weights.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    # Equal rows are told apart by their place in the staged table, so that a frequent key can be split.
    placed = scored.withColumn("__tie", F.monotonically_increasing_id()).withColumn("__enough", enough)
    order = [F.desc("__enough"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("__tie")]
    ranked = global_row_number(placed, order, "__rank")
    return ranked.withColumn("rank", F.when(F.col("__enough") & (F.col("__rank") <= drawn), F.col("__rank"))).drop("__tie", "__enough", "__rank")


def digest(drawn: DataFrame) -> DataFrame:
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
