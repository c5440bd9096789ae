"""Repeated passages: runs of consecutive sentences that occur elsewhere are removed but for their first place.

A text is cut into sentences after . ! ? ; their full-width forms and line breaks. One of fewer than SHORT words joins the
next one; one of more than LONG words is cut again after words whose checksum is divisible by CUT. So a passage is cut
alike wherever it stands, with or without punctuation. From every sentence on, the shortest run of at least two
sentences and MIN_WORDS words is hashed (lower case, white space collapsed), and so is the shortest such run up to every
sentence. Hashes are joined globally; the first place of a run is the smallest (doc_id, sentence). Sentences covered by any
other place of it go.

Runs from each sentence are searched first. A repeated run up to a sentence begins with a repeated run of the first kind, so
runs of the second kind are made only where one of those starts.

Only (hash, doc_id, place) rows are shuffled for the search; a hash that holds a third of all rows is counted and reduced
to its first place by partial aggregates, and its places meet that one row in a join that spreads the most frequent hashes.

Defined cases: null texts count as empty and come out empty; a text with no repeated run comes out as it is, to the last
character; rows that share a key are taken as one document: their equal places are all first ones; a run repeated inside
one text goes from its second place on; other columns are ignored by ``repeated`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quillrank.llm.common import documents
from quillrank.plans.skew import spread_join
from quillrank.session import stage, view

MIN_WORDS = 20
SHORT, LONG, CUT = 4, 12, 6
# One set of characters comes first, because the search for a set is much faster than that for alternatives.
_END = re.compile(r"[.!?;。！？；\n](?:(?<=[.!?;])[.!?;]*(?=\s)\s*|(?<=[。！？；])[。！？；]*\s*|(?<=\n)\s*)")
_WORD = re.compile(r"\S+\s*")
_PRIME = 0x9E3779B97F4A7C15


def sentences(text: str) -> list[int]:
    """End offsets of the sentences of a text; the first one starts at 0."""
    ends, start = [], 0
    before = 0
    for stop in [m.end() for m in _END.finditer(text)] + [len(text)]:
        if stop != len(text) and text.count(" ", before, stop) < SHORT + 1 and len(text[before:stop].split()) < SHORT:
            before = stop
            continue
        before = stop
        if stop == start:
            continue
        if text.count(" ", start, stop) >= LONG:
            # Words with the white space behind them: together they reach from the first one to the sentence's end.
            words = _WORD.findall(text, start, stop)
            if len(words) > LONG:
                at = stop - sum(map(len, words))
                for word, plain in zip(words[:-1], text[start:stop].lower().split()):
                    at += len(word)
                    if not crc32(plain.encode()) % CUT:
                        ends.append(at)
        ends.append(stop)
        start = stop
    return ends


def runs(text: str, forward: bool = True, starts: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """hash, first and last sentence of the shortest runs from every sentence on and, but for those, up to every sentence.

    Those of the first kind are left out without ``forward``, those of the second kind that do not begin at ``starts``.
    """
    ends = sentences(text)
    n = len(ends)
    parts = [text[a:b].lower().split() for a, b in zip([0, *ends], ends)]
    if n < 2 or sum(map(len, parts)) < MIN_WORDS:
        return np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32)
    size = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    at = np.arange(n)
    last = np.maximum(np.searchsorted(size, size[:-1] + MIN_WORDS), at + 2)
    to = at + 1
    back = np.minimum(np.searchsorted(size, size[1:] - MIN_WORDS, side="right") - 1, at - 1)
    new = (back >= 0) & (last[back] != to)
    if starts is not None:
        new &= np.isin(back, starts)
    whole = (last <= n) & forward
    first, last = np.concatenate([at[whole], back[new]]), np.concatenate([last[whole], to[new]])
    # Polynomial hashes of prefixes modulo 2^64, one Python integer a sentence.
    prefix, power = [0], [1]
    for p in parts:
        prefix.append((prefix[-1] * _PRIME + xxhash.xxh3_64_intdigest(" ".join(p))) & 0xFFFFFFFFFFFFFFFF)
        power.append((power[-1] * _PRIME) & 0xFFFFFFFFFFFFFFFF)
    prefix, power = np.array(prefix, dtype=np.uint64), np.array(power, dtype=np.uint64)
    with np.errstate(over="ignore"):
        value = prefix[last] - prefix[first] * power[last - first]
    return value, first.astype(np.int32), (last - 1).astype(np.int32)


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs from each sentence of (doc_id, text), or runs up to each sentence of (doc_id, text, starts)."""
    for batch in batches:
        keys, texts = (batch.column(k).to_pylist() for k in (0, 1))
        kinds = [(True, [])] * len(keys) if batch.num_columns == 2 else [(False, s) for s in batch.column(2).to_pylist()]
        found = [(i, *runs(t, *kind)) for i, t, kind in zip(keys, texts, kinds)]
        keys = np.repeat(np.array([f[0] for f in found], dtype=np.int64), [len(f[1]) for f in found])
        hashes, first, last = (np.concatenate([f[k] for f in found] or [np.empty(0)]) for k in (1, 2, 3))
        places = first.astype(np.int64) << 32 | last.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes.astype(np.uint64).view(np.int64)), pa.array(keys), pa.array(places)], ["h", "doc_id", "place"]
        )


RUN = "h long, doc_id long, place long"


def repeated(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): per text with repeats, the spans that are not the first of their kind.

    A span is first sentence * 2^32 + last sentence.
    """
    docs = documents(df, key, text).filter("doc_id is not null")
    found = stage(docs.mapInArrow(_run_rows, RUN), "runs")
    often = stage(found.groupBy("h").agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1"), "often")
    place = F.xxhash64("doc_id", "place")
    shared = stage(spread_join(found, view(often, "h"), "h", weights=often, salt=place).select("h", "doc_id", "place"), "shared")
    start = F.shiftright("place", 32)
    starts = shared.groupBy("doc_id").agg(F.collect_set(start.cast("int")).alias("starts"))
    texts = spread_join(docs, starts, "doc_id", salt=F.xxhash64("text")).select("doc_id", "text", "starts")
    runs_of = shared.union(stage(texts.mapInArrow(_run_rows, RUN), "runs_to"))
    at = F.struct("doc_id", start.alias("start"))
    firsts = runs_of.groupBy("h").agg(F.min(at).alias("at"), F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")
    firsts = stage(firsts, "firsts")
    later = spread_join(runs_of, view(firsts, "h", "at"), "h", weights=firsts, salt=place).filter(at != F.col("at"))
    return later.groupBy("doc_id").agg(F.sort_array(F.collect_set("place")).alias("spans"))


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text column (the last but one) without the spans of the last column, and how many sentences went."""
    for batch in batches:
        texts, spans = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
        out, removed = [], []
        for text, gone in zip(texts, spans):
            ends = sentences(text)
            cover = np.zeros(len(ends) + 1, dtype=np.int64)
            places = np.array(gone, dtype=np.int64)
            np.add.at(cover, places >> 32, 1)
            np.add.at(cover, (places & 0xFFFFFFFF) + 1, -1)
            dead = np.cumsum(cover)[:-1] > 0
            pieces = zip([0, *ends], ends, dead.tolist())
            out.append("".join(text[a:b] for a, b, d in pieces if not d).rstrip())
            removed.append(int(dead.sum()))
        kept = [batch.column(i) for i in range(batch.num_columns - 2)]
        names = [*batch.schema.names[:-2], "__text", "__removed"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.string()), pa.array(removed, pa.int64())], names)


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's columns with the cleaned text in place, and the number of sentences that went as ``__removed``.

    Only texts that change are joined to their spans and cut; all others pass by. A null text stays null, rows without a
    key are left as they are.
    """
    spans = stage(repeated(df, key, text).select(F.col("doc_id").alias("__key"), "spans"), "spans")
    keyed = df.withColumn("__key", F.col(key).cast("long"))
    known = spans.select("__key")
    same = spread_join(keyed, known, "__key", "left_anti", salt=F.xxhash64("__key"))
    changed = spread_join(keyed.filter(F.col(text).isNotNull()), known, "__key", "left_semi", salt=F.xxhash64("__key"))
    others = [c for c in df.columns if c != text]
    rows = changed.join(spans.withColumnRenamed("spans", "__spans"), "__key").select(*others, text, "__spans")
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in others)
    cleaned = rows.mapInArrow(_cleaned, f"{kinds}, __text string, __removed long")
    cleaned = cleaned.select(*[F.col("__text").alias(text) if c == text else F.col(c) for c in df.columns], "__removed")
    return same.select(*df.columns, F.lit(0).cast("long").alias("__removed")).union(cleaned)
