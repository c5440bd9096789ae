"""Byte-level BPE by a pair occurrence index: token ids of whole texts, and texts of token ids.

A task handles its partition in blocks of about BLOCK characters. All words of a block that it has not met yet are laid
end to end as one list of byte symbols, and every pair of neighbours is entered in an index from pair to positions. The
ranks of the pairs present are active; they are taken in ascending order, each is applied at all its positions from left
to right, and the new pairs to both sides of every merge are added to the lists of those pairs. Positions that an
earlier merge has changed are recognised when they are met. Every symbol of a supported vocabulary is made by one merge,
out of symbols of earlier merges, so no merge brings a lower rank back, and this order equals that of the library, which
merges word by word. A worker remembers up to CACHE short words from block to block.

Words come from the tokenizer's pattern; texts with characters that Unicode versions or libraries class differently are
cut by the library's own pre-tokenizer. Special strings in a text become their special ids, which is what the library
does unless told otherwise. Truncation and padding are not applied. ``decode`` joins the bytes of the ids; bytes that are
no UTF-8 become U+FFFD.

Defined cases: a null text is empty and has no ids; null ids give a null text; null ids inside a list are skipped;
repeated rows and keys are encoded each; an empty table gives an empty result; all other columns are ignored by
``encode`` and kept by ``decode``. Memory grows with the longest single text only.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Tokenizer

from quillrank.llm.common import documents

BLOCK = 8_000_000
CACHE = 500_000
# Fixed value: the split pattern of byte-level BPE, with the letters and numbers below U+0180 written out.
_WORD = re.compile(
    r" ?[A-Za-zªµºÀ-ÖØ-öø-ſ]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9²³¹¼½¾]+| ?[^\sA-Za-zªµºÀ-ÖØ-öø-ſ0-9²³¹¼½¾]+|\s+(?!\S)|\s+"
)
# Characters beyond the stable Latin blocks, and separators that only one of the libraries counts as white space.
_UNSURE = re.compile(r"[^\x00-ſ]|[\x1c-\x1f\x85]")
_NONE = -1


class Codes(dict):
    """Numbers for words, in the order in which they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


def byte_letters() -> list[str]:
    """How vocabularies write the 256 bytes: printable ones as themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """A tokenizer file's merges by rank, and its tokens as bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        cutter = spec["pre_tokenizer"] or {}
        usual = model["type"] == "BPE" and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True)
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if not usual or cutter.get("add_prefix_space") or spec["normalizer"] or any(model.get(k) for k in odd):
            raise ValueError("only plain byte-level BPE files are supported")
        ids = model["vocab"]
        self.first = np.array([ids[c] for c in letters], np.int32)
        self.size = 1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])])
        self.merges: list[tuple[int, int, int]] = []
        known = set(self.first.tolist())
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = ids[a], ids[b], ids[a + b]
            if x not in known or y not in known or z in known:
                raise ValueError(f"merge {k} is not in the order in which its symbols are made")
            known.add(z)
            self.merges.append((x, y, z))
        keys = np.array([x * self.size + y for x, y, _ in self.merges], np.int64)
        self.pair_rank = np.argsort(keys)
        self.pairs = keys[self.pair_rank]
        byte = {c: bytes([b]) for b, c in enumerate(letters)}
        self.bytes = [b""] * self.size
        for token, at in ids.items():
            self.bytes[at] = b"".join(byte[c] for c in token)
        self.special: dict[str, int] = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or len(_WORD.findall(t["content"])) < 2:
                raise ValueError(f"special token {t['content']!r} is of a kind that is not supported")
            self.special[t["content"]] = t["id"]
            self.bytes[t["id"]] = t["content"].encode()
        longest_first = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(longest_first)})") if longest_first else None
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.forget()

    def words(self, text: str) -> list[str]:
        """Words of a text; special strings stand among them as they are."""
        if self.cut is not None and any(s in text for s in self.special):
            parts = self.cut.split(text)
            return list(chain.from_iterable([p] if p in self.special else self.words(p) for p in parts if p))
        if text.isascii():
            sure = text.isprintable() or not _UNSURE.search(text)
        else:
            sure = not _UNSURE.search(text)
        if sure:
            return _WORD.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, or -1."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.pair_rank[at], -1)

    def merge(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words one after the other, and their number in each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        total = int(sizes.sum())
        # The place after the last symbol stands for "no neighbour".
        symbol = np.append(self.first[np.frombuffer(b"".join(words), np.uint8)], np.int32(_NONE))
        after, before = np.arange(1, total + 2), np.arange(-1, total)
        ends = np.cumsum(sizes[sizes > 0])
        after[ends - 1] = total
        before[np.append(0, ends)] = total
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(ranks: np.ndarray, places: np.ndarray) -> None:
            some = ranks >= 0
            ranks, places = ranks[some], places[some]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            starts = np.flatnonzero(np.diff(ranks, prepend=-1)).tolist()
            for a, e in zip(starts, [*starts[1:], len(ranks)]):
                rank = int(ranks[a])
                if rank in index:
                    index[rank].append(places[a:e])
                else:
                    index[rank] = [places[a:e]]
                    heapq.heappush(active, rank)

        enter(self.ranks(symbol[:-1], symbol[after[:-1]]), np.arange(total))
        while active:
            rank = heapq.heappop(active)
            a, b, z = self.merges[rank]
            p = np.concatenate(index.pop(rank))
            p.sort()
            p = p[np.append(True, p[1:] != p[:-1])]
            q = after[p]
            there = (symbol[p] == a) & (symbol[q] == b)
            p, q = p[there], q[there]
            if a == b and len(p) > 1:
                # In a run of equal symbols the first and the second belong together, the third and the fourth, ...
                place = np.arange(len(p))
                fresh = np.append(True, q[:-1] != p[1:])
                first = (place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0
                p, q = p[first], q[first]
            symbol[p], symbol[q] = z, _NONE
            n = after[q]
            after[p] = n
            before[n] = p
            m = before[p]
            made = np.full(len(p), z, np.int32)
            enter(np.append(self.ranks(symbol[m], made), self.ranks(made, symbol[n])), np.append(m, p))
        left = symbol[:-1] != _NONE
        word = np.repeat(np.arange(len(words)), sizes)[left]
        return symbol[:-1][left], np.bincount(word, minlength=len(words))

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the texts of a block one after the other, and their number in each text."""
        if len(self.codes) > CACHE:
            self.forget()
        code = self.codes.__getitem__
        cut = [np.fromiter(map(code, self.words(t)), np.int32) for t in texts]
        new = list(islice(self.codes, len(self.sizes), None))
        ids, sizes = self.merge([w.encode() for w in new])
        self.ids, self.sizes = np.append(self.ids, ids), np.append(self.sizes, sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        words = np.concatenate([np.empty(0, np.int32), *cut])
        taken = self.sizes[words]
        ends = np.cumsum(taken)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[words] - ends + taken, taken)
        before = np.append(0, ends)
        last = before[np.cumsum([len(c) for c in cut], dtype=np.int64)]
        return self.ids[place], np.diff(last, prepend=0)

    def forget(self) -> None:
        """Start with the special tokens alone."""
        self.codes = Codes({s: k for k, s in enumerate(self.special)})
        self.ids, self.sizes = np.array([*self.special.values()], np.int32), np.ones(len(self.special), np.int64)

    def text(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)

        def done(keys: list[pa.Array], texts: list[str]) -> pa.RecordBatch:
            ids, sizes = known.encode(texts)
            bounds = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            return pa.RecordBatch.from_arrays([pa.concat_arrays(keys), pa.ListArray.from_arrays(bounds, pa.array(ids))], ["doc_id", "ids"])

        keys, texts, size = [], [], 0
        for batch in batches:
            keys.append(batch.column(0))
            texts += (more := batch.column(1).to_pylist())
            size += sum(map(len, more))
            if size >= BLOCK:
                yield done(keys, texts)
                keys, texts, size = [], [], 0
        if keys:
            yield done(keys, texts)

    return documents(df, key, text).mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids`` in the column ``text``."""

    @F.pandas_udf("string")
    def texts(column):
        known = vocabulary(path)
        return column.map(lambda x: None if x is None else known.text(x))

    return df.withColumn(text, texts(F.filter(ids, lambda x: x.isNotNull())))


def digest(df: DataFrame) -> DataFrame:
    """Counts and digests of encoded and decoded rows."""

    def sha(value: Column) -> Column:
        return F.sha2(value, 256)

    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return df.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), sha(listed).alias("ids_sha256"), sha(F.col("decoded")).alias("decoded_sha256"))
