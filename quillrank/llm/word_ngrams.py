"""Word bigrams: an interpolated modified Kneser-Ney model whose tables are sharded and grow with the text.

Words are lower-case runs without white space, less one mark at their end, as 64-bit hashes; every text begins with START.
Texts are written once as blocks of word numbers. All that is sent are sorted, packed arrays: each block asks the shards
once for each different word and bigram it has, and the answers come back in the order of the question, to the task that
reads the block. So neither a document's bigrams nor the blocks are ever shuffled, and nothing is gathered on the driver
but a few sums.

1. Word shards number the words that several blocks have, frequent ones first, so that keys are small and pack well. What
   a word that only one block has takes part in is known there.
2. Bigram shards add up the counts of a bigram in the trusted texts, and from them the sums of first words and the
   continuation counts of second ones.
3. Word shards add those up and answer with the sums of each word.

Rows with equal key and text count as one: their sums are divided by the number of texts.

A trusted document was counted itself. What no other trusted document holds counts as unseen in it, or its words would
look more ordinary than those of any other text. Only the number of documents that hold something is sent; where a key
stands in several rows, also the key.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.serializers import AutoBatchedSerializer, CPickleSerializer, PairDeserializer
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from quillrank.llm.common import words
from quillrank.session import stage

# Words after which a block ends, which bound what a task holds (a longer text is a block of its own).
BLOCK_WORDS = 4_000_000
# Words whose bigrams a task handles at a time.
SEGMENT_WORDS = 500_000
# Words a shard counts, on average, at most.
SHARD_WORDS = 4_000_000
# Bits of a second word's number that do not count where its bigrams are dealt to shards.
RUN = 14
MESSAGE = "kind int, to int, part int, block long, shard int, blob binary"
ANSWER, SUMS, FACTS = range(3)
_WIDE = 0xFFFF


def row_id() -> Column:
    """Names a row by its key and text: copies of a row share one, and are scored alike."""
    return F.xxhash64("doc_id", "text")


def hashed(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(text), r"[.,;:!?](?=\s|$)", "")
    return F.transform(words(plain), lambda w: F.xxhash64(w))


# Packed arrays ------------------------------------------------------------------------------------------------------


def _squeezed(raw: bytes, level: int = 3) -> bytes:
    return pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)


def _opened(raw: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(raw, decompressed_size=size, asbytes=True) if size else b""


def _planes(values: np.ndarray) -> tuple[int, int, bytes]:
    """Whole numbers of 64 bits, their lowest bytes first, without the bytes that are 0 in all of them."""
    values = np.ascontiguousarray(values).astype(np.int64, copy=False).view(np.uint64)
    width = max((int(values.max(initial=0)).bit_length() + 7) // 8, 1)
    raw = values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(values), width, _squeezed(raw) if raw else b""


def _numbers(packed: tuple[int, int, bytes]) -> np.ndarray:
    n, width, raw = packed
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(_opened(raw, n * width), np.uint8).reshape(width, n).T
    return out.reshape(-1).view(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    return pickle.dumps([_planes(a) for a in arrays], protocol=5)


def _unpack(blob: bytes) -> list[np.ndarray]:
    return [_numbers(p) for p in pickle.loads(blob)]


def _gaps(ascending: np.ndarray) -> np.ndarray:
    """Steps between ascending numbers of 64 bits without sign."""
    return np.diff(ascending.view(np.uint64), prepend=np.uint64(0)).view(np.int64)


def _sums(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(gaps.view(np.uint64), dtype=np.uint64).view(np.int64)


def _different(values: np.ndarray) -> np.ndarray:
    """Ascending and once each; sorting is several times as fast as np.unique's table."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, ascending, and which of them each one is."""
    order = np.argsort(values)
    values = values[order]
    new = np.append(True, values[1:] != values[:-1])[: len(values)]
    which = np.empty(len(values), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    return values[new], which


def _tidy(rows: Iterator) -> Iterator:
    """The same rows; afterwards the worker, which waits for its next task, gives back the memory that it has freed."""
    yield from rows
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# Blocks -------------------------------------------------------------------------------------------------------------


def _written(rid: np.ndarray, doc: np.ndarray, mark: np.ndarray, size: np.ndarray, z: pa.Array) -> bytes:
    """A block: its rows, its words in the order of their frequency, and the numbers of the words in the text."""
    found = z.dictionary_encode()
    number, known = found.indices.to_numpy(), found.dictionary.to_numpy()
    order = np.argsort(-np.bincount(number, minlength=len(known)), kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    number = rank[number]
    low = np.minimum(number, _WIDE).astype("<u2").tobytes()
    step = np.diff(number[number >= _WIDE].astype(np.int64), prepend=_WIDE)
    high = _planes((step << 1) ^ (step >> 63))
    return pickle.dumps((*(_planes(x) for x in (rid, doc, mark, size, known[order])), len(z), _squeezed(low, 9), high), protocol=5)


class _Block:
    """A block read back. ``word`` and ``first`` are the numbers of every word and, from 1, of the one before it (0 is START),
    ``owner`` is its row and ``document`` a row's number among the trusted documents, or -1."""

    def __init__(self, blob: bytes):
        *rows, n, low, high = pickle.loads(blob)
        self.rid, doc, mark, self.size, self.known = map(_numbers, rows)
        self.word = np.frombuffer(_opened(low, 2 * n), "<u2").astype(np.int32)
        step = _numbers(high)
        self.word[self.word == _WIDE] = np.cumsum((step.view(np.uint64) >> np.uint64(1)).view(np.int64) ^ -(step & 1)) + _WIDE
        self.first = np.zeros(n, np.int32)
        self.first[1:] = self.word[:-1]
        self.first += 1
        self.first[np.cumsum(self.size) - self.size] = 0
        self.owner = np.repeat(np.arange(len(self.size), dtype=np.int32), self.size)
        good = mark > 0
        # Rows that share a key are one document.
        self.docs, own = np.unique(doc[good], return_inverse=True)
        self.again = np.zeros(len(self.docs), bool)
        self.again[own] = mark[good] > 1
        self.document = np.full(len(self.size), -1, np.int32)
        self.document[good] = own

    def segments(self, most: int) -> Iterator[tuple[int, np.ndarray]]:
        """The places of the block by their first word, about ``most`` at a time: no bigram is in two of them."""
        n = -(-len(self.word) // most)
        for k in range(n):
            yield k, np.flatnonzero(self.first % n == k)

    def bigrams(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and second word of every different bigram at the places ``at``, and which of them each place has."""
        key = self.first[at].astype(np.int64)
        key *= len(self.known)
        key += self.word[at]
        some, which = _grouped(key)
        y = (some // len(self.known)).astype(np.int32)
        some %= len(self.known)
        return y, some.astype(np.int32), which

    def trusted(self, at: np.ndarray | slice, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a trusted text has the places ``at``; for those that do, which thing each is and its document."""
        own = self.document[self.owner[at]]
        counted = own >= 0
        return counted, which[counted], own[counted]

    def holders(self, which: np.ndarray, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many documents (up to 2) hold each of ``n`` things, of which the documents ``own`` have ``which``; and, of
        those that a document whose key stands in several rows holds alone, which they are and its key."""
        pairs = _different(which.astype(np.int64) * max(len(self.docs), 1) + own)
        held = np.bincount(pairs // max(len(self.docs), 1), minlength=n)
        if not self.again.any():
            return np.minimum(held, 2), np.zeros(0, np.int64), np.zeros(0, np.int64)
        sole = np.flatnonzero(held == 1)
        doc = pairs[(np.cumsum(held) - held)[sole]] % len(self.docs)
        return np.minimum(held, 2), sole[self.again[doc]], self.docs[doc[self.again[doc]]]

    def order(self, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """The words by shard and hash, and where each shard's words begin."""
        return _dealt(self.known, (self.known.view(np.uint64) % np.uint64(shards)).astype(np.int32), shards)


def _dealt(keys: np.ndarray, shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys.view(np.uint64)).astype(np.int32)
    order = order[np.argsort(shard[order], kind="stable")]
    return order, np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])


def _asked(keys: np.ndarray, order: np.ndarray, ends: np.ndarray, values: list[np.ndarray], sole: tuple) -> Iterator[tuple[int, bytes]]:
    """What each shard is asked: its keys in order, their values and the keys of documents that stand in several rows."""
    place, key = np.full(len(keys), -1), sole[1]
    place[sole[0]] = np.arange(len(sole[0]))
    for shard in range(len(ends) - 1):
        own = order[ends[shard] : ends[shard + 1]]
        if len(own):
            told = np.flatnonzero(place[own] >= 0)
            yield shard, _pack(_gaps(keys[own]), *(v[own] for v in values), told, key[place[own[told]]])


def marks(doc: pa.Array, again: pa.Array, trusted: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """0 for rows that are not trusted, 2 for those whose key stands in several rows, else 1."""
    if trusted is None:
        return np.where(again.is_null().to_numpy(zero_copy_only=False), 0, 1 + again.fill_null(False).to_numpy(zero_copy_only=False))
    ids, twice = trusted
    if not len(ids):
        return np.zeros(len(doc), np.int64)
    keys = doc.fill_null(0).to_numpy(zero_copy_only=False)
    at = np.minimum(np.searchsorted(ids, keys), len(ids) - 1)
    return np.where(doc.is_valid().to_numpy(zero_copy_only=False) & (ids[at] == keys), 1 + twice[at], 0)


def _blocks(shared, most: int) -> Callable:
    """A function from batches (rid, doc_id, again, words) to blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held, n = [], 0

        def ended() -> pa.RecordBatch:
            rid, doc, mark, size = (np.concatenate([h[i] for h in held]) for i in range(4))
            z = pa.concat_arrays([h[4] for h in held])
            held.clear()
            columns = [pa.array([block]), pa.array([n]), pa.array([_written(rid, doc, mark, size, z)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "n", "blob"])

        for batch in batches:
            rid, doc, again, listed = (batch.column(i) for i in range(4))
            z = listed.flatten()
            mark = marks(doc, again, shared.value)
            held.append((rid.to_numpy(), doc.fill_null(0).to_numpy(zero_copy_only=False), mark, np.diff(listed.offsets.to_numpy()).astype(np.int64), z))
            n += len(z)
            if n >= most:
                yield ended()
                n, block = 0, block + 1
        if held:
            yield ended()

    return run


# Shards -------------------------------------------------------------------------------------------------------------


def _message(kind: int, to: int, part: int, block: int, shard: int, blob: bytes) -> tuple:
    return kind, to, part, block, shard, blob


def _mail(rows: list[tuple]) -> pa.RecordBatch:
    names = ["kind", "to", "part", "block", "shard", "blob"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _received(batches: Iterator[pa.RecordBatch]) -> list[dict]:
    return [row for batch in batches for row in batch.to_pylist()]


def _merged(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """The different keys that the rows ask for, which of them each question is, the values, whether only one document
    holds each, and where the questions of each row end."""
    parts = [_unpack(r["blob"]) for r in rows]
    ends = np.cumsum([len(p[0]) for p in parts])
    keys, which = _grouped(np.concatenate([_sums(p[0]) for p in parts]))
    values = [np.concatenate([p[i] for p in parts]) for i in range(1, len(parts[0]) - 2)]
    holders = np.bincount(which, weights=values[-1], minlength=len(keys))
    sole = holders == 1
    told = np.concatenate([p[-2] + end - len(p[0]) for p, end in zip(parts, ends)])
    if len(told):
        thing, key = which[told], np.concatenate([p[-1] for p in parts])
        least, most = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(least, thing, key)
        np.maximum.at(most, thing, key)
        sole |= (np.bincount(thing, minlength=len(keys)) == holders) & (least == most)
    return keys, which, values, sole, ends


def _numbered(shards: int) -> Callable:
    """Word shards: a number from 1 for every word that several blocks have, and whether only one document holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _received(batches)
        if not rows:
            return
        shard = rows[0]["to"]
        keys, which, (count, held), sole, ends = _merged(rows)
        many = np.flatnonzero((np.bincount(which) > 1) & (np.bincount(which, weights=held) > 0))
        many = many[np.argsort(-np.bincount(which, weights=count)[many], kind="stable")]
        number = np.zeros(len(keys), np.int64)
        number[many] = 1 + np.arange(len(many)) * shards + shard
        told = np.split((number * 2 + sole)[which], ends[:-1])
        for row, own in zip(rows, told):
            yield _mail([_message(ANSWER, row["part"], row["part"], row["block"], shard, _pack(own))])

    return run


def _summed(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    some, which = _grouped(key)
    return [some, *(np.bincount(which, weights=v, minlength=len(some)).astype(np.int64) for v in values)]


def _by_first(y: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Sums of first words: their tokens, and their bigrams that occur once, twice and more often."""
    return _summed(y, n, n == 1, n == 2, n > 2)


def _few(n: np.ndarray) -> np.ndarray:
    """How many of the counts ``n`` are 1, 2, 3 and 4, how many there are and what they add up to."""
    return np.concatenate([np.bincount(np.minimum(n, 5), minlength=6)[1:5], [np.count_nonzero(n), n.sum()]]).astype(np.int64)


def _counted(shards: int) -> Callable:
    """Bigram shards: the count of every bigram and whether only one document holds it; and the sums of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _received(batches)
        if not rows:
            return
        shard = rows[0]["to"]
        asked = [r for r in rows if r["kind"] == ANSWER]
        # What blocks have counted themselves.
        firsts, seconds, facts = [], [], [np.zeros(12, np.int64)]
        for r in rows:
            if r["kind"] == SUMS:
                *first, z, c, fact = _unpack(r["blob"])
                firsts.append(first)
                seconds.append([z, c])
                facts.append(fact)
        if asked:
            keys, which, (count, _), sole, ends = _merged(asked)
            total = np.bincount(which, weights=count).astype(np.int64)
            told = np.split((total * 2 + sole)[which], ends[:-1])
            for row, own in zip(asked, told):
                yield _mail([_message(ANSWER, row["part"], row["part"], row["block"], row["shard"], _pack(own))])
            seen, total = keys[total > 0], total[total > 0]
            firsts.append(_by_first(seen >> 32, total))
            seconds.append(_summed(seen & 0xFFFFFFFF, np.ones(len(seen))))
            facts.append(np.concatenate([_few(total), np.zeros(6, np.int64)]))
        first = _summed(*(np.concatenate([f[i] for f in firsts]) for i in range(5)))
        second = _summed(*(np.concatenate([s[i] for s in seconds]) for i in range(2)))
        start = np.array([x[0] if len(first[0]) and first[0][0] == 0 else 0 for x in first[1:]], np.int64)
        yield _mail([_message(FACTS, 0, 0, 0, shard, _pack(np.sum(facts, axis=0), start))])
        home, away = (first[0] - 1) % shards, (second[0] - 1) % shards
        for to in range(shards):
            a, b = (home == to) & (first[0] > 0), away == to
            if a.any() or b.any():
                yield _mail([_message(SUMS, to, 0, 0, shard, _pack(_gaps(first[0][a]), *(x[a] for x in first[1:]), _gaps(second[0][b]), second[1][b]))])

    return run


def _totals(shards: int) -> Callable:
    """Word shards: the sums of every word, for the blocks that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _received(batches)
        asked = [(r, _unpack(r["blob"])[0] >> 1) for r in rows if r["kind"] == ANSWER]
        if not asked:
            return
        size = max(int(codes.max()) for _, codes in asked) // shards + 2
        sums = np.zeros((5, size), np.int64)
        for r in rows:
            if r["kind"] == SUMS:
                y, *first, z, c = _unpack(r["blob"])
                at = (_sums(y) - 1) // shards
                for k in range(4):
                    sums[k, at] += first[k]
                sums[4, (_sums(z) - 1) // shards] += c
        for r, codes in asked:
            yield _mail([_message(SUMS, r["part"], r["part"], r["block"], r["to"], _pack(*sums[:, (codes[codes > 0] - 1) // shards]))])
        yield _mail([_message(FACTS, 0, 0, 0, 0, _pack(_few(sums[4])))])

    return run


# Rounds -------------------------------------------------------------------------------------------------------------


def _codes(block: _Block, rows: list, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the block's words (0: no other block has it), and whether only one document holds each."""
    order, ends = block.order(shards)
    told = np.zeros(len(block.known), np.int64)
    for r in rows:
        told[order[ends[r["shard"]] : ends[r["shard"] + 1]]] = _unpack(r["blob"])[0]
    return told >> 1, (told & 1).astype(bool)


def _shared(y: np.ndarray, z: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether both words of a bigram have numbers."""
    known = code > 0
    return np.append(True, known)[y] & known[z]


def _bigram_keys(y: np.ndarray, z: np.ndarray, code: np.ndarray, shards: int) -> tuple:
    """The bigrams of words that have numbers, their keys, and the order in which the shards are asked for them."""
    both = np.flatnonzero(_shared(y, z, code)).astype(np.int32)
    key = np.append(0, code)[y[both]]
    key <<= 32
    key |= code[z[both]]
    # Runs of second words lie in one shard, which keeps the steps between keys small; a run has at most 1 << RUN of them.
    mixed = key.view(np.uint64) >> np.uint64(RUN)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed >>= np.uint64(33)
    mixed %= np.uint64(shards)
    return both, key, *_dealt(key, mixed.astype(np.int32), shards)


def _ask_words(index: int, rows: Iterator, shards: int) -> Iterator[tuple]:
    for row in rows:
        block = _Block(row["blob"])
        count = np.bincount(block.word, minlength=len(block.known))
        held, *sole = block.holders(*block.trusted(slice(None), block.word)[1:], len(block.known))
        for shard, blob in _asked(block.known, *block.order(shards), [count, held], sole):
            yield _message(ANSWER, shard, index, row["block"], shard, blob)


def _ask_bigrams(index: int, pairs: Iterator, shards: int, segment: int) -> Iterator[tuple]:
    for row, (codes,) in _with(pairs, 1):
        block = _Block(row["blob"])
        code, _ = _codes(block, codes, shards)
        named = np.append(0, np.where(code > 0, code, -1))
        firsts, follow, few = [], np.zeros(len(code), np.int64), np.zeros(6, np.int64)
        for k, at in block.segments(segment):
            y, z, which = block.bigrams(at)
            _, which, own = block.trusted(at, which)
            count = np.bincount(which, minlength=len(y))
            held, *sole = block.holders(which, own, len(y))
            both, key, order, ends = _bigram_keys(y, z, code, shards)
            place = np.full(len(y), -1, np.int32)
            place[both] = np.arange(len(both))
            told = place[sole[0]] >= 0
            for shard, blob in _asked(key, order, ends, [count[both], held[both]], (place[sole[0][told]], sole[1][told])):
                yield _message(ANSWER, shard, index, row["block"], k * shards + shard, blob)
            here = np.flatnonzero((place < 0) & (count > 0))
            n, first = count[here], named[y[here]]
            firsts.append(_by_first(first[first >= 0], n[first >= 0]))
            follow += np.bincount(z[here], minlength=len(code))
            few += _few(n)
        away = np.flatnonzero((follow > 0) & (code > 0))
        facts = np.concatenate([few, _few(follow[code == 0])])
        sums = [*(np.concatenate([f[i] for f in firsts]) for i in range(5)), code[away], follow[away], facts]
        yield _message(SUMS, row["block"] % shards, index, row["block"], 0, _pack(*sums))


def _with(pairs: Iterator, kinds: int) -> Iterator[tuple]:
    """Every block of a task with the answers to it, a list for each kind of message."""
    for rows, answers in pairs:
        rows, answers = ([r for batch in side for r in pickle.loads(batch)] for side in (rows, answers))
        by_block: dict[int, list[list]] = {}
        for a in answers:
            by_block.setdefault(a["block"], [[] for _ in range(kinds)])[a["kind"]].append(a)
        for row in rows:
            yield row, by_block.get(row["block"], [[] for _ in range(kinds)])


def _steps(n: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(n, 3)]


def _score(pairs: Iterator, shards: int, segment: int, second: list[float], first: list[float], start: np.ndarray, bigrams: int, rest: float, uniform: float) -> Iterator[tuple]:
    """(rid, n_words, word_nll, word_saved) of every row, from the discounts of both orders, the sums of START, the number
    of different bigrams, and the weight and the probability of a word that was never seen."""
    for row, (codes, counts, sums) in _with(pairs, 3):
        block = _Block(row["blob"])
        code, sole_word = _codes(block, codes, shards)
        # Words with a number get their sums, the others have them here.
        at = np.flatnonzero(~_shared(block.first, block.word, code))
        y, z, which = block.bigrams(at)
        n = np.bincount(block.trusted(at, which)[1], minlength=len(y))
        total, *some = (np.bincount(y, weights=x, minlength=len(code) + 1) for x in (n, n == 1, n == 2, n > 2))
        follow = np.bincount(z, weights=n > 0, minlength=len(code))
        words_order, words_ends = block.order(shards)
        for r in sums:
            own = words_order[words_ends[r["shard"]] : words_ends[r["shard"] + 1]]
            own = own[code[own] > 0]
            *of, follow[own] = _unpack(r["blob"])
            for x, value in zip((total, *some), of):
                x[own + 1] = value
        for x, value in zip((total, *some), start):
            x[0] = value
        mass = sum(d * x for d, x in zip(second, some))
        weight = np.divide(mass, total, out=np.ones(len(total)), where=total > 0)
        unseen = uniform * rest
        p1 = np.where(follow > 0, (follow - _steps(follow.astype(np.int64), first)) / max(bigrams, 1) + unseen, unseen)
        size = len(block.size)
        nll, saved = np.zeros(size), np.zeros(size)
        for k, at in block.segments(segment):
            if not len(at):
                continue
            y, z, which = block.bigrams(at)
            counted, of, own = block.trusted(at, which)
            n = np.bincount(of, minlength=len(y))
            sole = block.holders(of, own, len(y))[0] == 1
            both, _, order, ends = _bigram_keys(y, z, code, shards)
            for of, shard, blob in ((*divmod(r["shard"], shards), r["blob"]) for r in counts):
                if of == k:
                    told, own = _unpack(blob)[0], both[order[ends[shard] : ends[shard + 1]]]
                    n[own], sole[own] = told >> 1, (told & 1).astype(bool)
            lower, least = weight[y] * p1[z], weight[y] * unseen
            p = n - _steps(n, second)
            p /= np.maximum(total, 1)[y]
            p += lower
            log = np.log(p)[which]
            alone = np.flatnonzero(counted & sole[which])
            log[alone] = np.log(lower[which[alone]])
            alone = np.flatnonzero(counted & sole_word[block.word[at]])
            log[alone] = np.log(least[which[alone]])
            owner = block.owner[at]
            nll -= np.bincount(owner, weights=log, minlength=size)
            own = np.sort(owner.astype(np.int64) * len(y) + which)
            ends = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            times = np.diff(np.append(ends, len(own)))
            saved += np.bincount(own[ends] // len(y), weights=times * np.log(times), minlength=size)
        yield from zip(block.rid.tolist(), block.size.tolist(), (nll + 0.0).tolist(), saved.tolist())


def _deal(messages: DataFrame, shards: int, function: Callable) -> DataFrame:
    return messages.repartitionById(shards, F.col("to")).mapInArrow(lambda batches: _tidy(function(batches)), MESSAGE)


def _meet(blocks: RDD, parts: int, answers: DataFrame) -> RDD:
    """The blocks of every task beside the answers to them, both in pickled batches; only the answers are shuffled."""
    sent = answers.select("to", "kind", "block", "shard", "blob").repartitionById(parts, F.col("to")).rdd

    def whole(rows: RDD):
        # A partition as one value. RDD.zip would do that in a Python process of its own for each side.
        return rows.ctx._jvm.SerDeUtil.javaToPython(rows._jrdd.glom())

    batches = AutoBatchedSerializer(CPickleSerializer())
    return RDD(whole(blocks).zip(whole(sent)), blocks.ctx, PairDeserializer(batches, batches))


def scored(docs: DataFrame, trusted, discounts: Callable, block: int = BLOCK_WORDS, segment: int = SEGMENT_WORDS) -> DataFrame:
    """(rid, n_words, word_nll, word_saved) of every row of ``docs`` (doc_id, again, text) that has words.

    word_saved is the sum of c * log(c) over its bigrams: what a model would save that knew the text's own counts.
    ``trusted`` is what ``marks`` needs, broadcast. ``discounts`` are those of counts, from the numbers of 1 to 4 in them.
    """
    spark = docs.sparkSession
    fill = _blocks(trusted, block)
    found = docs.select(row_id().alias("rid"), "doc_id", "again", hashed(F.col("text")).alias("words")).filter(F.size("words") > 0)
    coded = stage(found.mapInArrow(lambda batches: _tidy(fill(batches)), "block long, n long, blob binary"), "word_blocks")
    n = coded.agg(F.sum("n")).first()[0]
    scores = "rid long, n_words long, word_nll double, word_saved double"
    if not n:
        return spark.createDataFrame([], scores)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SHARD_WORDS))
    # Both rounds and the scores read these very partitions.
    blocks = coded.select("block", "blob").rdd
    parts = blocks.getNumPartitions()

    def mail(rows: RDD) -> DataFrame:
        return spark.createDataFrame(rows, StructType.fromDDL(MESSAGE), verifySchema=False)

    asked = mail(blocks.mapPartitionsWithIndex(lambda i, rows: _tidy(_ask_words(i, rows, shards))))
    codes = stage(_deal(asked, shards, _numbered(shards)), "word_codes")
    asked = mail(_meet(blocks, parts, codes).mapPartitionsWithIndex(lambda i, pairs: _tidy(_ask_bigrams(i, pairs, shards, segment))))
    counts = stage(_deal(asked, shards, _counted(shards)), "word_bigrams")
    words_of = codes.withColumn("to", F.col("shard"))
    sums = counts.filter(F.col("kind") == SUMS).unionByName(words_of)
    totals = stage(_deal(sums, shards, _totals(shards)), "word_sums")

    def facts(table: DataFrame) -> list[list[np.ndarray]]:
        return [_unpack(r["blob"]) for r in table.filter(F.col("kind") == FACTS).select("blob").toLocalIterator()]

    told = facts(counts)
    both, start = (np.sum([t[i] for t in told], axis=0) for i in range(2))
    few, below = both[:6], both[6:] + np.sum([t[0] for t in facts(totals)], axis=0)
    second, first = discounts(few[:4]), discounts(below[:4])
    uniform = 1.0 / (int(below[4]) + 1)
    mass = first[0] * below[0] + first[1] * below[1] + first[2] * (below[4] - below[0] - below[1])
    rest = float(mass / below[5]) if below[5] else 1.0
    told = codes.withColumn("kind", F.lit(0)).unionByName(counts.filter(F.col("kind") == ANSWER).withColumn("kind", F.lit(1)))
    told = told.unionByName(totals.filter(F.col("kind") == SUMS).withColumn("kind", F.lit(2)))
    at = (second, first, start, int(below[5]), rest, uniform)
    rows = _meet(blocks, parts, told).mapPartitions(lambda pairs: _tidy(_score(pairs, shards, segment, *at)))
    rows = spark.createDataFrame(rows, StructType.fromDDL(scores), verifySchema=False)
    names = ("word_nll", "word_saved")
    means = rows.groupBy("rid").agg(F.count(F.lit(1)).alias("texts"), *[F.sum(x).alias(x) for x in ("n_words", *names)])
    return means.select("rid", F.expr("n_words div texts").alias("n_words"), *[(F.col(x) / F.col("texts")).alias(x) for x in names])
