import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillrank import session
from quillrank.llm import huffman, packing
from quillrank.llm.tokens import Encoder

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ALPHABET = list("ab Z'sé\n\t  1²ª.,!<|'re İıſŸ\x85\xa0\x1c\x0b\0") + [" the", "'ll", "  ", "\n ", " \n", "<|endoftext|>", "日本", "é", "Σας"]


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_encoder_equals_library(name):
    rnd = random.Random(1)
    mine, theirs = Encoder(public_tokenizers.path(name)), library(name)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))) for _ in range(8000)]
    for text in texts + ["", " ", "word " * 3000, "x" * 3000]:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == theirs(text), repr(text)


def test_code_lengths():
    rnd = random.Random(2)
    for n in (1, 2, 3, 7, 100, 3000):
        counts = np.array([rnd.randint(1, 10 ** rnd.randint(0, 6)) for _ in range(n)])
        lengths = huffman.code_lengths(counts, 14)
        assert lengths.max() <= 14 and sum(0.5**x for x in lengths.tolist()) <= 1 + 1e-12
        # Without a tight limit the cost is that of Huffman's merging.
        heap, cost = sorted(counts.tolist()), 0
        while len(heap) > 1:
            a, b, *heap = heap
            cost += a + b
            heap = sorted([*heap, a + b])
            if n > 100:
                break
        if 1 < n <= 100:
            assert (huffman.code_lengths(counts, 40) * counts).sum() == cost


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for n, vocabulary in ((1, 1), (5, 2), (63, 3), (64, 3), (65, 3), (30000, 9000)):
        ids = (rng.zipf(1.3, n) % vocabulary).astype("<u4") + 7
        seen, counts = np.unique(ids, return_counts=True)
        code = huffman.Code(seen, huffman.code_lengths(counts))
        bits, checkpoints = huffman.encode(ids, *code.writer())
        assert (huffman.decode(bits, checkpoints, n, code.reader()) == ids).all()


def test_huffman_files(docs, spark):
    rows = [(9, "b c"), (3, None), (5, ""), (4, "long " * 60000), (None, "x"), (7, "same"), (7, "same"), (8, "日本 <|endoftext|>")]
    path = session.run_dir(spark, "test")
    huffman.write(huffman.tokenized(docs(rows, extra=True), public_tokenizers.path(FILES[0])), path)
    got = huffman.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c")).collect()
    encode, start, want = library(FILES[0]), 0, []
    for i, t in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0])):
        ids = np.array([*encode(t or ""), 2], dtype="<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    empty = session.run_dir(spark, "test")
    huffman.write(huffman.tokenized(docs([]), public_tokenizers.path(FILES[0])), empty)
    assert huffman.read(spark, empty).count() == 0


def place_all(counts, capacity):
    """Every piece's (sequence, offset, length) under the plan."""
    out = []
    for size, first, number, copies, sequence, offset in packing.plan(counts, capacity).tolist():
        out += [(sequence + k // copies, offset + k % copies * size, size, first + k) for k in range(number)]
    return out


def test_plan_is_gapless_and_tight():
    rnd = random.Random(4)
    for trial in range(60):
        capacity = rnd.choice([10, 64, 300])
        counts = Counter(rnd.randint(1, capacity) if trial % 2 else min(capacity, int(rnd.expovariate(5 / capacity)) + 1) for _ in range(rnd.randint(0, 400)))
        placed = place_all(counts, capacity)
        assert Counter(p[2] for p in placed) == counts
        assert all(sorted(p[3] for p in placed if p[2] == s) == list(range(n)) for s, n in counts.items())
        bins = {}
        for p in sorted(placed):
            assert p[1] == bins.get(p[0], 0)
            bins[p[0]] = p[1] + p[2]
        assert all(end <= capacity for end in bins.values())
        total = sum(s * n for s, n in counts.items())
        large = sum(n for s, n in counts.items() if 2 * s > capacity)
        least = max(-(-total // capacity), large)
        assert len(bins) <= least * 11 / 9 + 1


def test_packing(docs):
    rows = [(1, None), (2, ""), (3, "hello world"), (4, "word " * 5000), (5, "one two " * 300), (5, "one two " * 300), (6, "z")]
    encode = library(FILES[1])
    table = packing.pieces(docs(rows, extra=True), public_tokenizers.path(FILES[1]))
    placed = packing.digest(packing.best_fit(table)).toPandas()
    for i, t in rows:
        ids = [*encode(t or ""), 0]
        mine = placed[placed.doc_id == i].drop_duplicates("piece").sort_values("piece")
        assert mine.start.tolist() == [0, *mine.length.cumsum().tolist()[:-1]] and mine.length.sum() == len(ids)
        assert mine.length.max() <= 2048 and all(mine.length[1:] == 2048)
        for r in mine.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes())
    assert len(placed) == len(table.toPandas()) and not placed.duplicated(["sequence_id", "offset"]).any()
    whole = packing.sequences(table, packing.best_fit(table)).toPandas()
    by = placed.groupby("sequence_id").length.sum()
    assert {r.sequence_id: len(r.ids) // 4 for r in whole.itertuples()} == by.to_dict() and by.max() <= 2048
    assert packing.best_fit(packing.pieces(docs([]), public_tokenizers.path(FILES[1]))).count() == 0
