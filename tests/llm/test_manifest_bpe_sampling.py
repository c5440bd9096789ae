"""Merkle manifest, BPE by pair index and importance resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillrank.llm import bpe, merkle, resampling

FILE = public_tokenizers.path("byte_bpe_50k.json")
KINDS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(leaves):
    """The root of leaves, and each leaf's siblings as (left, right) texts."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for path, k in zip(paths, at):
            run = k // 8 * 8
            path.append(("".join(level[run:k]), "".join(level[k + 1 : run + 8])))
        at = [k // 8 for k in at]
        level = [h(*level[k : k + 8]) for k in range(0, len(level), 8)]
    return level[0], paths


def plain_manifest(rows):
    key = lambda v: (v is not None, v if v is not None else 0)
    groups = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for g in groups:
        mine = sorted([r for r in rows if r[2] == g], key=lambda r: (key(r[0]), leaf_of(r)))
        trees[g] = (mine, *plain_tree([leaf_of(r) for r in mine]))
    root, upper = plain_tree([trees[g][1] for g in groups])
    out = []
    for g, above in zip(groups, upper):
        mine, subroot, paths = trees[g]
        for row, path in zip(mine, paths):
            links, low = path + above, row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                low = (*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), row[4]))
            folded = leaf_of(low)
            for left, right in links:
                folded = h(left, folded, right)
            out.append((row[0], leaf_of(row), subroot, root, h(*[x for pair in links for x in pair]), folded, folded == root))
    return sorted(out, key=repr)


def test_manifest(spark, rows):
    rnd = random.Random(5)
    words = ["Alpha", "beta", "ÉTÉ", "", "日本"]
    made = [(k, rnd.choice(["s", "T", None]), rnd.choice(["en"] * 30 + ["de", "é", None]), rnd.choice([k, None]), " ".join(rnd.choices(words, k=5)) if k % 9 else None) for k in range(700)]
    made += [(None, "s", "en", 1, "No key")] * 2 + [(33, "s", "en", 1, "Same Row")] * 3 + [(9999, "x", "only", 0, "LONG " * 50000), (10**12, None, "", None, "")]
    df = spark.createDataFrame(made, KINDS)
    for name in ("hash", "place", "g", "of", "key", "s0", "links", "leaf", "group", "tie"):
        df = df.withColumn(name, F.lit("x"))
    got = merkle.verify(merkle.manifest(merkle.tampered(df.repartition(5))))
    want = plain_manifest(made)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert {w[-1] for w in want} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 8, 9, 65])
def test_manifest_of_few(spark, n):
    made = [(k, "s", "en", 1, f"Text {k}") for k in range(n)]
    got = merkle.verify(merkle.manifest(merkle.tampered(spark.createDataFrame(made, KINDS))))
    assert sorted(map(tuple, got.collect()), key=repr) == (plain_manifest(made) if made else [])


ALPHABET = list("ab Z'sé\n\t  1²ª.,!<|'re İıſŸ\x85\xa0\x1c\x0b\0") + [" the", "'ll", "  ", "\n ", "<|endoftext|>", "日本", "é", "Σας", "aaa", "👍🏽"]


def test_bpe_equals_library():
    rnd = random.Random(1)
    known, library = bpe.Vocabulary(FILE), Tokenizer.from_file(FILE)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))) for _ in range(6000)]
    texts += ["".join(rnd.choice("aab") for _ in range(rnd.randint(1, 40))) for _ in range(2000)]
    texts += ["", "x" * 3000, "ab" * 2000, "word " * 3000, " " * 500, "<|endoftext|>" * 3, ""]
    for part in (texts, texts[:50], []):
        ids, sizes = known.encode(part)
        assert len(sizes) == len(part) and sizes.sum() == len(ids)
        for text, mine in zip(part, np.split(ids, np.cumsum(sizes)[:-1])):
            theirs = library.encode(text, add_special_tokens=False).ids
            assert mine.tolist() == theirs, repr(text)
            assert known.text(mine) == library.decode(theirs, skip_special_tokens=False) == text
    # Ids in any order: bytes that are no UTF-8 are replaced as the library does.
    for _ in range(2000):
        ids = [rnd.randrange(50257) if rnd.random() < 0.5 else rnd.randrange(256) for _ in range(rnd.randint(0, 8))]
        assert known.text(np.array(ids, np.int32)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_forgets(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    known, library = bpe.Vocabulary(FILE), Tokenizer.from_file(FILE)
    for text in ["one two three four five", "six seven <|endoftext|> eight", "one two three"]:
        assert known.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_rejects_other_files():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_frames(docs, spark):
    made = [(1, None), (2, ""), (3, "Hello  wörld\n"), (4, "long word " * 60000), (None, "x"), (5, "same"), (5, "same"), (6, "日本 <|endoftext|>")]
    library = Tokenizer.from_file(FILE)
    encoded = bpe.encode(docs(made, extra=True).repartition(3), FILE)
    got = bpe.digest(bpe.decode(encoded, FILE)).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, t in made:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(docs([]), FILE), FILE).count() == 0
    odd = spark.createDataFrame([(None,), ([],), ([None, 64],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, FILE).collect()] == [None, "", "a"]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain_resampling(made, target):
    feats = [plain_features(t) for _, t in made]
    s, t = Counter(b for _, f in feats for b in f), Counter(b for x in target for b in plain_features(x)[1])
    S, T = s.total(), t.total()
    rows = []
    for (i, _), (n, f) in zip(made, feats):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in f)
        x = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((x + 0.5) / 4294967296))), None, n])
    able = sorted([r for r in rows if r[5] >= 20], key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = k + 1
    return sorted([tuple(r[:5]) for r in rows], key=repr)


def sampling_case():
    rnd = random.Random(3)
    words = ["the"] * 40 + ["Frequent", "übel", "日本語", "x1"] * 6 + ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    words += ["w" * k for k in (60, 62, 63, 64, 65, 200)]
    made = [(k, rnd.choice([" ", "_", "\n. "]).join(rnd.choices(words, k=rnd.randint(0, 60)))) for k in range(400)]
    made += [(None, "no key " * 12), (401, None), (402, ""), (403, "..."), (404, "one"), (405, "Two words"), (406, "a b c")]
    made += [(407, "same text again " * 9)] * 5 + [(408, "long the text " * 40000)]
    return made, [" ".join(rnd.choices(words, k=30)) for _ in range(12)]


@pytest.mark.parametrize("frequent, tail", [(16_384, 300_000), (20, 50), (0, 0)])
def test_resampling(docs, spark, monkeypatch, frequent, tail):
    monkeypatch.setattr(resampling, "FREQUENT", frequent)
    monkeypatch.setattr(resampling, "TAIL", tail)
    made, target = sampling_case()
    wanted = spark.createDataFrame([(k, x) for k, x in enumerate(target)] + [(99, None)], "item_id long, text string")
    weights = resampling.weigh(docs(made, extra=True).repartition(4), wanted)
    got = sorted(map(tuple, resampling.digest(resampling.resample(weights)).collect()), key=repr)
    want = plain_resampling(made, target)
    # Equal rows share the ranks between them.
    assert got == want and sum(r[4] is not None for r in want) > 10


def test_states_follow_any_word():
    known = resampling.Head([b"the", b"of", b"w" * 64], [(0, 1), (2, 0)])
    known.coded([b" ".join([b"x" * 63, b"y" * 64, b"z" * 500, b"q"])])
    for a in range(7):
        for b in range(7):
            state = known.follow(known.state[[a]], np.array([b]))
            assert state[0] == zlib.crc32(known.listed[a] + b" " + known.listed[b])


def test_resampling_of_nothing(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(resampling.weigh(docs([]), none)).count() == 0
    one = resampling.digest(resampling.resample(resampling.weigh(docs([(1, "word " * 30)]), none))).collect()
    assert one[0].n_features == 87 and one[0]["rank"] is None
