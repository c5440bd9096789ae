import random
import re
import zlib

import numpy as np

from quillrank.llm import minhash, spans
from quillrank.llm.components import connected


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_copies(seed, bases=6, copies=25):
    """Texts changed so little or so much that links run through the base text and through chains."""
    rnd = random.Random(seed)
    rows = []
    for b in range(bases):
        base = [f"v{rnd.randint(0, 4000)}" for _ in range(rnd.choice([8, 60, 150, 400]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(int(len(base) * rnd.choice([0, 0.01, 0.02, 0.04, 0.08]))):
                text[rnd.randrange(len(text))] = f"x{rnd.randint(0, 10**6)}"
            rows.append(" ".join(text))
    rnd.shuffle(rows)
    return [(k * 3 + 1, t) for k, t in enumerate(rows)]


def test_near_duplicates_against_brute_force(docs):
    rows = near_copies(1) + [(1000, None), (1001, ""), (1002, "A b"), (1003, "a  B"), (1004, "Ä b"), (1005, "ä b"), (1006, "w " * 5000)]
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs(rows, extra=True)).collect()}
    want = brute_components(rows)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == want[i][1]) for i, r in got.items())
    assert got[1003]["component_id"] == 1002 and got[1005]["component_id"] == 1005 and got[1001]["kept"]


def test_near_duplicates_small_cases(docs):
    assert minhash.near_duplicates(docs([])).count() == 0
    twice = minhash.near_duplicates(docs([(5, "a b c d e f"), (5, "a b c d e f")])).collect()
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in twice] == [(5, 5, True)] * 2
    assert minhash.near_duplicates(docs([(1, None), (2, " ")])).filter("kept").count() == 2


def test_sketch_estimates(docs):
    """The XOR of two sketches has about n / 2 * (1 - exp(-4 k (1 - j) / n)) ones."""
    base = [f"w{k}" for k in range(600)]
    changed = list(base)
    changed[::60] = [f"y{k}" for k in range(10)]
    rows = [(1, " ".join(base)), (2, " ".join(changed))]
    found = minhash.hashed_words(docs(rows)).mapInArrow(minhash.signatures, minhash.SIGNATURE).collect()
    a, b = (np.array(r["sketch"], dtype=np.int64).view(np.uint64) for r in found)
    ones = sum(int(x).bit_count() for x in a ^ b)
    sets = [shingles(t) for _, t in rows]
    j = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    estimate = 1 + minhash.SKETCH_BITS / (4 * minhash.SAMPLES) * np.log(1 - 2 * ones / minhash.SKETCH_BITS)
    assert abs(estimate - j) < 0.1


def test_sketch_limit_counts_both_errors():
    """Draws of the stated model: samples that differ, each with two flips in a bitmap."""
    rng, n = np.random.default_rng(0), 200_000
    for percent in (80, 85):
        flips = 2 * rng.binomial(minhash.SAMPLES, 1 - percent / 100, n)
        odd = np.zeros((n, minhash.SKETCH_BITS), dtype=bool)
        row = np.repeat(np.arange(n), flips)
        np.logical_xor.at(odd, (row, rng.integers(0, minhash.SKETCH_BITS, len(row))), True)
        ones = odd.sum(axis=1)
        assert (ones > minhash.sketch_limit(percent)).sum() == 0
        # The limit is no looser than that asks for: six standard errors at most.
        assert minhash.sketch_limit(percent) < ones.mean() + 6 * ones.std()
    assert minhash.sketch_limit(85) >= 70


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(400 + k, 401 + k) for k in range(60)] + [(7, 7)]
    parent = {x: x for l in links for x in l}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for l in links if l[0] != l[1] for x in l}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_sentences(text):
    """Pieces up to each mark; one of fewer than four words waits for the next, one of more than twelve is cut after some words."""
    pieces, waiting = re.split(r"((?:[.!?;]+\s+|[。！？；]+\s*|\s*\n\s*))", text), ""
    out = []
    for k in range(0, len(pieces), 2):
        piece = "".join(pieces[k : k + 2])
        waiting += piece
        if len(piece.split()) < 4 and k + 2 < len(pieces) and any(pieces[k + 2 :]):
            continue
        words = re.findall(r"\S+\s*|^\s+", waiting)
        for j, w in enumerate(words):
            long = len(waiting.split()) > 12 and j + 1 < len(words) and zlib.crc32(w.strip().lower().encode()) % 6 == 0
            out.append(w) if j == 0 or cut else out.append(out.pop() + w)
            cut = long
        waiting = ""
    return out


def brute_runs(parts):
    """(words of the run, first, last): the shortest runs of two sentences and twenty words from and up to each sentence."""
    words = [p.lower().split() for p in parts]

    def fits(a, b):
        return b - a >= 1 and sum(map(len, words[a : b + 1])) >= 20

    n = len(parts)
    found = {min(((a, b) for b in range(a, n) if fits(a, b)), default=None) for a in range(n)}
    found |= {max(((a, b) for a in range(b) if fits(a, b)), default=None) for b in range(n)}
    return [(tuple(map(tuple, words[a : b + 1])), a, b) for a, b in found - {None}]


def brute_spans(rows):
    first, gone = {}, {}
    cut = [(i, t, brute_sentences(t or "")) for i, t in rows]
    made = [brute_runs(parts) for _, _, parts in cut]
    for (i, _, _), found in zip(cut, made):
        for h, a, _ in found if i is not None else ():
            first[h] = min(first.get(h, (i, a)), (i, a))
    for (i, t, parts), found in zip(cut, made):
        dead = {k for h, a, b in found if i is not None and first[h] != (i, a) for k in range(a, b + 1)}
        gone[i] = ("".join(p for k, p in enumerate(parts) if k not in dead).rstrip() if dead else t, len(dead))
    return gone


def prose(rnd, n):
    return " ".join(f"q{rnd.randint(0, 10**6)}" + rnd.choice(["", "", "", "", ",", ".", ".\n"]) for _ in range(n))


def test_spans_against_brute_force(docs):
    rnd = random.Random(5)
    passage = prose(rnd, 60)
    rows = [(k, f"{prose(rnd, 80)} {passage} {prose(rnd, 70)}" if k % 3 == 0 else prose(rnd, 150)) for k in range(30)]
    rows += [(40, None), (41, ""), (42, "Short one. Two."), (43, passage + "\n" + passage), (44, " ".join(f"n{k}" for k in range(5000))), (None, passage)]
    rows += [(45, rows[0][1])]
    done = {r["doc_id"]: r for r in spans.without_repeats(docs(rows, extra=True)).collect()}
    want = brute_spans(rows)
    assert {i: (r["text"], r["__removed"]) for i, r in done.items()} == want
    assert done[0]["__removed"] == 0 and all(done[k]["text"] == dict(rows)[k] for k in range(30) if k % 3)
    middle = " ".join(passage.split()[20:40])
    flat = {i: " ".join((r["text"] or "").split()) for i, r in done.items()}
    assert middle in flat[0] and not any(middle in flat[k] for k in range(3, 30, 3))
    assert done[45]["text"] == "" and done[None]["text"] == passage


def test_spans_empty_and_repeated_rows(docs):
    assert spans.without_repeats(docs([])).count() == 0
    text = prose(random.Random(1), 100)
    rows = spans.without_repeats(docs([(1, text), (1, text)])).collect()
    assert [r["text"] for r in rows] == [text, text]


def test_a_passage_goes_to_its_last_sentence(docs):
    """No run that starts inside the last sentences ends where the passage does."""
    rnd = random.Random(6)

    def text(*sizes):
        return " ".join(" ".join(f"q{rnd.randint(0, 10**6)}" for _ in range(n)) + "." for n in sizes)

    rows, want = [], {}
    for k, sizes in enumerate([(10, 9, 8, 5), (12, 11, 10, 5), (7, 12, 6, 8, 11, 4, 9, 12, 5), (12, 12, 12)]):
        passage = text(*sizes)
        for i in range(10 * k, 10 * k + 3):
            head, tail = text(11, 9), text(12, 7)
            rows.append((i, f"{head} {passage} {tail}"))
            want[i] = rows[-1][1] if i % 10 == 0 else f"{head} {tail}"
    got = {r["doc_id"]: r["text"] for r in spans.without_repeats(docs(rows)).collect()}
    assert got == want and spans.MIN_WORDS == 20


def test_passages_planted_inside_sentences_are_found():
    rnd = random.Random(9)
    for _ in range(60):
        passage = prose(rnd, rnd.randint(51, 90))
        a, b = (spans.runs(f"{prose(rnd, rnd.randint(5, 90))} {passage} {prose(rnd, 60)}") for _ in range(2))
        assert set(a[0].tolist()) & set(b[0].tolist())


def test_sentences_are_local():
    """A passage without punctuation is cut alike in different places."""
    passage = " ".join(f"k{k * 7919 % 1000}" for k in range(80))
    a, b = spans.runs("one two. " + passage), spans.runs(" ".join(f"z{k}" for k in range(37)) + " " + passage + " end.")
    assert len(set(a[0].tolist()) & set(b[0].tolist())) >= 3
