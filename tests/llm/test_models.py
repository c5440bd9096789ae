import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillrank.llm import kneser_ney, latent, toxicity, word_ngrams
from quillrank.session import stage


def brute_kneser_ney(texts, alphabet):
    """log p(z | x y) by dictionaries, over the ids of ``alphabet`` (others 1, start 0)."""
    a = kneser_ney.ALPHABET
    ids = {c: k + 2 for k, c in enumerate(alphabet)}
    third = Counter()
    for t in texts:
        s = [0, 0, *[ids.get(c, 1) for c in t]]
        third.update(zip(s, s[1:], s[2:]))
    second = Counter((y, z) for _, y, z in third)
    first = Counter(z for _, z in second)

    def discount(counts):
        n = [max(sum(1 for c in counts.values() if c == k), 1) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.05), k + 0.95) for k in range(3)]
        return lambda c: d[min(c, 3) - 1] if c else 0.0

    d1, d2, d3 = discount(first), discount(second), discount(third)

    def mix(count, d, seen, lower):
        total = sum(seen)
        return lower if not total else (count - d(count) + sum(map(d, seen)) * lower) / total

    two, three = defaultdict(list), defaultdict(list)
    for (y, _), c in second.items():
        two[y].append(c)
    for (x, y, _), c in third.items():
        three[x, y].append(c)

    def log_p(x, y, z):
        p1 = mix(first[z], d1, list(first.values()), 1 / a)
        return math.log(mix(third[x, y, z], d3, three[x, y], mix(second[y, z], d2, two[y], p1)))

    return ids, log_p


def sentence(rnd):
    return " ".join("".join(rnd.choice("etaoinsrhl") for _ in range(rnd.randint(1, 7))) for _ in range(rnd.randint(3, 30))) + "."


def test_kneser_ney_against_brute_force(docs, spark):
    rnd = random.Random(0)
    rows = [(k, sentence(rnd), "en") for k in range(60)] + [(k, sentence(rnd).replace("e", "é"), "fr") for k in range(60, 90)]
    rows += [(100, "##%% @@@@ ((((****" * 20, "en"), (101, None, "en"), (102, "", None), (103, sentence(rnd), None), (104, "a\0b", "xx"), (0, rows[0][1], "en")]
    labels = [(k, 1) for k in range(90)] + [(100, 0), (5, 1), (6, 0), (None, 1), (7, None), (103, 1)]
    trusted = [rows[k][1] for k in range(90) if k not in (6, 7)] + [rows[93][1], rows[0][1]]
    df = docs(rows, extra=True)
    ids = kneser_ney.trusted_ids(spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {r[0] for r in ids.collect()} == {*range(90), 103} - {6, 7}
    counts = Counter("".join(trusted))
    top = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], ord(x[0])))[: kneser_ney.ALPHABET - 2]]
    known, log_p = brute_kneser_ney(trusted, top)
    got = {r["doc_id"]: r for r in kneser_ney.classify(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    for i, t, _ in rows:
        s = [0, 0, *[known.get(c, 1) for c in (t or "")]]
        if len(s) > 2:
            want = math.exp(-sum(log_p(*w) for w in zip(s, s[1:], s[2:])) / (len(s) - 2))
            assert abs(got[i]["perplexity"] / want - 1) < 1e-4
        else:
            assert got[i]["perplexity"] is None and got[i]["kept"]
    assert not got[100]["kept"] and all(got[k]["kept"] for k in range(90))


def brute_words(texts):
    """Word bigrams of (key, text) by dictionaries: the mean negative log-probability of a text seen from outside or inside."""
    def pairs(t):
        w = [x[:-1] if x[-1] in ".,;:!?" else x for x in t.lower().split()]
        return list(zip(["", *w], w))

    second, at2, at1 = Counter(), defaultdict(set), defaultdict(set)
    for i, t in texts:
        for y, z in pairs(t):
            second[y, z] += 1
            at2[y, z].add(i)
            at1[z].add(i)
    first = Counter(z for _, z in second)

    def discount(counts):
        n = [max(sum(1 for c in counts.values() if c == k), 1) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.05), k + 0.95) for k in range(3)]
        return lambda c: d[min(c, 3) - 1]

    d1, d2 = discount(first), discount(second)
    after = defaultdict(list)
    for (y, _), c in second.items():
        after[y].append(c)
    least = sum(map(d1, first.values())) / sum(first.values()) / (len(first) + 1)

    def p(i, y, z):
        weight = sum(map(d2, after[y])) / sum(after[y]) if y in after else 1.0
        low = least if at1[z] <= {i} else (first[z] - d1(first[z])) / sum(first.values()) + least
        return weight * low if at2[y, z] <= {i} else (second[y, z] - d2(second[y, z])) / sum(after[y]) + weight * low

    return lambda i, t: -sum(math.log(p(i, *x)) for x in pairs(t)) / len(pairs(t))


def test_word_bigrams_reject_junk_of_ordinary_words(docs, spark):
    """Word lists and one word over and over have ordinary letters; perplexity is that of a dictionary model."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("etaoinsrhl") for _ in range(rnd.randint(2, 7))) for _ in range(200)]
    follow = {w: rnd.sample(words, 4) for w in words}

    def prose(n):
        out = [rnd.choice(words)]
        while len(out) < n:
            out.append(rnd.choice(follow[out[-1]]))
        return " ".join(w + rnd.choice(["", "", "", ",", "."]) for w in out)

    rows = [(k, prose(rnd.randint(60, 300))) for k in range(120)] + [(k, prose(200).upper()) for k in range(120, 130)]
    rows += [(k, " ".join(rnd.choice(words) for _ in range(200))) for k in range(130, 135)]
    rows += [(k, " ".join([rnd.choice(words)] * 300)) for k in range(135, 140)]
    rows += [(140, prose(150)), (140, rows[0][1]), (140, rows[0][1]), (None, prose(100)), (141, " .\n"), (142, None)]
    labels = spark.createDataFrame([(k, 1) for k in range(120)], "doc_id long, quality int")
    got = kneser_ney.classify(docs([(i, t and t.lower()) for i, t in rows], extra=True), labels).collect()
    assert len(got) == len(rows)
    want, found = brute_words([(i, t) for i, t in rows[:120]]), defaultdict(list)
    for r in got:
        found[r["doc_id"]].append(r)
    for i, t in rows[:140]:
        assert abs(math.log(found[i][0]["word_perplexity"]) - want(i, t)) < 1e-6
    assert not any(found[k][0]["kept"] for k in range(130, 140))
    assert sum(found[k][0]["kept"] for k in range(130)) > 125 and found[142][0]["kept"] and found[None][0]["n_words"] == 100
    assert found[141][0]["n_words"] == 0 and found[141][0]["word_perplexity"] is None
    one, two, three = sorted(found[140], key=lambda r: r["word_perplexity"])
    assert len({one["word_perplexity"], two["word_perplexity"], three["word_perplexity"]}) == 2
    once = [r for r in rows if 120 <= (r[0] or 0) < 140]
    many = kneser_ney.classify(docs([(i, t and t.lower()) for i, t in rows[:120] + once * 10]), labels).filter("doc_id >= 120").collect()
    assert len(many) == 10 * len(once)
    for r in many:
        alone = found[r["doc_id"]][0]
        assert r["n_words"] == alone["n_words"] and r["kept"] == alone["kept"]
        assert abs(r["word_perplexity"] / alone["word_perplexity"] - 1) < 1e-9 and abs(r["repeats"] - alone["repeats"]) < 1e-9


def word_texts(rnd, n):
    common = [f"w{k}" for k in range(300)]
    return [" ".join(rnd.choice(common) if rnd.random() < 0.9 else f"x{rnd.randrange(10**6)}" for _ in range(rnd.randrange(1, 60))) for _ in range(n)]


def test_word_model_is_the_same_in_any_blocks(docs, spark):
    rnd = random.Random(5)
    rows = list(enumerate(word_texts(rnd, 120)))
    # Copies, a key with several texts, a null key and blank texts, in several tasks.
    rows += rows[:20] + [(5, t) for t in word_texts(rnd, 6)] + [(None, rows[3][1]), (130, " "), (131, None)]
    df = docs(rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    trusted = stage(spark.createDataFrame([(k,) for k in range(0, 120, 2)] + [(5,)], "doc_id long"), "trusted")
    found = []
    for parts, block, segment, ids in ((1, 10**6, 10**6, 100), (4, 150, 40, 100), (3, 10**6, 200, 0)):
        old, kneser_ney.IDS = kneser_ney.IDS, ids
        try:
            marked, shared = kneser_ney.marked(df.repartition(parts), trusted)
        finally:
            kneser_ney.IDS = old
        out = word_ngrams.scored(marked, shared, kneser_ney._discounts, block, segment).collect()
        found.append({r["rid"]: (r["n_words"], r["word_nll"], r["word_saved"]) for r in out})
    assert len(found[0]) == 126 + 1
    for other in found[1:]:
        assert found[0].keys() == other.keys()
        for rid, values in found[0].items():
            assert values == pytest.approx(other[rid], rel=1e-9, abs=1e-9)


def test_word_model_writes_few_bytes_a_word(docs, spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(k, " ".join(f"w{int(3000 * rnd.random() ** 2)}" for _ in range(200))) for k in range(400)]
    labels = spark.createDataFrame([(k, 1) for k in range(200)], "doc_id long, quality int")
    tables = []
    monkeypatch.setattr(word_ngrams, "stage", lambda df, name: tables.append(stage(df, name)) or tables[-1])
    assert kneser_ney.classify(docs(rows).coalesce(2), labels).count() == 400
    size = sum(os.path.getsize(f.removeprefix("file:").replace("//", "")) for t in tables for f in t.inputFiles())
    assert 0 < size < 10 * 400 * 200


def test_kneser_ney_without_trusted_text(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["kept"] for r in kneser_ney.classify(docs([(1, "abc"), (2, None)]), none).collect()] == [True, True]
    assert kneser_ney.classify(docs([]), none).count() == 0


def test_factorization_machine_learns_pairs(docs, spark):
    """Neither word alone says anything; both together do. Single terms are learnt as well."""
    rnd = random.Random(1)
    rows, labels = [], []
    for k in range(3000):
        words = [f"word{rnd.randint(0, 200)}" for _ in range(12)]
        insult, group, plain = rnd.random() < 0.4, rnd.random() < 0.4, rnd.random() < 0.15
        words += ["rottenly"] * insult + ["northern"] * group + ["vilest"] * plain
        rnd.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(insult and group or plain)))
    got = toxicity.score(docs(rows, extra=True), spark.createDataFrame(labels, "doc_id long, toxic int")).toPandas()
    truth = np.array([y for _, y in labels])[got.doc_id]
    held = got.held_out.to_numpy()
    assert 0.15 < held.mean() < 0.25
    assert (got.predicted.to_numpy() == truth)[held].mean() > 0.97


def test_factorization_machine_learns_pairs_without_single_terms(docs, spark):
    """Each of two words is as frequent in toxic texts as in others: toxic is who has both or neither."""
    rnd = random.Random(2)
    rows, labels = [], []
    for k in range(3000):
        words = [f"word{rnd.randint(0, 200)}" for _ in range(12)]
        insult, group = rnd.random() < 0.5, rnd.random() < 0.5
        words += ["rotten"] * insult + ["north"] * group
        rnd.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(insult == group)))
    truth = np.array([y for _, y in labels])
    for word in ("rotten", "north"):
        assert abs(np.corrcoef([word in t for _, t in rows], truth)[0, 1]) < 0.05
    got = toxicity.score(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).filter("held_out").toPandas()
    assert (got.predicted.to_numpy() == truth[got.doc_id]).mean() > 0.95


def test_factorization_machine_cases(docs, spark):
    df = docs([(1, None), (2, ""), (3, "x y"), (3, "x y"), (None, "z")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(df, none).collect()
    assert len(got) == 5 and all(0 < r["score"] < 1 for r in got)
    one = spark.createDataFrame([(1, 0), (2, 0), (3, None)], "doc_id long, toxic int")
    assert toxicity.score(df, one).filter("predicted = 1").count() == 0
    assert toxicity.score(docs([]), none).count() == 0


def test_latent_finds_passages_and_paraphrases(docs, spark):
    rnd = random.Random(3)
    vocabulary = [f"t{rnd.randint(0, 10**6)}" for _ in range(3000)]
    item = {k: [rnd.choice(vocabulary) for _ in range(n)] for k, n in enumerate((6, 15, 30, 59, 200))}

    def filler(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    rows, want = [], {}
    for k in range(80):
        rows.append((k, " ".join(filler(rnd.randint(1, 400)))))
    for k in range(50):
        i = k % 5
        words = list(item[i])
        if k >= 25 and i > 1:  # lose every tenth word, change every twelfth
            words = [rnd.choice(vocabulary) if j % 12 == 5 else w for j, w in enumerate(words) if j % 10 != 9]
        text = " ".join(filler(rnd.randint(0, 90)) + words + filler(rnd.randint(0, 90)))
        rows.append((100 + k, text.upper() if k % 2 else text.replace(" ", ", ")))
        want[100 + k] = i
    rows += [(200, None), (201, ""), (202, " ".join(reversed(item[3]))), (203, " ".join(item[2])), (203, " ".join(item[2]))]
    asked = spark.createDataFrame([*[(k, " ".join(w)) for k, w in item.items()], (90, None), (91, ""), (1, " ".join(item[1]))], "item_id long, text string")
    got = latent.contaminated(docs(rows, extra=True), asked).collect()
    found = {r["doc_id"]: {h["item_id"] for h in r["hits"]} for r in got}
    assert all(i in found[d] for d, i in want.items())
    assert not any(found[k] for k in range(80)) and not found[202] and not found[200] and not found[201]
    assert found[203] == {2} and sum(r["doc_id"] == 203 for r in got) == 2
    assert all(r["contaminated"] == bool(r["hits"]) for r in got)


def common_words_in_order(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
    return row[-1]


def brute_found(text, item):
    """Whether some stretch of the text, 16 words longer than the item at either end, holds enough of the item in order."""
    n = len(item)
    for p in range(-n, len(text), 2):
        region = text[max(p - 16, 0) : max(p + n + 16, 0)]
        if sum((Counter(item) & Counter(region)).values()) < 0.6 * n:
            continue
        share = common_words_in_order(item, region) / n
        tail = item[n - max(n // 3, 1) :]
        if share >= 0.75 or (share >= 0.6 and common_words_in_order(tail, region) / len(tail) >= 0.5):
            return True
    return False


def test_latent_recall_against_brute_force(docs, spark):
    """Items of all lengths, verbatim or with a share of their words, among words of very unequal frequency: the latent search
    proposes nine tenths of what brute force accepts, at every length, and nothing that it does not accept."""
    rnd = random.Random(13)
    vocabulary = [f"v{k}" for k in range(3000)]
    weights = [1 / (k + 3) for k in range(3000)]

    def filler(n):
        return rnd.choices(vocabulary, weights, k=n)

    items = [filler(n) for n in [*range(3, 44), 59, 100, 200]]
    rows, planted = [], []
    for k in range(8 * len(items)):
        i = k % len(items)
        kept = rnd.choice([1.0, 0.8, 0.7, 0.65])
        inside = [w if rnd.random() < kept else rnd.choice(vocabulary) for w in items[i]]
        rows.append((k, " ".join(filler(rnd.randint(0, 90)) + inside + filler(rnd.randint(0, 90)))))
        planted.append((k, i))
    got = latent.contaminated(docs(rows), spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string"))
    found = {r["doc_id"]: {h["item_id"] for h in r["hits"]} for r in got.collect()}
    wanted, right = Counter(), Counter()
    for k, i in planted:
        if brute_found(rows[k][1].split(), items[i]):
            band = min(len(items[i]) // 8, 4)
            wanted[band] += 1
            right[band] += i in found[k]
    assert sum(wanted.values()) > 250 and all(right[band] >= 0.9 * n for band, n in wanted.items()), (wanted, right)
    for k, hits in found.items():
        for i in hits - {planted[k][1]}:
            assert latent.Item(0, np.array([hash(w) for w in items[i]])).found([hash(w) for w in rows[k][1].split()]), (k, i)


def test_latent_blocks_and_empty(docs, spark, monkeypatch):
    none = spark.createDataFrame([], "item_id long, text string")
    assert latent.contaminated(docs([(1, "a b c")]), none).filter("contaminated").count() == 0
    assert latent.contaminated(docs([]), none).count() == 0
    monkeypatch.setattr(latent, "ITEMS", 2)
    rnd = random.Random(1)
    items = [(k, " ".join(f"u{rnd.randint(0, 10**5)}" for _ in range(30))) for k in range(5)]
    rows = [(k, t + " and more") for k, t in items] + [(50 + k, " ".join(f"u{rnd.randint(0, 10**5)}" for _ in range(60))) for k in range(40)]
    got = latent.contaminated(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: [h["item_id"] for h in r["hits"]] for r in got if r["hits"]} == {k: [k] for k in range(5)}


def test_latent_sums_by_blocks():
    """Sums, frequencies and moments of short, full, long and empty texts against loops over the blocks."""
    rnd = np.random.default_rng(3)
    texts = [rnd.integers(-(2**31), 2**31, n).astype(np.int32) for n in (0, 1, 16, 17, 300, 0, 5)] + [np.full(40, 7, np.int32)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.list_(pa.int32()))], ["doc_id", "words"])
    blocks = [(t.astype(np.int64) & 0xFFFFFFFF)[k : k + latent.STEP] % latent.TERMS for t in texts for k in range(0, len(t), latent.STEP)]
    table = np.append(rnd.normal(size=(latent.TERMS, 3)), np.zeros((1, 3)), axis=0).astype(np.float32)
    b = latent.Blocks(batch.column(1))
    assert [[t for t in line if t >= 0] for line in b.lines().tolist()] == [t.tolist() for t in blocks]
    want = np.array([table[t].sum(axis=0) for t in blocks])
    assert np.allclose(b.sums(table), want, atol=1e-4) and np.allclose(b.sums(table, 2, 5), want[2:5], atol=1e-4)
    counts = next(latent._frequencies(iter([batch]))).column(1).to_numpy()
    seen = Counter(t for block in blocks for t in set(block.tolist()))
    assert counts[-1] == len(blocks) and {t: n for t, n in enumerate(counts[:-1].tolist()) if n} == seen


def test_longest_common_subsequence():
    rnd = random.Random(2)
    for _ in range(200):
        a = [rnd.randint(0, 6) for _ in range(rnd.randint(1, 90))]
        b = [rnd.randint(0, 6) for _ in range(rnd.randint(0, 90))]
        assert round(latent.Item(0, np.array(a)).share(0, b) * len(a)) == common_words_in_order(a, b)


def test_factorization_machine_against_double_loop():
    """Margins are the bias, the weights, and all pairs one by one over the number of terms."""
    rng = np.random.default_rng(4)
    machine = toxicity.Machine(60)
    machine.bias, machine.w, machine.v = 0.3, rng.normal(size=60), rng.normal(size=(60, toxicity.FACTORS))
    rows = [sorted(rng.choice(60, size=k, replace=False).tolist()) for k in (1, 2, 5, 0, 40, 60)]
    term = np.array([t for r in rows for t in r])
    row = np.array([k for k, r in enumerate(rows) for _ in r])
    for got, r in zip(machine.margins(term, row, len(rows)), rows):
        pairs = sum(float(machine.v[a] @ machine.v[b]) for i, a in enumerate(r) for b in r[i + 1 :])
        want = 0.3 + sum(machine.w[t] for t in r) + pairs / max(len(r), 1)
        assert abs(got - min(max(want, -toxicity.MARGIN), toxicity.MARGIN)) < 1e-9


def test_factorization_machine_on_texts_of_all_lengths(docs, spark):
    """Texts of 5 to 5,000 words: the score stays a probability, and long clean texts stay clean."""
    rnd = random.Random(6)
    rows, labels = [], []
    for k in range(2000):
        words = [f"word{rnd.randint(0, 4000)}" for _ in range(5000 if k % 60 == 0 else rnd.choice([5, 20, 100, 400]))]
        toxic = rnd.random() < 0.3
        words += ["rotten", "vile", "awful", "scum", "north"] if toxic else rnd.choice([[], ["north"]])
        rnd.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    truth = np.array([y for _, y in labels])
    got = toxicity.score(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).toPandas()
    assert ((got.score > 0) & (got.score < 1)).all() and got.score.nunique() > 300
    held = got[got.held_out]
    y = truth[held.doc_id]
    order = held.score.rank().to_numpy()
    auc = (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (y == 0).sum())
    assert auc > 0.9 and held.predicted[y == 0].mean() < 0.15
