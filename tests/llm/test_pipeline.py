"""The pipeline over planted rows: what each stage must drop, and what must come through all of them."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quillrank.llm import minhash

WORDS = "the of and to in is that it for was on are as with river stone garden evening market letter window summer teacher bridge".split()


def prose(rnd, n):
    out = []
    while len(out) < n:
        sentence = [rnd.choice(WORDS) + rnd.choice(["", "", "s", "ing", "ed"]) + str(rnd.randint(0, 99)) * (rnd.random() < 0.3) for _ in range(rnd.randint(5, 12))]
        out += [*sentence[:-1], sentence[-1] + "."]
    return " ".join(out)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(11)
    asked = [(k, prose(rnd, 40)) for k in range(4)]
    passage = prose(rnd, 70)
    rows = [(k, prose(rnd, rnd.randint(60, 300))) for k in range(80)]
    base = prose(rnd, 300).split()
    for k in range(80, 90):
        text = list(base)
        text[rnd.randrange(300)] = "changed"
        rows.append((k, " ".join(text)))
    rows += [(90, rows[3][1]), (91, rows[4][1])]
    rows += [(100 + k, f"{prose(rnd, 150)} {passage} {prose(rnd, 150)}") for k in range(3)]
    rows += [(110 + k, f"{prose(rnd, 90)} {asked[k][1]} {prose(rnd, 90)}") for k in range(4)]
    rows += [(120 + k, " ".join(w + "%%%$$$" for w in prose(rnd, 80).split())) for k in range(5)]
    rows += [(130, None), (131, ""), (132, prose(rnd, 4000))]
    at = tmp_path_factory.mktemp("tables")
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(60)] + [(120, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(asked, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), dict(rows), passage


def test_stages(spark, folder):
    path, texts, passage = folder
    docs, after = spark.read.parquet(f"{path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            docs = docs.checkpoint()
            after[name] = {r["doc_id"]: r for r in docs.collect()}
    kept = [set(rows) for rows in after.values()]
    assert set(texts) - kept[0] == set(range(120, 125))
    # One of the ten near copies, one of two equal texts, both empty ones.
    assert kept[0] - kept[1] == set(range(81, 90)) | {90, 91}
    assert kept[2] == kept[1]
    changed = {i for i, r in after["repeated passages"].items() if r["text"] != texts[i]}
    assert changed == {101, 102} and all(len(r["text"] or "") == r["n_chars"] for r in after["repeated passages"].values())
    middle = " ".join(passage.split()[25:40])
    assert middle in after["repeated passages"][100]["text"]
    assert not any(middle in after["repeated passages"][k]["text"] for k in (101, 102))
    assert kept[2] - kept[3] == {110, 111, 112, 113}
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    placed = docs.toPandas()
    last = after["benchmark passages"]
    assert set(placed.doc_id) == set(last)
    assert placed.length.sum() == sum(len(encode(r["text"] or "").ids) + 1 for r in last.values())
    by = placed.groupby("sequence_id").length.sum()
    assert by.max() <= 2048 and len(by) <= int(np.ceil(placed.length.sum() / 2048)) + 1


def test_run_is_the_chain_of_stages(spark, folder):
    path, texts, _ = folder
    found = corpus_pipeline.run(spark, path)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert {r["doc_id"] for r in found.select("doc_id").distinct().collect()} == set(texts) - {*range(120, 125), *range(81, 92), *range(110, 114)}


def test_near_copies_between_80_and_85_percent_go(spark, docs):
    """Scattered changes in texts of 300 words; the operator's own query still links from 85 % on."""
    rnd = random.Random(12)

    def shingles(text):
        w = text.split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    rows, gone = [], set()
    for k in range(0, 60, 2):
        text = [f"n{rnd.randint(0, 10**6)}" for _ in range(300)]
        other, changes = list(text), rnd.choice([5, 6, 7, 9])
        for j in range(changes):
            other[10 + 30 * j] = f"c{rnd.randint(0, 10**6)}"
        rows += [(k, " ".join(text)), (k + 1, " ".join(other))]
        a, b = shingles(rows[-2][1]), shingles(rows[-1][1])
        if len(a & b) / len(a | b) >= 0.8:
            gone.add(k + 1)
            assert len(a & b) / len(a | b) < 0.85
    assert 10 < len(gone) < 25
    df = docs(rows)
    assert {k for k, _ in rows} - {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, df, "").collect()} == gone
    assert minhash.near_duplicates(df, percent=85).filter("kept").count() == len(rows)
