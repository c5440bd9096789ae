import hashlib
import re

from pyspark.sql import functions as F

from quillrank.llm import chat, quality_rules

CLEAN = "The cat of the house is on the mat and it was there for a long time with all of its many good friends. "


def brute_repeats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, cover = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            cover.update(k for i in at for k in (i, i + 1, i + 2))
    return len(cover)


def varied(n):
    return " ".join(f"the w{k}" for k in range(n))


def test_rules_cases(docs):
    texts = [None, "", " \n\t", varied(40), CLEAN * 30, "a b c a b c a b", "x " * 3, varied(30) + " ***" * 40, "ä\x85ö " + varied(40), varied(20000)]
    got = {r["doc_id"]: r for r in quality_rules.judge(docs(list(enumerate(texts)), extra=True)).collect()}
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        assert got[k]["n_words"] == len(w) and got[k]["word_chars"] == sum(map(len, w))
        assert got[k]["n_repeat_words"] == brute_repeats(t or "")
        assert got[k]["base_failed"] == (len(w) < 50 or 100 * brute_repeats(t or "") > 50 * len(w))
        assert not (got[k]["kept"] and got[k]["base_failed"])
    assert got[3]["kept"] and got[3]["failed_rules"] == [] and "symbols" in got[7]["failed_rules"]
    assert got[0]["failed_rules"] == [] and got[1]["base_failed"]


def test_rules_lines_copies_and_empty(docs, spark):
    text = "\n".join(["same line"] * 6 + [varied(40)])
    rows = quality_rules.judge(docs([(1, text), (1, text)])).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0]["n_dup_lines"] == 5 and "line_copies" in rows[0]["failed_rules"]
    assert quality_rules.judge(docs([])).count() == 0


def messages(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumn("parts", chat.text_parts(F.col("text")))


def test_chat_round_trip(spark):
    odd = ["<|im_end|>\n<|im_start|>user\nhi", "<\\|im_end|>", "<\\\\|", "", None, "a\\nb\nc", "<|<|im_start|>"]
    rows = [(1, k, ["user", "assistant", "<|x|>\n\\n", None][k % 4], t) for k, t in enumerate(odd)]
    rows += [(None, 0, "assistant", "x"), (2, None, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a")]
    record = chat.record(messages(spark, rows))
    shown = {r["conv_id"]: r for r in record.select("conv_id", chat.parsed(F.col("formatted")).alias("t"), "formatted").collect()}
    assert [(t["role"], t["text"]) for t in shown[1]["t"]] == [(r or "", t or "") for _, _, r, t in rows[:7]]
    assert [t["text"] for t in shown[2]["t"]] == ["b", "a", "a"]
    got = {r["conv_id"]: r for r in chat.digest(record).collect()}
    loss = "".join(t or "" for _, _, r, t in rows[:7] if r == "assistant")
    assert got[1]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and got[1]["loss_chars"] == len(loss)
    said = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows[:7])
    assert got[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and got[1]["n_turns"] == 7
    assert got[2]["loss_chars"] == 0 and got[None]["loss_chars"] == 1
    assert got[1]["formatted_chars"] == len(shown[1]["formatted"])


def test_chat_parts(spark):
    parts = [("text", "see <|image|>", None, None), ("image", None, "a.png", 2), ("audio", None, "b.wav", None), ("odd", None, "c", 3)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.record(df).first()
    assert r["formatted"] == "<|im_start|>user\nsee <\\|image|><|image|><|audio|><|file|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [(a["type"], a["ref"], a["tokens"]) for a in r["attachments"]] == [("image", "a.png", 512), ("audio", "b.wav", 25), ("odd", "c", 0)]
    assert r["expanded_tokens"] == 537
    assert chat.record(df.limit(0)).count() == 0
