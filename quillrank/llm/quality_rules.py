"""Quality rules: a threshold table compiled into one projection.

Every row of RULES bounds one measure of a text. The table becomes a single Spark expression; no user function runs and
nothing is shuffled. Measures are ratios of whole numbers and are compared by cross multiplication, so that no rounding
decides a verdict.

Defined cases: a null text is an empty one; an empty text has no words, fails the base rule and no other one (a ratio
over nothing is not beyond a bound). Repeated rows are judged one by one. Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quillrank.llm.common import NOT_BREAK, documents, words

# Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was on are as with by at from this be "
    "der die und das den von zu mit ist im ein eine nicht auf für als dem des sich auch "
    "de la le et les des en un une du que est pour qui dans par pas sur avec au "
    "el los las y del se con por una para no su al lo"
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """``part * 1000 / whole`` must lie in [low, high] per mille; texts with less than ``least`` of ``whole`` pass."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    least: int = 1


RULES = (
    Rule("word_length", "word_chars", "n_words", low=2000, high=12000),
    Rule("symbols", "n_symbols", "n_words", high=300),
    Rule("shouting", "n_marks", "n_words", high=500),
    Rule("upper_case", "n_upper", "word_chars", high=400),
    Rule("stop_words", "n_stop_words", "n_words", low=10, least=50),
    Rule("line_copies", "n_dup_lines", "n_lines", high=300, least=4),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=900, least=4),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=300, least=4),
)


def stop_forms() -> list[str]:
    """Stop words as they stand inside and at the start of sentences."""
    return sorted({form for x in STOP_WORDS.split() for form in (x, x.capitalize())})


def repeated_windows(df: DataFrame, tokens: str = "w") -> DataFrame:
    """Add n_repeat_words: words inside three-word windows that occur at least twice.

    Texts whose window hashes all differ end there. In the others, equal windows become neighbours by one sort of (hash,
    position); the positions of repeated ones, sorted again, cover three words each, less where the next one starts
    earlier. Work grows as n log n with the length of the text. Every step is a column, so that it is computed once.
    """
    w = F.col(tokens)
    hashes = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    out = df.withColumn("h", F.slice(hashes, 1, F.greatest(F.size(w) - 2, F.lit(0))))
    some = F.size(F.array_distinct("h")) < F.size("h")
    numbered = F.sort_array(F.arrays_zip("h", F.sequence(F.lit(0), F.size("h") - 1).alias("i")))
    out = out.withColumn("ordered", F.when(some, numbered))

    def repeated(x: Column, k: Column) -> Column:
        near = F.get("ordered", k - 1)["h"], F.get("ordered", k + 1)["h"]
        return F.coalesce(x["h"] == near[0], F.lit(False)) | F.coalesce(x["h"] == near[1], F.lit(False))

    places = F.sort_array(F.transform(F.filter("ordered", repeated), lambda x: x["i"]))
    out = out.withColumn("places", places)
    covered = F.transform("places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda n, x: n + x)
    return out.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("h", "ordered", "places")


def measures(text: Column) -> dict[str, Column]:
    """Whole-number measures of a text by name; the words are split once, in a column of their own (``w``)."""
    w, lines = F.col("w"), F.col("lines")
    starts = F.transform(lines, lambda x: F.substring(F.ltrim(x), 1, 1))

    def size(column):
        return F.size(column).cast("long")

    def found(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    return {
        "n_words": size(w),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": found(SYMBOLS),
        "n_dup_lines": size(lines) - size(F.array_distinct(lines)),
        "n_repeat_words": F.col("n_repeat_words"),
        "n_marks": found("!"),
        "n_upper": found(r"\p{Lu}"),
        "n_stop_words": size(F.filter(w, lambda x: x.isin(stop_forms()))),
        "n_lines": size(lines),
        "n_bullet_lines": size(F.filter(starts, lambda x: x.isin("-", "*", "•", "·"))),
        "n_cut_lines": size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
    }


def failed(rule: Rule) -> Column:
    part, whole = F.col(rule.part) * 1000, F.col(rule.whole)
    out = F.lit(False)
    if rule.low is not None:
        out = out | (part < whole * rule.low)
    if rule.high is not None:
        out = out | (part > whole * rule.high)
    return (whole >= rule.least) & out


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, all measures, base_failed, failed_rules (names, in table order) and kept."""
    docs = documents(df, key, text)
    split = docs.withColumns(
        {
            "w": words(F.col("text")),
            "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(NOT_BREAK)),
        }
    )
    counted = repeated_windows(split).select("doc_id", *[c.alias(name) for name, c in measures(F.col("text")).items()])
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    names = F.array_compact(F.array(*[F.when(failed(r), F.lit(r.name)) for r in rules]))
    verdict = counted.withColumns({"base_failed": base, "failed_rules": names})
    return verdict.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
