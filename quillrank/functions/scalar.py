"""Column expressions shared by the operators. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillrank.fixed import HTML_TAG, KEYWORD_SPLIT


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_number(c: Column | str) -> Column:
    """Text to bigint, a fraction cut off; NULL where the text is no number."""
    text = col(c).cast("string")
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,10)").cast("bigint"))


def hash_unit(c: Column | str, seed: int | str) -> Column:
    """A repeatable number in [0, 1) from a key and a seed."""
    digest = F.md5(F.concat(col(c).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_slot(c: Column | str, slots: int, seed: int | str) -> Column:
    return F.floor(hash_unit(c, seed) * slots).cast("bigint")


def hash_feature(c: Column | str, buckets: int) -> Column:
    """A bucket from the md5 of a value; NULL for NULL."""
    return hash_slot(c, buckets, 0).cast("int")


def logistic(x: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-col(x)))


def logit(p: Column | str) -> Column:
    return F.ln(col(p) / (1.0 - col(p)))


def clip(p: Column | str, eps: float = 1e-15) -> Column:
    return F.greatest(F.lit(eps), F.least(F.lit(1.0 - eps), col(p)))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b as double, NULL for b = 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def version_at_least(c: Column | str, floor: str, order: str = "string") -> Column:
    """``string`` compares as text ('10.0' < '6.0'); ``version`` compares number by number, missing ones as zeros."""
    if order == "string":
        return col(c) >= F.lit(floor)
    if order != "version":
        raise ValueError("order is 'string' or 'version'")
    wanted = [int(x) for x in floor.split(".")]
    parts = F.transform(F.split(col(c), r"\."), lambda x: x.try_cast("int"))
    zeros = F.array_repeat(F.lit(0), F.greatest(F.lit(len(wanted)) - F.size(parts), F.lit(0)))
    return F.concat(parts, zeros) >= F.array(*[F.lit(x) for x in wanted])


def strip_html(c: Column | str) -> Column:
    return F.regexp_replace(col(c), HTML_TAG, "")


def trim_all(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def tokens(c: Column | str) -> Column:
    """Lower-case words of a text, split at white space and hyphens."""
    return F.filter(F.split(F.lower(col(c)), KEYWORD_SPLIT), lambda w: F.length(w) > 0)


def occurrences(text: Column, word: str) -> Column:
    """Non-overlapping occurrences of a word in a text."""
    if not word:
        return F.lit(0).cast("bigint")
    gone = F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))
    return F.floor(gone / len(word)).cast("bigint")


def doubles(v: Column | str) -> Column:
    return col(v).cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l1_similarity(a: Column, b: Column, top: float = 100.0) -> Column:
    """Sum of ``top - |x - y|`` over the dimensions."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: top - F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)


def vector_add(a: Column, b: Column, sign: float = 1.0) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y * sign)


def json_items(c: Column | str) -> Column:
    """A JSON array of strings as an array column."""
    return F.from_json(col(c), "array<string>")


def ds(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyyMMdd")


def differs_or_unknown(a: Column | str, b: Column | str) -> Column:
    return (col(a) == "") | (col(b) == "") | (col(a) != col(b))


def dirichlet_mean(alpha: Column | str) -> Column:
    total = F.aggregate(doubles(alpha), F.lit(0.0), lambda s, x: s + x)
    return F.transform(doubles(alpha), lambda x: safe_ratio(x, total))


def dirichlet_mode(alpha: Column | str) -> Column:
    total = F.aggregate(doubles(alpha), F.lit(0.0), lambda s, x: s + x - 1.0)
    return F.transform(doubles(alpha), lambda x: safe_ratio(x - 1.0, total))
