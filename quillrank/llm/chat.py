"""Chat records: turns with typed content parts become one marked text per conversation, by column expressions alone.

A message holds an ordered array of parts. A visitor with one method per type turns each part into text: text parts have
control strings escaped, other parts become numbered placeholders, and the visitor records their references and the
tokens they stand for. Turns are sorted by (turn, role, content) and joined under the template

    <|im_start|>ROLE\nCONTENT<|im_end|>\n

Escaping puts one more backslash into every run ``<\\...|``, so that no text can hold a mark; unescaping takes it out
again. Roles also have backslashes and line breaks written as ``\\\\`` and ``\\n``. Each rendered turn is made before the
rows of a conversation meet; the record of one conversation is one value and so lies in one task.

Defined cases: null texts, roles and parts count as empty; a null turn comes first; equal rows are turns of their own; a
part of an unknown type becomes a ``file`` placeholder; rows with a null conversation form one conversation. A
conversation without assistant turns has an empty loss mask. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillrank.llm.common import bind

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
# Tokens that one unit of an attachment stands for: an image, a second of sound, a page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}
PART = "struct<type:string,text:string,ref:string,units:int>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    """Pairs of backslashes first become a mark that cannot occur, so that ``\\\\n`` is not read as a line break."""
    marked = F.replace(role, F.lit("\\\\"), F.lit("<|b|>"))
    broken = F.replace(marked, F.lit("\\n"), F.lit("\n"))
    return unescaped(F.replace(broken, F.lit("<|b|>"), F.lit("\\")))


class Visitor:
    """Expressions for one content part: its text, whether it is an attachment, and the tokens it expands to."""

    def text(self, part: Column) -> Column:
        return escaped(F.coalesce(part["text"], F.lit("")))

    def attachment(self, kind: str) -> Column:
        return F.lit(f"<|{kind}|>")

    def render(self, part: Column) -> Column:
        out = F.when(F.coalesce(part["type"], F.lit("text")) == "text", self.text(part))
        for kind in UNIT_TOKENS:
            out = out.when(part["type"] == kind, self.attachment(kind))
        return out.otherwise(self.attachment("file"))

    def attached(self, part: Column) -> Column:
        return F.coalesce(part["type"], F.lit("text")) != "text"

    def tokens(self, part: Column) -> Column:
        out = F.when(~self.attached(part), F.lit(0))
        for kind, each in UNIT_TOKENS.items():
            out = out.when(part["type"] == kind, F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1)) * each)
        return out.otherwise(F.lit(0)).cast("long")

    def reference(self, part: Column) -> Column:
        return F.struct(
            F.coalesce(part["type"], F.lit("")).alias("type"),
            F.coalesce(part["ref"], F.lit("")).alias("ref"),
            self.tokens(part).alias("tokens"),
        )


def text_parts(text: Column) -> Column:
    """A plain text as a content of one part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))


def record(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", visitor: Visitor | None = None) -> DataFrame:
    """conv_id, formatted, n_turns, loss_spans (start from 0, length), attachments (in order) and expanded_tokens.

    ``parts`` is an array of PART structs.
    """
    v = visitor or Visitor()
    content = F.filter(F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    named = F.coalesce(F.col(role), F.lit(""))
    body = F.array_join(F.transform(content, v.render), "")
    head = F.concat(F.lit(START), escaped_role(named), F.lit("\n"))
    turns = df.select(
        F.col(conversation).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).cast("long").alias("turn"),
            named.alias("role"),
            body.alias("body"),
            F.concat(head, body, F.lit(END + "\n")).alias("shown"),
            F.length(head).alias("head"),
            F.length(body).alias("length"),
            F.transform(F.filter(content, v.attached), v.reference).alias("attachments"),
        ).alias("t"),
    )
    before = Window.partitionBy("conv_id").orderBy("t.turn", "t.role", "t.body").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("start", F.coalesce(F.sum(F.length("t.shown")).over(before), F.lit(0)))
    # Every turn has marks, so starts differ and sorting by them keeps the order of the turns.
    joined = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("start", "t.*"))).alias("t"))
    trained = F.filter("t", lambda x: x["role"] == TRAINED_ROLE)
    spans = F.transform(trained, lambda x: F.struct((x["start"] + x["head"]).alias("start"), x["length"].alias("length")))
    attachments = F.flatten(F.transform("t", lambda x: x["attachments"]))
    return joined.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: x["shown"]), "").alias("formatted"),
        F.size("t").cast("long").alias("n_turns"),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def parsed(formatted: Column) -> Column:
    """The turns (role, text) that a formatted record holds, in order."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    turns = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(
        turns,
        lambda piece: bind(
            F.struct(piece.alias("p"), F.locate("\n", piece).alias("cut")),
            lambda x: F.struct(
                unescaped_role(F.substring(x["p"], F.lit(len(START) + 1), x["cut"] - len(START) - 1)).alias("role"),
                unescaped(F.substring(x["p"], x["cut"] + 1, F.length(x["p"]))).alias("text"),
            ),
        ),
    )


def under_mask(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"]))), ""
    )


def digest(records: DataFrame) -> DataFrame:
    """Counts and digests of what the records say, read from the formatted text and its spans alone."""
    read = records.select("conv_id", "formatted", parsed(F.col("formatted")).alias("turns"), under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"), "expanded_tokens")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "expanded_tokens",
    )
