"""Merkle manifest of a table: a tree per group and one over the groups, built by pivoting children into slots.

A leaf is the hash of a row's fields. The leaves of a group stand in the order of their keys; every FANOUT neighbours get
one parent. A level of the tree is made by one aggregation over (group, place / FANOUT): conditional aggregates spread
the children into the columns s0, s1, ..., and the hash of the columns one after the other is the parent. The same rows
give the siblings of a child, the columns before and after its own slot, so proofs need no second look at the children.
From the root down every row gets the (left, right) sibling texts of its ancestors by a join with its parent's row. That
is done for parents of leaves and above, an eighth of the rows; the leaves get theirs where they are read out of the
slots.

Groups of different heights share the passes: a group that has one node left hands it on unchanged. The number of passes
is the height of the largest tree, logarithmic in its leaves, and it is the same for the tree over the groups.

Places come from one range sort over (group, key, leaf, place in the staged table), so a frequent group, key or row is
split, and groups may be as many as rows.

Defined cases: a null field enters a leaf as "-", any other value by its length in bytes, a colon and itself; a null
group is a group and stands first; null keys stand first in their group; rows that share a key stand in the order of
their leaves, and equal rows have equal leaves and proofs of their own places; the only leaf of a group is its subroot, and the only
subroot is the root; the proof of a lone leaf is the hash of nothing; an empty table gives an empty result; columns that
are not named as fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillrank.llm.common import ascii_lower
from quillrank.plans.ranks import global_row_number
from quillrank.plans.skew import spread_join
from quillrank.session import stage

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LINKS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf(fields: list[Column]) -> Column:
    """Hash of the fields, each with its length, so that no two rows give the same text."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _slots(prefix: str = "s") -> list[Column]:
    return [F.col(f"{prefix}{k}") for k in range(FANOUT)]


def parents(nodes: DataFrame, carry: dict[str, str] = {}) -> DataFrame:
    """One row per FANOUT neighbours of ``nodes`` (g, place, of, hash): their hashes in slots, and their own hash.

    ``of`` is the number of nodes of the group on their level. ``carry`` maps further columns of a node to the prefix of
    the slot columns that keep them.
    """
    slot = F.pmod("place", F.lit(FANOUT))
    kept = {"hash": "s", **carry}
    spread = [F.max(F.when(slot == k, F.col(c))).alias(f"{prefix}{k}") for c, prefix in kept.items() for k in range(FANOUT)]
    wide = nodes.groupBy("g", F.floor(F.col("place") / FANOUT).alias("up"), "of").agg(*spread)
    # concat_ws leaves out the empty slots of a short run.
    own = F.when(F.col("of") == 1, F.col("s0")).otherwise(digest(*_slots()))
    return wide.withColumnRenamed("up", "place").withColumn("hash", own)


def height(nodes: int) -> int:
    """Levels above ``nodes`` leaves."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FANOUT), levels + 1
    return levels


def climb(nodes: DataFrame, levels: int, carry: dict[str, str]) -> list[DataFrame]:
    """The staged rows of ``parents`` of every level, one level at least; only the lowest carries columns."""
    out: list[DataFrame] = []
    for _ in range(max(levels, 1)):
        out.append(stage(parents(nodes, {} if out else carry), "level"))
        nodes = out[-1].select("g", "place", F.ceil(F.col("of") / FANOUT).alias("of"), "hash")
    return out


def descend(levels: list[DataFrame], top: DataFrame, extra: list[str]) -> DataFrame:
    """Rows (hash, left, right, alone, links, extra columns, carried columns) of all leaves below ``levels``.

    ``top`` has (g, links, extra) for every group, ``links`` being the siblings that lead on from its last node. ``left``
    and ``right`` are the siblings of the leaf itself, ``links`` those of its ancestors.
    """
    rows = spread_join(levels[-1], top, "g", salt=F.col("place"))
    for lower in reversed(levels[:-1]):
        above = rows.select(
            "g", F.col("place").alias("__up"), F.array(*_slots()).alias("__run"), (F.col("of") == 1).alias("__alone"), "links", *extra
        )
        slot = F.pmod("place", F.lit(FANOUT)).cast("int")
        # array_join leaves out the empty slots as well.
        left, right = F.array_join(F.slice("__run", F.lit(1), slot), ""), F.array_join(F.slice("__run", slot + 2, F.lit(FANOUT)), "")
        entry = F.when(F.col("__alone"), F.array().cast(_LINKS)).otherwise(F.array(F.struct(left.alias("left"), right.alias("right"))))
        joined = lower.withColumn("__up", F.floor(F.col("place") / FANOUT)).join(above, ["g", "__up"])
        rows = joined.select(*lower.columns, F.concat(entry, "links").alias("links"), *extra)
    prefixes = sorted({c[:-1] for c in levels[0].columns if c.endswith("0")} - {"s"})

    def child(k: int) -> Column:
        others = _slots()
        around = {"hash": others[k], "left": F.concat_ws("", *others[:k]), "right": F.concat_ws("", *others[k + 1 :])}
        around |= {prefix: F.col(f"{prefix}{k}") for prefix in prefixes}
        return F.struct(*[c.alias(name) for name, c in around.items()])

    children = F.filter(F.array(*[child(k) for k in range(FANOUT)]), lambda c: c["hash"].isNotNull())
    spread = rows.select(F.explode(children).alias("__c"), (F.col("of") == 1).alias("alone"), "links", *extra)
    return spread.select("__c.*", "alone", "links", *extra)


def manifest(rows: DataFrame) -> DataFrame:
    """(key, leaf, changed, subroot, root, links) of all ``rows`` (group, key, leaf, changed).

    ``changed`` is another leaf that is to be tried in the place of the row's own, or null. ``links`` are the siblings
    that lead from the leaf to the root, one (left, right) pair for every hash on the way.
    """
    rows = stage(rows.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    first = [F.asc_nulls_first("group"), F.asc_nulls_first("key"), F.asc("leaf"), F.asc("tie")]
    ranked = global_row_number(rows, first, "rank")
    groups = stage(ranked.groupBy("group").agg(F.min("rank").alias("g"), F.count(F.lit(1)).alias("of")), "groups")
    nodes = spread_join(ranked, groups, "group", salt=F.col("tie"), nulls=True).select(
        "g", (F.col("rank") - F.col("g")).alias("place"), "of", F.col("leaf").alias("hash"), "key", "changed"
    )
    number, largest = groups.agg(F.count(F.lit(1)), F.max("of")).first()
    trees = climb(nodes, height(largest or 0), {"key": "key", "changed": "changed"})
    # Groups are in order of their first rank, so that their trees' ends are the leaves of one more tree.
    ends = global_row_number(trees[-1].select(F.col("g").alias("group"), "hash"), [F.asc("group")], "rank")
    ends = ends.select(F.lit(0).alias("g"), (F.col("rank") - 1).alias("place"), F.lit(number).cast("long").alias("of"), "hash", "group")
    upper = climb(ends, height(number), {"group": "group"})
    summit = upper[-1].select("g", F.array().cast(_LINKS).alias("links"), F.col("hash").alias("root"))
    subroots = _whole(descend(upper, summit, ["root"])).select(F.col("group").alias("g"), "links", F.col("hash").alias("subroot"), "root")
    leaves = _whole(descend(trees, subroots, ["subroot", "root"]))
    return leaves.select("key", F.col("hash").alias("leaf"), "changed", "subroot", "root", "links")


def _whole(rows: DataFrame) -> DataFrame:
    """``links`` begin with the siblings of the row itself, unless it was handed on."""
    own = F.array(F.struct("left", "right")).cast(_LINKS)
    return rows.withColumn("links", F.when(F.col("alone"), F.col("links")).otherwise(F.concat(own, "links")))


def proof(links: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(links, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def fold(start: Column, links: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(links, start, lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))


def tampered(df: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """(group, key, leaf, changed) of every row; where 3 divides the CRC of the key, ``changed`` has the text in lower case."""
    lowered = leaf([ascii_lower(F.col(f)) if f == text else F.col(f) for f in fields])
    hit = F.crc32(F.col(key).cast("string")) % 3 == 0
    return df.select(
        F.col(group).alias("group"), F.col(key).alias("key"), leaf([F.col(f) for f in fields]).alias("leaf"), F.when(hit, lowered).alias("changed")
    )


def verify(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Root and proof of every row of ``manifest``, and the root that its leaf, or the changed one, leads to."""
    folded = fold(F.coalesce("changed", "leaf"), F.col("links"))
    out = rows.select(F.col("key").alias(key), "leaf", "subroot", "root", proof(F.col("links")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
