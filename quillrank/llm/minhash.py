"""Near-duplicate documents: MinHash bands for candidates, odd sketches to weed them out, full sets to confirm.

1. One pass makes, per document, the distinct five-word shingles, a 128-bit key of that set, SAMPLES MinHash values
   folded into band keys, and an odd sketch: a bitmap in which every (sample, value) flips one bit. The XOR of two
   sketches has few ones where the sets are alike, and its population count estimates high similarities closely.
2. Documents with equal sets form a class; only one representative goes on, so copies are never paired.
3. Inside each band bucket the representatives are not paired with each other. The member with the most band partners
   becomes the pivot and is compared with all others: a group of near copies is linked through the text they were
   copied from, with work linear in the group. Sketches refuse poor candidates, then the sets decide.
4. After components are known, members of one bucket that lie in different components are the only ones left to
   compare. Shingles that no other of them has bound every overlap from above, which ends the search for texts that were
   changed too much to link with anything. The others get further pivots for a few rounds, and then all their
   cross-component pairs, with that bound and the sketch test inside the join. So a link that
   any band proposes is lost with SKETCH_LOSS at most, and pairs inside a component are never listed.

With 28 bands of 5 samples a pair at the limit of 0.85 is proposed with probability 1 - 8e-8, one at 0.80 with 1 - 2e-5. The sketch test
refuses at most SKETCH_LOSS of the pairs at the limit, by the exact distribution of ones, and fewer of those above it.

Defined cases: null and blank texts have an empty set and link with nothing; texts with fewer words than a shingle have
one shingle, the whole sequence; keys should be unique: rows that share one are one node, compared by the greatest of
their texts' word arrays, and each gets a result; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillrank.llm.common import ascii_lower, documents, words
from quillrank.llm.components import connected
from quillrank.plans.skew import spread_join
from quillrank.session import stage

WORDS = 5
PERCENT = 85
BANDS, BAND_ROWS = 28, 5
SAMPLES = BANDS * BAND_ROWS
SKETCH_BITS = 256
SKETCH_LOSS = 1e-7
PIVOT_ROUNDS = 3
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _multipliers(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _GOLD + np.uint64(seed))


def shingle_sets(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts of a batch, text after text and sorted, and how many each text has.

    ``values`` holds the word hashes of all texts, ``starts`` and ``sizes`` where each text lies in it.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(owner)) - np.repeat(starts, sizes)
    left = np.repeat(sizes, sizes) - at
    total = np.zeros(len(values), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            shifted = np.zeros_like(values)
            shifted[: len(values) - k] = values[k:]
            total = np.where(left > k, mixed(total * _GOLD + shifted), total)
    # One for each place with a whole window, or the first place of a short text.
    use = (left >= WORDS) | ((np.repeat(sizes, sizes) < WORDS) & (at == 0))
    owner, hashes = owner[use], total[use]
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    first = np.ones(len(owner), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[first], np.bincount(owner[first], minlength=len(sizes))


def _batch_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return flat, offsets[:-1] - offsets[0], np.diff(offsets)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_shingles, key1, key2, bands (one key each) and sketch (64 bits each) from doc_id and word hashes."""
    scale = _multipliers(SAMPLES, 1).astype(np.uint32) | np.uint32(1)
    shift = _multipliers(SAMPLES, 2).astype(np.uint32)
    salt = _multipliers(SAMPLES, 3)
    for batch in batches:
        hashes, n = shingle_sets(*_batch_words(batch.column(1)))
        full = np.flatnonzero(n)
        starts = (np.cumsum(n) - n)[full]
        bands = np.zeros((len(n), BANDS), dtype=np.uint64)
        sketch = np.zeros((len(n), SKETCH_BITS // 64), dtype=np.uint64)
        key1, key2 = np.zeros(len(n), dtype=np.uint64), np.zeros(len(n), dtype=np.uint64)
        if len(full):
            with np.errstate(over="ignore"):
                key1[full] = np.add.reduceat(mixed(hashes), starts)
                key2[full] = np.add.reduceat(mixed(hashes ^ _GOLD), starts)
                short = (hashes >> np.uint64(32)).astype(np.uint32)
                band = np.zeros(len(full), dtype=np.uint64)
                for s in range(SAMPLES):
                    least = np.minimum.reduceat(short * scale[s] + shift[s], starts).astype(np.uint64)
                    bit = mixed(least + salt[s]) % np.uint64(SKETCH_BITS)
                    sketch[full, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
                    band = mixed(band * _GOLD + least + np.uint64(s + 1))
                    if s % BAND_ROWS == BAND_ROWS - 1:
                        bands[full, s // BAND_ROWS] = band
                        band = np.zeros(len(full), dtype=np.uint64)
        count = len(n)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n.astype(np.int64)),
                pa.array(key1.view(np.int64)),
                pa.array(key2.view(np.int64)),
                _lists(bands.reshape(-1), np.full(count, BANDS)),
                _lists(sketch.reshape(-1), np.full(count, SKETCH_BITS // 64)),
            ],
            ["doc_id", "n_shingles", "key1", "key2", "bands", "sketch"],
        )


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and the sorted shingle hashes."""
    for batch in batches:
        hashes, n = shingle_sets(*_batch_words(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists(hashes, n)], ["doc_id", "shingles"])


SIGNATURE = "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>, sketch array<long>"


def hashed_words(docs: DataFrame) -> DataFrame:
    tokens = words(ascii_lower(F.col("text")))
    return docs.select("doc_id", F.transform(tokens, lambda w: F.xxhash64(w)).alias("words"))


@cache
def sketch_limit(percent: int) -> int:
    """The least number of ones that two sketches at the limit exceed with a probability of SKETCH_LOSS at most.

    Each of the samples that differ flips two random bits, so both the number of flips and the bits that they hit vary.
    """
    differ = 1 - percent / 100
    moves = np.arange(SKETCH_BITS + 1) / SKETCH_BITS
    ones = np.eye(1, SKETCH_BITS + 1)[0]
    total = np.zeros(SKETCH_BITS + 1)
    for k in range(SAMPLES + 1):
        total += comb(SAMPLES, k) * differ**k * (1 - differ) ** (SAMPLES - k) * ones
        for _ in range(2):
            down, up = ones * moves, ones * (1 - moves)
            ones = np.append(down[1:], 0) + np.append(0, up[:-1])
    above = np.append(np.cumsum(total[::-1])[::-1][1:], 0)
    return int(np.argmax(above <= SKETCH_LOSS))


def sketch_allows(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """Whether the sketches differ by no more ones than a pair at the limit can."""
    differ = [F.bit_count(F.get(a, k).bitwiseXOR(F.get(b, k))) for k in range(SKETCH_BITS // 64)]
    return sum(differ[1:], differ[0]) <= sketch_limit(percent)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    used = spread_join(sets, ends, "doc_id", "left_semi", salt=F.col("doc_id"))
    left = used.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = used.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    size = F.size("sa") + F.size("sb")
    return pairs.join(left, "a").join(right, "b").filter(both * 100 >= (size - both) * percent).select("a", "b")


def shared_sizes(reps: DataFrame, sets: DataFrame) -> DataFrame:
    """(rep, n, s): size of each set, and how many of its shingles another set of ``reps`` has as well.

    No overlap with another set can be larger than s, so a set with s below the limit's share of n links with nothing, and two
    sets link only if both have at least percent / (100 + percent) of the sum of their sizes.
    """
    used = spread_join(sets, reps.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi", salt=F.col("doc_id"))
    single = used.select("doc_id", F.explode("shingles").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("doc_id").alias("rep"))
    alone = single.filter("k = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("alone"))
    sizes = used.select(F.col("doc_id").alias("rep"), F.size("shingles").alias("n"))
    return sizes.join(alone, "rep", "left").select("rep", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("s"))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their component, of the buckets that hold several components."""
    now = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    split = now.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    return stage(now.join(split.select("band"), "band"), "open")


def _pivot_pairs(members: DataFrame, tried: DataFrame | None, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of each bucket's pivot with the members of other components, and the pivots (band, rep).

    The pivot is the member with most partners over all bands that was not the pivot of this bucket before.
    """
    free = members if tried is None else members.join(tried, ["band", "rep"], "left_anti")
    order = F.struct("degree", (-F.col("rep")).alias("r"))
    best = free.groupBy("band").agg(F.max_by(F.struct("rep", "sketch", "component"), order).alias("p"))
    pivots = stage(best.select("band", F.col("p.rep").alias("pivot"), F.col("p.sketch").alias("other"), F.col("p.component").alias("at")), "pivots")
    near = members.join(pivots, "band").filter((F.col("component") != F.col("at")) & sketch_allows(F.col("sketch"), F.col("other"), percent))
    return near.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")), pivots.select("band", F.col("pivot").alias("rep"))


def _cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All pairs in different components that sizes and sketches allow, each in the smallest bucket that they share."""
    names = {"rep": "b", "component": "at", "sketch": "other", "n": "n2", "s": "s2", "bands": "bands2"}
    others = members.select("band", *[F.col(c).alias(name) for c, name in names.items()])
    enough = F.least("s", "s2") * (100 + percent) >= (F.col("n") + F.col("n2")) * percent
    across = (F.col("component") != F.col("at")) & (F.col("rep") < F.col("b")) & enough & sketch_allows(F.col("sketch"), F.col("other"), percent)
    here = F.array_min(F.array_intersect("bands", "bands2")) == F.col("band")
    return members.join(others, "band").filter(across & here).select(F.col("rep").alias("a"), "b")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id, component_id and kept.

    class_id is the smallest key with the same set, component_id the smallest key reachable over links, which join sets with
    a Jaccard similarity of ``percent`` or more in a hundred. kept marks the rows of that smallest key. Writes tables below the shared folder and runs jobs while it builds its result.
    """
    docs = hashed_words(documents(df, key, text))
    signed = stage(docs.mapInArrow(signatures, SIGNATURE), "signatures")
    if _repeats(signed):
        docs = docs.groupBy("doc_id").agg(F.max("words").alias("words"))
    some = signed.filter("n_shingles > 0")
    same = ["key1", "key2", "n_shingles"]
    classes = stage(some.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")
    classes = classes.withColumn("bands", F.transform("bands", lambda key, i: F.xxhash64(i, key)))
    banded = classes.select("rep", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    members = stage(banded.join(shared, "band"), "buckets")
    degree = members.groupBy("rep").agg(F.sum(F.col("k") - 1).alias("degree"))
    members = stage(members.drop("k").join(degree, "rep").join(classes.select("rep", "sketch"), "rep"), "members")
    wanted = degree.select(F.col("rep").alias("doc_id"))
    sets = spread_join(docs, wanted, "doc_id", "left_semi", salt=F.col("doc_id"))
    sets = stage(sets.mapInArrow(full_sets, "doc_id long, shingles array<long>"), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        return stage(confirmed(stage(pairs.distinct(), "pairs"), sets, percent), "checked")

    pairs, tried = _pivot_pairs(members.withColumn("component", F.col("rep")), None, percent)
    links = linked(pairs)
    labels = stage(connected(links), "labels")
    rest = _open(members, labels)
    sizes = shared_sizes(rest.select("rep").distinct(), sets).filter(F.col("s") * 100 >= F.col("n") * percent)
    members = stage(members.join(sizes, "rep"), "members")
    for turn in range(1, PIVOT_ROUNDS + 1):
        rest = _open(members, labels)
        if rest.isEmpty():
            break
        if turn < PIVOT_ROUNDS:
            pairs, used = _pivot_pairs(rest, tried, percent)
            tried = tried.union(used)
        else:
            pairs = _cross_pairs(rest.join(classes.select("rep", "bands"), "rep"), percent)
        more = linked(pairs)
        if not more.isEmpty():
            links = links.union(more)
            labels = stage(connected(links), "labels")

    placed = classes.select(*same, "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    rows = signed.select("doc_id", *same).join(placed, same, "left")
    own = F.coalesce("rep", "doc_id")
    return rows.select(
        "doc_id",
        "n_shingles",
        own.alias("class_id"),
        F.coalesce(F.col("component"), own).alias("component_id"),
        (F.col("doc_id") == F.coalesce(F.col("component"), own)).alias("kept"),
    )


def _repeats(signed: DataFrame) -> bool:
    """Whether a key has several rows."""
    return not signed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).isEmpty()
