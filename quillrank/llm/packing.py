"""Best-fit packing of token pieces into sequences of a fixed capacity, planned on counts of lengths.

Only lengths decide where a piece goes, and there are at most CAPACITY of them. So the plan is made from the number of
pieces per length, whatever the corpus: large-item matching first (pieces above a third of the capacity fit at most twice
into a sequence; the longest is paired with the longest that fits beside it), then the smaller ones, longest first, into
the tightest gap that holds them. Sequences with the same gap are handled as one group. The plan is a list of ranges of
ranks: pieces of a length numbered r to r + n go to these sequences at this offset.

The rank of a piece among all pieces of its length is its place inside its task's chunk plus the counts of earlier
chunks, a running sum over (length, chunk). No piece is moved for it: texts and ids stay where they were read.

Defined cases: a null text is empty and has the end id alone; only documents above the capacity are cut, from the back,
so that their first piece may be shorter; rows that share a key are packed each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from quillrank.llm.common import documents
from quillrank.llm.tokens import encode_all
from quillrank.plans.skew import spread_join
from quillrank.session import run_dir, stage

CAPACITY = 2048
END = 0
PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, chunk long, place long"


def cuts(n: int, capacity: int) -> list[int]:
    """Bounds of the pieces of a document of n tokens."""
    first = n - (n - 1) // capacity * capacity
    return [0, *range(first, n + 1, capacity)]


def pieces(df: DataFrame, tokenizer: str, end: int = END, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A written table of PIECES: ids of every document with the end id, cut where they exceed the capacity.

    ``chunk`` and ``place`` number the pieces of each length in the order in which the task met them. A task that is run
    again meets the same rows, and the table is written once.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, dtype=np.int64).tolist()
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode_all(tokenizer, batch.column(1).to_pylist(), end)):
                at = cuts(len(ids) // 4, capacity)
                for k, (a, b) in enumerate(zip(at, at[1:])):
                    part = ids[4 * a : 4 * b]
                    rows.append((doc, k, a, b - a, part, zlib.crc32(part), chunk, met[b - a]))
                    met[b - a] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "chunk", "place"],
            )

    path = run_dir(df.sparkSession, "pieces")
    documents(df, key, text).mapInArrow(cut, PIECES).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(PIECES).parquet(path)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, number, copies side by side, first sequence, offset) that place every piece.

    ``counts`` has the number of pieces by length, so work and result do not grow with the corpus.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    out: list[tuple[int, ...]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    made = 0

    def put(size: int, number: int, copies: int, sequence: int, offset: int) -> None:
        out.append((size, used[size], number, copies, sequence, offset))
        used[size] += number
        left[size] -= number

    def leave(gap: int, sequence: int, bins: int) -> None:
        if gap and bins:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((sequence, bins))

    large = sorted(s for s in left if 3 * s > capacity)
    for size in reversed(large):
        while left[size]:
            fit = next((x for x in reversed(large[: bisect.bisect_right(large, min(size, capacity - size))]) if left[x] > (x == size)), None)
            if fit is None:
                bins = left[size]
                put(size, bins, 1, made, 0)
                leave(capacity - size, made, bins)
            elif fit == size:
                bins = left[size] // 2
                put(size, 2 * bins, 2, made, 0)
                leave(capacity - 2 * size, made, bins)
            else:
                bins = min(left[size], left[fit])
                put(size, bins, 1, made, 0)
                put(fit, bins, 1, made, size)
                leave(capacity - size - fit, made, bins)
            made += bins
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            k = bisect.bisect_left(order, size)
            if k < len(order):
                gap = order[k]
                sequence, bins = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(k)
            else:
                gap, copies = capacity, capacity // size
                sequence, bins = made, -(-left[size] // copies)
                made += bins
            copies = gap // size
            full = min(bins, left[size] // copies)
            if full:
                put(size, full * copies, copies, sequence, capacity - gap)
                leave(gap - copies * size, sequence, full)
            if full < bins and left[size]:
                rest = left[size]
                put(size, rest, rest, sequence + full, capacity - gap)
                leave(gap - rest * size, sequence + full, 1)
                full += 1
            leave(gap, sequence + full, bins - full)
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 6)


def best_fit(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``table`` (with length, chunk and place, as ``pieces`` writes it) with sequence_id and offset of every piece."""
    counts = stage(table.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n")), "lengths")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most one row per possible length
    planned = plan({r["length"]: r["n"] for r in totals}, capacity)
    # Ranks as one ascending number: length, then rank.
    starts = planned[:, 0].astype(np.float64) * 2.0**40 + planned[:, 1] if len(planned) else np.empty(0)
    shared = table.sparkSession.sparkContext.broadcast((planned, starts))
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    both = F.struct("length", "chunk")
    rows = spread_join(
        table.withColumn("__at", both), offsets.select(both.alias("__at"), "before"), "__at", salt=F.col("place")
    ).withColumn("__rank", F.col("before") + F.col("place"))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def where(length, rank):
        import pandas as pd

        rows, first = shared.value
        size, number = length.to_numpy(), rank.to_numpy()
        found = rows[np.searchsorted(first, size.astype(np.float64) * 2.0**40 + number, side="right") - 1]
        inside = number - found[:, 1]
        return pd.DataFrame({"sequence_id": found[:, 4] + inside // found[:, 3], "offset": found[:, 5] + inside % found[:, 3] * size})

    return rows.withColumn("__to", where("length", "__rank")).select(*table.columns, "__to.sequence_id", "__to.offset")


def sequences(table: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets): the packed sequences themselves; each holds at most the capacity."""
    keys = ["length", "chunk", "place"]
    joined = table.select(*keys, "ids").join(placed.select(*keys, "doc_id", "sequence_id", "offset"), keys)
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    grouped = joined.groupBy("sequence_id").agg(parts.alias("p"))
    whole = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return grouped.select("sequence_id", whole.alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))


def digest(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
