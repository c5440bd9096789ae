"""Token ids as canonical length-limited Huffman code, in blocks that can be read alone.

A folder in the shared file system holds two tables, both written by Spark: ``codes`` (id, length), from which the
canonical codes follow, and ``blocks``, in ascending order of doc_id over (part, block). A block holds whole documents
up to about BLOCK ids: their keys and counts, where the first starts in its part, the bits, and checkpoints, the bit
distances between every STEP-th id. The decoder walks all stretches between checkpoints at once, one table lookup of
MAX_BITS bits per id.

Lengths come from global counts: tasks count their ids, counts are summed, and the lengths are found from one row per
id in use, which the vocabulary bounds, by the package-merge method. Only (key, ids) rows are moved, once, to sort them.

Defined cases: a null text has the end id alone; a null key sorts first; rows that share a key stand in the order of
their ids; a single id in use has a code of one bit; an empty table gives empty tables; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quillrank.llm.common import documents
from quillrank.llm.tokens import encode_all
from quillrank.plans.skew import spread_join
from quillrank.session import run_dir

END = 2
MAX_BITS = 20
BLOCK, STEP = 1 << 17, 64
BLOCKS = "part long, block long, start long, doc_ids array<long>, n_tokens array<long>, n_ids long, bits binary, checkpoints binary"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths, none above ``limit``, for positive counts, by package-merge."""
    n = len(counts)
    if n < 2:
        return np.ones(n, dtype=np.int64)
    limit = max(limit, (n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    level, kinds = leaves, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        half = len(level) // 2
        packages = level[0 : 2 * half : 2] + level[1 : 2 * half : 2]
        both = np.concatenate([leaves, packages])
        sort = np.argsort(both, kind="stable")
        level = both[sort]
        kinds.append(sort < n)
    # From the last list back: a leaf taken is one more bit, a package taken is two items of the list before.
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for kind in reversed(kinds):
        used = int(kind[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical codes: shorter first, then smaller ids, counted upwards."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.width = int(self.lengths.max(initial=1))
        spans = np.int64(1) << (self.width - self.lengths)
        self.codes = (np.cumsum(spans) - spans) >> (self.width - self.lengths)
        self.spans = spans

    def writer(self) -> tuple[np.ndarray, np.ndarray]:
        """Code and length by id."""
        size = int(self.ids.max(initial=0)) + 1
        code, length = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.uint64)
        code[self.ids], length[self.ids] = self.codes.astype(np.uint64), self.lengths.astype(np.uint64)
        return code, length

    def reader(self) -> np.ndarray:
        """Id and length (lowest five bits) by the next ``width`` bits."""
        table = np.zeros(1 << self.width, dtype=np.int64)
        used = int(self.spans.sum())
        table[:used] = np.repeat(self.ids << 5 | self.lengths, self.spans)
        return table


def encode(ids: np.ndarray, code: np.ndarray, length: np.ndarray) -> tuple[bytes, bytes]:
    """Bits, most significant first, and checkpoints."""
    bits = length[ids]
    end = np.cumsum(bits)
    at = end - bits
    # A code lies in at most two 32-bit words; sums of disjoint bits are exact in a double.
    shifted = code[ids] << (np.uint64(64) - bits - (at & np.uint64(31)))
    word = (at >> np.uint64(5)).astype(np.int64)
    size = (int(end[-1]) >> 5) + 2 if len(ids) else 0
    high = np.bincount(word, weights=shifted >> np.uint64(32), minlength=size)
    low = np.bincount(word + 1, weights=shifted & np.uint64(0xFFFFFFFF), minlength=size)
    steps = np.diff(at[::STEP], prepend=np.uint64(0))
    return (high + low).astype(np.uint64).astype(">u4").tobytes(), steps.astype("<u2").tobytes()


def decode(bits: bytes, checkpoints: bytes, n: int, table: np.ndarray) -> np.ndarray:
    width = len(table).bit_length() - 1
    data = np.frombuffer(bits + bytes(8 + STEP * 4), dtype=np.uint8).astype(np.int64)
    # The next 32 bits from each byte on, looked up once for every byte and not for every id.
    next_bits = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    at = np.cumsum(np.frombuffer(checkpoints, dtype="<u2").astype(np.int64))
    out = np.empty((len(at), STEP), dtype=np.int64)
    mask = (1 << width) - 1
    for k in range(STEP):
        entry = table[next_bits[at >> 3] >> (32 - width - (at & 7)) & mask]
        out[:, k] = entry >> 5
        at = at + (entry & 31)
    return out.reshape(-1)[:n]


def narrow(ids: bytes) -> tuple[int, bytes]:
    """Bytes per id, and the ids in so many: two where that is enough, else the four they had."""
    values = np.frombuffer(ids, dtype="<u4")
    return (2, values.astype("<u2").tobytes()) if values.max(initial=0) < 1 << 16 else (4, ids)


def wide(width: int, ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, dtype=f"<u{width}")


TOKENS = "doc_id long, width int, ids binary"


def tokenized(df: DataFrame, tokenizer: str, end: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A written table of TOKENS: each document's ids and the end id, as little-endian numbers of ``width`` bytes."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [narrow(x) for x in encode_all(tokenizer, batch.column(1).to_pylist(), end)]
            columns = [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "width", "ids"])

    path = run_dir(df.sparkSession, "ids")
    documents(df, key, text).mapInArrow(ids, TOKENS).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(TOKENS).parquet(path)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        found = [wide(*x) for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        part = np.bincount(np.concatenate(found or [np.zeros(0, np.int64)]), minlength=len(total))
        part[: len(total)] += total
        total = part
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])


def write(tokens: DataFrame, path: str) -> None:
    """Write the tables ``codes`` and ``blocks`` of a table of TOKENS below ``path``."""
    spark = tokens.sparkSession
    counts = tokens.select("width", "ids").mapInArrow(_counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    lengths = code_lengths(found["n"].to_numpy(dtype=np.int64))
    ids = found["id"].to_numpy(dtype=np.int64)
    rows = list(zip(ids.tolist(), lengths.tolist()))
    spark.createDataFrame(rows, "id long, length long").coalesce(1).write.parquet(os.path.join(path, "codes"))
    shared = spark.sparkContext.broadcast(Code(ids, lengths).writer())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, length = shared.value
        part = TaskContext.get().partitionId()
        start = number = 0
        docs, texts, held = [], [], 0

        def block() -> pa.RecordBatch:
            sizes = [len(t) for t in texts]
            bits, checkpoints = encode(np.concatenate(texts), code, length)
            values = [[part], [number], [start], [docs], [sizes], [held], [bits], [checkpoints]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
            names = ["part", "block", "start", "doc_ids", "n_tokens", "n_ids", "bits", "checkpoints"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for doc, size, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                docs.append(doc)
                texts.append(wide(size, ids))
                held += len(texts[-1])
                if held >= BLOCK:
                    yield block()
                    start, number = start + held, number + 1
                    docs, texts, held = [], [], 0
        if docs:
            yield block()

    ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "uncompressed").parquet(os.path.join(path, "blocks"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of the files, with ``start`` over all documents."""
    codes = spark.read.schema("id long, length long").parquet(os.path.join(path, "codes")).toPandas()
    code = Code(codes["id"].to_numpy(dtype=np.int64), codes["length"].to_numpy(dtype=np.int64))
    shared = spark.sparkContext.broadcast(code.reader())
    blocks = spark.read.schema(BLOCKS).parquet(os.path.join(path, "blocks"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written part
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def documents_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part, start, docs, sizes, n, bits, checkpoints in zip(*(batch.column(i).to_pylist() for i in range(7))):
                ids = decode(bits, checkpoints, n, table).astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                at = ends - sizes
                texts = [ids[4 * a : 4 * b] for a, b in zip(at.tolist(), ends.tolist())]
                columns = [[part] * len(docs), docs, at + start, sizes, texts]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "doc_id", "at", "n_tokens", "ids"])

    wanted = blocks.select("part", "start", "doc_ids", "n_tokens", "n_ids", "bits", "checkpoints")
    found = wanted.mapInArrow(documents_of, "part long, doc_id long, at long, n_tokens long, ids binary")
    placed = spread_join(found, starts, "part", salt=F.col("at"))
    return placed.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids")
