"""Benchmark decontamination by latent semantic retrieval.

1. Words (lower case, letters and digits) of all documents are hashed once and stored. Document frequencies of hashed
   terms over blocks of STEP words give the inverse frequencies.
2. A randomised SVD of the TF-IDF passages (blocks) of the whole corpus in one pass: with Y = A W for a random W, every
   task sums Y'Y and Y'A over its passages; partial sums are added up in a tree of bounded groups. From both, the right
   singular vectors of the projection of A on the range of Y follow on the driver, in matrices of fixed size.
3. Windows of WIDTHS words of the texts, folded into the latent space, meet the windows of the benchmark items (a stated
   query set, in blocks of ITEMS) as matrix products per batch. An item has windows of the largest width that it fills
   (or fills but for a fifth); a shorter one than the largest width is looked for whole in windows of that width as well, for words that stand further
   apart. Pairs with a cosine of NEAR or more (less for items that fill a window in part) are candidates, if a share of
   COMMON of the different words of the item's window stands in the text's window.
4. A candidate aligns an item with a place in the text. The longest common subsequence of the item's words and the words
   around that place must reach STRONG of the item, or WEAK of it while the answer, the last third of the item, is there
   at least half. Word order counts and changed, added or lost words do not hide a paraphrase.

Windows of items start every quarter of their width, those of texts every half, so a passage of some length meets a window that
is an eighth of the width off at most, and one no longer than a window is a quarter off. The words of all documents are read three times and never shuffled.

Defined cases: null and blank texts match nothing; items without words match nothing; texts and items shorter than a
window are one window; items that repeat are all reported; rows that share a key are judged one by one; an empty
benchmark leaves all documents clean; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from quillrank.llm.common import documents
from quillrank.session import run_dir, stage

TERMS = 1 << 14
RANK, OVERSAMPLING = 40, 8
STEP = 16
FINE = 4
WIDTHS = (4, 8, 16, 32)
NEAR = {4: 0.35, 8: 0.35, 16: 0.4, 32: 0.45}
COMMON = 0.4
FILLED = 1.25
STRONG, WEAK, ANSWER = 0.75, 0.6, 0.5
ITEMS = 2000
PART = 1 << 15
BITS = 512
FAN_IN = 16
PIECE = 8
ONES = np.ones(BITS // 64, dtype=np.uint8)
HITS = "array<struct<item_id:long,start:long,length:long,cosine:double,overlap:double>>"


def hashed(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.hash(w))


def _places(first: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Runs of at most ``width`` places as lines of a matrix; -1 stands beyond the end of a run."""
    k = np.arange(width)
    return np.where(k < sizes[:, None], first[:, None] + k, -1)


def _summed(table: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """The sum of the rows of ``table`` that each line names, some lines at a time; -1 names the last row, which is zero."""
    out = np.empty((len(lines), table.shape[1]), dtype=np.float32)
    for k in range(0, len(lines), 1024):
        part = table[lines[k : k + 1024, 0]]
        for column in lines[k : k + 1024, 1:].T:
            part += table[column]
        out[k : k + 1024] = part
    return out


def _with_zero(table: np.ndarray) -> np.ndarray:
    return np.append(table, np.zeros((1, table.shape[1]), dtype=np.float32), axis=0).astype(np.float32)


class Blocks:
    """The words of a batch of texts, and its blocks of ``step`` words; no block spans two texts."""

    def __init__(self, column: pa.Array, step: int = STEP):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        offsets = column.offsets.to_numpy().astype(np.int64)
        self.words = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64) & 0xFFFFFFFF
        self.starts, self.sizes = offsets[:-1] - offsets[0], np.diff(offsets)
        self.terms = self.words % TERMS
        per_text = -(-self.sizes // step)
        self.owner = np.repeat(np.arange(len(self.sizes)), per_text)
        self.number = np.arange(len(self.owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        self.first = self.starts[self.owner] + self.number * step
        self.filled = np.minimum(self.sizes[self.owner] - self.number * step, step)
        self.step = step

    def lines(self, low: int = 0, high: int | None = None) -> np.ndarray:
        """The terms of the blocks from ``low`` on, a block a line; -1 fills a short one."""
        return np.append(self.terms, -1)[_places(self.first[low:high], self.filled[low:high], self.step)]

    def sums(self, table: np.ndarray, low: int = 0, high: int | None = None) -> np.ndarray:
        """The sum of a row of ``table`` (the last one is zero) per word, for the blocks from ``low`` on."""
        return _summed(table, self.lines(low, high))

    def of_words(self) -> np.ndarray:
        """The block of every word."""
        return np.repeat(np.arange(len(self.first)), self.filled)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(TERMS + 1, dtype=np.int64)
    for batch in batches:
        b = Blocks(batch.column(1))
        # TERMS, the largest number, fills a short block.
        terms = np.sort(np.where((lines := b.lines()) < 0, TERMS, lines).astype(np.uint16), axis=1)
        new = terms < TERMS
        new[:, 1:] &= terms[:, 1:] != terms[:, :-1]
        total[:TERMS] += np.bincount(terms[new], minlength=TERMS)
        total[TERMS] += len(b.first)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(total)], ["term", "n"])


def _moments(idf: np.ndarray, random: np.ndarray):
    """Per task: Y'A over the terms and, below it, Y'Y, as one array of 32-bit floats."""
    table = _with_zero(idf[:, None] * random)
    width = random.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TERMS + width, width), dtype=np.float32)
        weight = idf.astype(np.float32)
        for batch in batches:
            b = Blocks(batch.column(1))
            if not len(b.words):
                continue
            y = b.sums(table)
            total[TERMS:] += y.T @ y
            order = np.argsort(b.terms.astype(np.uint16), kind="stable")
            block, term = b.of_words()[order], b.terms[order]
            y = _with_zero(y)
            for k in range(0, len(order), 1 << 18):
                t = term[k : k + (1 << 18)]
                at = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
                # The words of a term are summed in pieces of PIECE and then piece by piece.
                size = np.diff(np.append(at, len(t)))
                pieces = -(-size // PIECE)
                start = np.cumsum(pieces) - pieces
                number = np.arange(pieces.sum()) - np.repeat(start, pieces)
                places = _places(np.repeat(at, pieces) + number * PIECE, np.repeat(size, pieces) - number * PIECE, PIECE)
                sums = _summed(y, np.append(block[k : k + (1 << 18)], -1)[places])
                total[t[at]] += np.add.reduceat(sums, start, axis=0) * weight[t[at], None]
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.astype("<f4").tobytes()], pa.binary())],
            ["g", "m"],
        )

    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(m, dtype="<f4").astype(float) for m in table.column("m").to_pylist())
    return pa.table({"g": table.column("g").slice(0, 1), "m": pa.array([total.astype("<f4").tobytes()], pa.binary())})


def singular_terms(words: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Term rows that fold a bag of words into the latent space: idf * V / S, of RANK columns at most."""
    width = RANK + OVERSAMPLING
    random = np.random.default_rng(0).normal(size=(TERMS, width))
    sums = stage(words.mapInArrow(_moments(idf, random), "g long, m binary"), "moments")
    groups = (sums.agg(F.max("g")).first()[0] or 0) + 1
    while groups > 1:
        groups = -(-groups // FAN_IN)
        near = sums.withColumn("g", F.floor(F.col("g") / FAN_IN).cast("long"))
        sums = stage(near.groupBy("g").applyInArrow(_added, "g long, m binary"), "moments")
    row = sums.first()
    if row is None:
        return np.zeros((TERMS, 1), dtype=np.float32)
    total = np.frombuffer(row["m"], dtype="<f4").astype(float).reshape(TERMS + width, width)
    projected, gram = total[:TERMS], total[TERMS:]
    # Y = Q R with R'R = Y'Y, so Q'A = R'^-1 (Y'A); directions without weight are left out.
    values, vectors = np.linalg.eigh(gram)
    some = values > max(values.max(), 1e-9) * 1e-7
    small = (projected @ vectors[:, some]) / np.sqrt(values[some])
    v, s, _ = np.linalg.svd(small, full_matrices=False)
    rank = min(RANK, int((s > 1e-6 * max(s.max(initial=0), 1e-9)).sum()))
    return (idf[:, None] * v[:, :rank] / np.maximum(s[:rank], 1e-9) if rank else np.zeros((TERMS, 1))).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def bitmaps(words: np.ndarray) -> np.ndarray:
    """A bitmap of BITS bits for each row of word hashes; -1 stands for no word."""
    out = np.zeros((len(words), BITS // 64), dtype=np.uint64)
    row = np.arange(len(words))
    for w in words.T:
        bit = (w % BITS).astype(np.uint64)
        out[row, bit >> np.uint64(6)] |= np.where(w >= 0, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0))
    return out


class Item:
    """An item's words as bit masks for the subsequence, whole and its last third."""

    def __init__(self, item_id: int, words: np.ndarray):
        self.item_id, self.n, self.words = item_id, len(words), words
        tail = words[self.n - max(self.n // 3, 1) :]
        self.parts = [self.masks(words), self.masks(tail)]

    @staticmethod
    def masks(words: np.ndarray) -> tuple[int, dict[int, int]]:
        out: dict[int, int] = {}
        for k, w in enumerate(words.tolist()):
            out[w] = out.get(w, 0) | 1 << k
        return len(words), out

    def share(self, part: int, region: list[int]) -> float:
        """Length of the longest common subsequence over the length of the part, a machine word of bits at a time."""
        n, masks = self.parts[part]
        full = (1 << n) - 1
        v = full
        for mask in filter(None, map(masks.get, region)):
            u = v & mask
            v = ((v + u) | (v - u)) & full
        return (n - v.bit_count()) / n

    def found(self, region: list[int]) -> float:
        """The overlap, or 0 where it does not suffice."""
        overlap = self.share(0, region)
        return overlap if overlap >= STRONG or (overlap >= WEAK and self.share(1, region) >= ANSWER) else 0.0


class Windows:
    """The windows of one width of all items: unit rows in the latent space, the words as bitmaps, item and offset of each."""

    def __init__(self, width: int, items: list[Item], folding: np.ndarray):
        self.width, self.item, self.offset, rows, words = width, [], [], [], []
        for k, item in enumerate(items):
            own = max([w for w in WIDTHS if w <= FILLED * item.n], default=WIDTHS[0])
            if width != own and width != WIDTHS[-1]:
                continue
            last = max(item.n - width, 0)
            for o in sorted({*range(0, last + 1, max(width // 4, 1)), last}):
                part = item.words[o : o + width]
                rows.append(folding[part % TERMS].sum(axis=0))
                words.append(np.pad(part, (0, width - len(part)), constant_values=-1))
                self.item.append(k)
                self.offset.append(o)
        self.matrix = _unit(np.array(rows, dtype=np.float32).reshape(len(rows), folding.shape[1]))
        self.bits = bitmaps(np.array(words, dtype=np.int64).reshape(len(rows), width))
        self.least = COMMON * np.bitwise_count(self.bits).sum(axis=1)
        # A window that an item fills in part only is that much less like the item.
        filled = np.array([min(items[k].n, width) for k in self.item])
        self.near = (NEAR[width] * np.sqrt(filled / width)).astype(np.float32)

    def candidates(self, b: Blocks, blocks: np.ndarray, sums: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(block, window, cosine) of the text windows, which start at ``blocks`` and have these sums."""
        for k in range(0, len(blocks), 2048):
            at = blocks[k : k + 2048]
            cosine = _unit(sums[k : k + 2048]) @ self.matrix.T
            flat = np.flatnonzero((cosine >= self.near).ravel())
            if not len(flat):
                continue
            r, q = np.divmod(flat, len(self.near))
            new = np.append(True, r[1:] != r[:-1])
            rows, where = r[new], np.cumsum(new) - 1
            place = b.first[at[rows]][:, None] + np.arange(self.width)
            end = (b.starts + b.sizes)[b.owner[at[rows]]][:, None]
            texts = bitmaps(np.where(place < end, b.words[np.minimum(place, len(b.words) - 1)], -1))
            for j in range(0, len(r), 1 << 16):
                part = slice(j, j + (1 << 16))
                # No more bits than a window has words, so a byte holds their number.
                both = texts.take(where[part], axis=0)
                both &= self.bits.take(q[part], axis=0)
                ok = np.bitwise_count(both) @ ONES >= self.least[q[part]]
                rr, qq = r[part][ok], q[part][ok]
                yield from zip(at[rr].tolist(), qq.tolist(), cosine[rr, qq].tolist())


class Query:
    """Items with their windows in the latent space."""

    def __init__(self, items: list[tuple[int, list[int]]], folding: np.ndarray):
        self.folding = _with_zero(folding)
        self.items = [Item(i, np.array(words, dtype=np.int64) & 0xFFFFFFFF) for i, words in items if len(words)]
        self.windows = [w for w in (Windows(width, self.items, folding) for width in WIDTHS) if len(w.matrix)]
        # Text windows are made of blocks of half the smallest width in use.
        self.fine = max(self.windows[0].width // 2, FINE) if self.windows else FINE

    def _candidates(self, b: Blocks) -> Iterator[tuple[int, int, int, float]]:
        """(text, item, place of the item in the text, cosine), some blocks at a time."""
        more = WIDTHS[-1] // self.fine
        for low in range(0, len(b.first), PART):
            sums, width = b.sums(self.folding, low, low + PART + more), self.fine
            owner = b.owner[low : low + len(sums)]
            blocks = np.arange(low, min(low + PART, len(b.first)))
            number, size = b.number[blocks], b.sizes[b.owner[blocks]]
            for windows in self.windows:
                while width < windows.width:  # two windows of half the width, unless the text ends before
                    half = width // self.fine
                    wide = sums.copy()
                    wide[:-half] += sums[half:] * (owner[half:] == owner[:-half])[:, None]
                    sums, width = wide, 2 * width
                # Every half of a width, and no window that starts late only to end with the text.
                late = number * self.fine + width // 2 > size
                use = (number % max(width // 2 // self.fine, 1) == 0) & ((number == 0) | ~late)
                for block, q, cosine in windows.candidates(b, blocks[use], sums[: len(blocks)][use]):
                    yield int(b.owner[block]), windows.item[q], int(b.number[block]) * self.fine - windows.offset[q], cosine

    def hits(self, column: pa.Array) -> list[list[dict]]:
        b = Blocks(column, self.fine)
        out: list[dict[int, dict]] = [{} for _ in b.sizes]
        seen = set()
        for text, item, place, cosine in self._candidates(b) if len(b.words) else ():
            size, known, at = int(b.sizes[text]), self.items[item], int(b.starts[text])
            best = out[text].get(item, {}).get("overlap", 0.0)
            if best == 1.0 or (text, item, place // FINE) in seen:
                continue
            seen.add((text, item, place // FINE))
            start, end = max(place - STEP, 0), max(min(place + known.n + STEP, size), 0)
            overlap = known.found(b.words[at + start : at + end].tolist())
            if overlap > best:
                out[text][item] = {"item_id": known.item_id, "start": start, "length": end - start, "cosine": cosine, "overlap": overlap}
        return [[found[i] for i in sorted(found)] for found in out]


def contaminated(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, contaminated, n_items and hits (item, place in words, cosine, overlap) of every document.

    Writes the hashed words below the shared folder and runs jobs while it builds its result.
    """
    spark = df.sparkSession
    path = run_dir(spark, "hashed")
    schema = "doc_id long, words array<int>"
    docs = documents(df, key, text).select("doc_id", hashed(F.col("text")).alias("words"))
    docs.write.option("compression", "zstd").parquet(path)
    words = spark.read.schema(schema).parquet(path)
    counts = words.mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(TERMS + 1)
    for r in counts:
        n[r["term"]] = r["n"]
    idf = np.log1p(n[TERMS] / np.maximum(n[:TERMS], 1.0))
    folding = singular_terms(words, idf)

    asked = stage(benchmark.select(F.col(item).cast("long").alias("item_id"), hashed(F.coalesce(item_text, F.lit(""))).alias("words")), "items")
    ordered = asked.select("item_id", "words").orderBy("item_id", "words")
    count = asked.count()
    found = None
    for k in range(0, max(count, 1), ITEMS):
        block = ordered.offset(k).limit(ITEMS).collect()  # at most ITEMS items
        shared = spark.sparkContext.broadcast(Query([(r["item_id"], r["words"]) for r in block], folding))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("cosine", pa.float64()), ("overlap", pa.float64())]))
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.hits(batch.column(1)), kind)], ["doc_id", "hits"])

        part = words.mapInArrow(search, f"doc_id long, hits {HITS}")
        found = part if found is None else found.union(part)
    if count > ITEMS:
        found = found.groupBy("doc_id").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    size = F.size("hits").cast("long")
    return found.select("doc_id", (size > 0).alias("contaminated"), size.alias("n_items"), F.array_sort("hits").alias("hits"))
