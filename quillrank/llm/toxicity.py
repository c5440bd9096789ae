"""Toxicity: a factorization machine over hashed terms.

Terms are the distinct lower-case words of a text and the first PREFIX letters of longer ones, hashed to 2 ** BITS
slots. The score is the logistic of a bias, a weight per term, and the inner products of the factors of all pairs of
terms, so that a pair (an insult and the mention of a group, say) can count more than both terms alone, also where neither
counts alone. Every term of the sampled rows has factors. They start from small random numbers and from the directions in
which pairs of terms explain what weights alone leave (eigenvectors of the pairs' summed errors, kept if they are
stronger than with random signs); then weights, with an L1 penalty, and factors are learnt together. A part of the sampled
rows is kept back to decide how long; where factors do not lower the loss of those rows, the weights stay alone.

The model is fitted on at most ``sample`` labelled rows, those with the smallest hashes of their keys, in one task; its
size is bounded by the slots, and it is broadcast to score all documents in one scan. Only the text goes into a score.

Defined cases: null and empty texts have no terms and get the bias; labels may repeat, and one toxic label makes a
document toxic; null labels are left out; without labelled rows, or with one class only, the weights are zero and the
bias is the smoothed log odds; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillrank.llm.common import documents
from quillrank.session import stage

BITS, PREFIX = 18, 6
FACTORS = 8
SAMPLE = 20_000
EPOCHS, BATCH = 6, 256
RATE, L1 = 2.0, 6.0
FACTOR_EPOCHS, FACTOR_RATE, FACTOR_START, FACTOR_L2, FACTOR_G2 = 14, 0.3, 0.003, 0.01, 0.01
# The starting directions are looked for in this many rows.
ROUNDS, START_ROWS = 6, 4000
HELD, PATIENCE = 6, 2
# Margins are held within these bounds.
MARGIN = 30.0


def terms(text: Column) -> Column:
    """Distinct term slots of a text."""
    words = F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), "")
    slots = F.lit(1 << BITS)
    whole = F.transform(words, lambda w: F.pmod(F.xxhash64(w), slots).cast("int"))
    starts = F.transform(
        F.filter(words, lambda w: F.length(w) > PREFIX),
        lambda w: F.pmod(F.xxhash64(F.lit("^"), F.substring(w, 1, PREFIX)), slots).cast("int"),
    )
    return F.array_distinct(F.concat(whole, starts))


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column and the row of each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy().astype(np.int64))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)


class Machine:
    """Weights and factors over ``size`` terms; rows are given as (term, row) pairs in row order.

    The pairs of a row count over its number of terms, so that long texts have margins of the same size as short ones.
    """

    def __init__(self, size: int):
        self.bias, self.w = 0.0, np.zeros(size)
        self.v = np.zeros((size, FACTORS))

    def margins(self, term: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        out = self.bias + np.bincount(row, weights=self.w[term], minlength=n)
        if self.v.any():
            out += _pairs(self.v, term, row, n).sum(axis=1)
        return np.clip(out, -MARGIN, MARGIN)

    def chances(self, term: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(term, row, n)))

    def loss(self, term: np.ndarray, row: np.ndarray, y: np.ndarray) -> float:
        p = self.chances(term, row, len(y))
        return float(-np.log(np.where(y > 0, p, 1 - p)).mean())

    def fit(self, term: np.ndarray, row: np.ndarray, y: np.ndarray) -> None:
        """Learn from all rows for as many rounds as are best where every HELD-th row is kept back."""
        odds = (y.sum() + 1) / (len(y) - y.sum() + 1)
        self.bias = float(np.log(odds))
        held = np.arange(len(y)) % HELD == 0
        if not len(y) or y.min() == y.max():
            return
        rounds = 0
        if held.any() and not held.all() and y[~held].min() < y[~held].max():
            rounds = Machine(len(self.w))._rounds(term, row, y, held)
        for _ in self._learn(term, row, y, np.arange(len(y)), rounds):
            pass

    def _rounds(self, term: np.ndarray, row: np.ndarray, y: np.ndarray, held: np.ndarray) -> int:
        """After how many rounds with factors the loss of the held rows is lowest; 0 if the weights do better alone."""
        taught, test = np.flatnonzero(~held), np.flatnonzero(held)
        self.bias = float(np.log((y[taught].sum() + 1) / (len(taught) - y[taught].sum() + 1)))
        at = np.searchsorted(row, np.arange(len(y) + 1))
        tried, lowest, best = _chosen(term, at, test), np.inf, 0
        for number in self._learn(term, row, y, taught, FACTOR_EPOCHS):
            loss = self.loss(*tried, y[test])
            if loss < lowest - 1e-4:
                lowest, best = loss, number
            elif number - best >= PATIENCE:
                break
        return best

    def _learn(self, term: np.ndarray, row: np.ndarray, y: np.ndarray, taught: np.ndarray, rounds: int) -> Iterator[int]:
        """Weights alone first, then ``rounds`` of weights and factors; yields the number of rounds so far."""
        rng, at = np.random.default_rng(0), np.searchsorted(row, np.arange(len(y) + 1))
        # Follow-the-regularised-leader with an L1 penalty for weights, AdaGrad for factors, per coordinate.
        z, g2 = np.zeros(len(self.w)), np.zeros(len(self.w))
        gv = np.full(self.v.shape, FACTOR_G2)
        place_of = np.zeros(len(self.w), np.int64)
        for epoch in range(EPOCHS + rounds):
            if epoch == EPOCHS:
                yield 0
                some = np.sort(rng.permutation(taught)[:START_ROWS])
                t, r = _chosen(term, at, some)
                left = y[some] - self.chances(t, r, len(some))
                self.v = rng.normal(0, FACTOR_START, self.v.shape) + self._directions(t, r, left, rng)
            order = rng.permutation(taught)
            for rows in np.split(order, range(BATCH, len(order), BATCH)):
                t, r = _chosen(term, at, rows)
                e = self.chances(t, r, len(rows)) - y[rows]
                used = np.flatnonzero(np.bincount(t, minlength=len(self.w)))
                place_of[used] = np.arange(len(used))
                place = place_of[t]
                g = np.bincount(place, weights=e[r], minlength=len(used))
                z[used] += g - (np.sqrt(g2[used] + g * g) - np.sqrt(g2[used])) / RATE * self.w[used]
                g2[used] += g * g
                moved = -(z[used] - np.sign(z[used]) * L1) / ((1 + np.sqrt(g2[used])) / RATE)
                self.w[used] = np.where(np.abs(z[used]) > L1, moved, 0.0)
                self.bias -= 0.01 * e.mean()
                if epoch >= EPOCHS:
                    v = self.v[t]
                    share = e / np.maximum(np.bincount(r, minlength=len(rows)), 1)
                    slope = share[r, None] * (_sums(v, r, len(rows))[r] - v)
                    step = _sums(slope, place, len(used)) + FACTOR_L2 * self.v[used]
                    gv[used] += step * step
                    self.v[used] -= FACTOR_RATE * step / np.sqrt(gv[used])
            if epoch >= EPOCHS:
                yield epoch - EPOCHS + 1

    def _directions(self, term: np.ndarray, row: np.ndarray, left: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Factors that explain what is left of the labels: leading eigenvectors of the sum of left * x x' over rows, less its
        diagonal, each row over its number of terms; columns that are no stronger than chance are zero."""
        n = len(left)
        share = 1 / np.maximum(np.bincount(row, minlength=n), 1)

        def strongest(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            own = np.bincount(term, weights=c[row], minlength=len(self.w))

            def times(u: np.ndarray) -> np.ndarray:
                out = np.empty_like(u)
                for k in range(u.shape[1]):
                    column = np.ascontiguousarray(u[:, k])
                    inner = c * np.bincount(row, weights=column[term], minlength=n)
                    out[:, k] = np.bincount(term, weights=inner[row], minlength=len(column)) - own * column
                return out

            u = np.linalg.qr(rng.normal(size=(len(self.w), FACTORS)))[0]
            for _ in range(ROUNDS):
                u = np.linalg.qr(times(u))[0]
            values, turn = np.linalg.eigh(u.T @ times(u))
            return values[::-1], (u @ turn)[:, ::-1]

        values, vectors = strongest(left * share)
        chance = strongest(left * share * rng.choice([-1.0, 1.0], n))[0].max()
        out = np.zeros(self.v.shape)
        for k in range(min(FACTORS, vectors.shape[1])):
            if values[k] > chance:
                u = vectors[:, [k]]
                # Such a start moves the margins by half a unit.
                out[:, k] = u[:, 0] * np.sqrt(0.5 / max(_pairs(u, term, row, n).std(), 1e-9))
        return out


def _chosen(term: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms of the chosen rows, which are numbered anew; row k has the terms from ``at[k]`` to ``at[k + 1]``."""
    sizes = at[rows + 1] - at[rows]
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return term[np.repeat(at[rows], sizes) + inside], np.repeat(np.arange(len(rows)), sizes)


def _sums(values: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """Column sums of the rows of each group."""
    return np.stack([np.bincount(group, weights=c, minlength=size) for c in values.T], axis=1)


def _pairs(v: np.ndarray, term: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For each row and factor, the sum over all pairs of terms over the number of terms; a column at a time."""
    share = 1 / np.maximum(np.bincount(row, minlength=n), 1)
    out = np.empty((n, v.shape[1]))
    for k in range(v.shape[1]):
        x = np.ascontiguousarray(v[:, k])[term]
        out[:, k] = 0.5 * share * (np.bincount(row, weights=x, minlength=n) ** 2 - np.bincount(row, weights=x * x, minlength=n))
    return out


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per term, and the bias under term -1."""
    parts = [(_flat(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
    y = np.concatenate([p[1] for p in parts] or [np.zeros(0)]).astype(float)
    before = np.cumsum([0] + [len(p[1]) for p in parts])
    term = np.concatenate([p[0][0] for p in parts] or [np.zeros(0, np.int64)])
    row = np.concatenate([p[0][1] + k for p, k in zip(parts, before)] or [np.zeros(0, np.int64)])
    used, place = np.unique(term, return_inverse=True)
    machine = Machine(len(used))
    machine.fit(place, row, y)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([[-1], used]), pa.int64()),
            pa.array(np.concatenate([[machine.bias], machine.w])),
            pa.array([[0.0] * FACTORS, *machine.v.tolist()], pa.list_(pa.float64())),
        ],
        ["term", "w", "v"],
    )


def score(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted for every row; ``labels`` has doc_id and toxic.

    Fits on labelled rows that are not held out, ``sample`` of them at most. Runs jobs while it builds its result.
    """
    docs = documents(df, key, text)
    known = labels.filter("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long"), "toxic")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~held_out(F.col("doc_id")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.join(F.broadcast(chosen), "doc_id").select(terms(F.col("text")).alias("terms"), F.col("toxic").cast("double"), "doc_id")
    # In one order whatever the partitions were, so that a fit can be repeated.
    fitted = stage(rows.repartition(1).sortWithinPartitions("doc_id").select("terms", "toxic").mapInArrow(_train, "term long, w double, v array<double>"), "machine")
    got = fitted.toArrow()  # at most one row per slot, and the bias
    machine = Machine(1 << BITS)
    term, w = got["term"].to_numpy(), got["w"].to_numpy()
    v = got["v"].combine_chunks().flatten().to_numpy().reshape(-1, FACTORS)
    machine.bias = float(w[term < 0].sum())
    machine.w[term[term >= 0]], machine.v[term[term >= 0]] = w[term >= 0], v[term >= 0]
    machine.w, machine.v = machine.w.astype(np.float32), machine.v.astype(np.float32)
    shared = df.sparkSession.sparkContext.broadcast(machine)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, row = _flat(batch.column(1))
            value = shared.value.chances(term, row, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value.astype(np.float64))], ["doc_id", "score"])

    scored = docs.select("doc_id", terms(F.col("text")).alias("terms")).mapInArrow(margins, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
