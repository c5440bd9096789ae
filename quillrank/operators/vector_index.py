"""Inverted-file vector index: neighbours by inner product without comparing all pairs.

Vectors get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, so that all have the norm M and the largest
inner product is the smallest distance. Coarse centres are fitted on a bounded sample; every vector is then written
under the cell of its nearest centre, in blocks of at most about BLOCK vectors, however many share a cell. A query reads
the blocks of its nearest cells only. In exact mode a second pass reads every further cell that could still hold one of
the best k: inside a cell of centre c and radius r no inner product exceeds q c + |q| r.

Defined cases: rows without id or vector are left out; equal ids are indexed each; query ids are unique; a query without
vector has no neighbours; equal scores go by the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from quillrank.functions import doubles
from quillrank.plans.ranks import top_by
from quillrank.plans.skew import is_small, spread_join
from quillrank.session import stage

# Vectors of the sample that the centres are fitted on, and the largest number of centres.
SAMPLE, CELLS = 20_000, 4096
# Vectors and queries that are compared by one matrix product.
BLOCK, QUERIES = 2048, 512


@dataclass(frozen=True)
class VectorIndex:
    """Centres with the added coordinate last, cell radii, largest norm, and the staged blocks (cell, block, ids, flat)."""

    centres: np.ndarray
    radii: np.ndarray
    norm: float
    blocks: DataFrame
    kind: str


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def _extended(x: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0.0))
    return np.column_stack([x, rest])


def _lowest(rows: DataFrame, place: Column, sample: int, number: int) -> DataFrame:
    """The ``sample`` rows of ``number`` with the lowest hash ``place``, ties to the smaller id.

    A limit alone brings ``sample`` rows of every partition to one task; a bound that about twice the sample lies below
    leaves the same rows first.
    """
    if 2 * sample < number:
        near = rows.filter(place < F.lit(2 * sample * 2**64 // number - 2**63))
        if near.count() >= sample:
            rows = near
    return rows.orderBy(place, "id").limit(sample)


def build_index(
    vectors: DataFrame, cells: int | None = None, sample: int = SAMPLE, vid: str = "vec_id", vector: str = "embedding", seed: int = 0
) -> VectorIndex:
    """Index of all vectors; the centres are fitted on at most ``sample`` of them, chosen by a hash of the id."""
    rows = stage(
        vectors.filter(F.col(vid).isNotNull() & F.col(vector).isNotNull()).select(F.col(vid).alias("id"), doubles(vector).alias("x")), "vectors"
    )
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    number, norm = rows.agg(F.count(F.lit(1)), F.coalesce(F.sqrt(F.max(square)), F.lit(0.0))).first()
    cells = min(cells or math.ceil(math.sqrt(number)), CELLS, max(number, 1))
    last = F.sqrt(F.greatest(F.lit(norm * norm) - square, F.lit(0.0)))
    some = _lowest(rows, F.xxhash64("id", F.lit(seed)), sample, number).select(array_to_vector(F.concat("x", F.array(last))).alias("features"))
    if number:
        centres = np.array(KMeans(k=cells, maxIter=8, seed=seed, initMode="random").fit(some).clusterCenters())
    else:
        centres = np.zeros((1, 1))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        half = (centres * centres).sum(axis=1) / 2
        for pdf in batches:
            if len(pdf):
                x = _extended(_matrix(pdf["x"]), norm)
                cell = (x @ centres.T - half).argmax(axis=1)
                away = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1))
                yield pdf.assign(cell=cell.astype("int32"), away=away)

    kind = dict(rows.dtypes)["id"]
    placed = rows.mapInPandas(place, f"id {kind}, x array<double>, cell int, away double")
    placed = stage(placed.withColumn("at", F.monotonically_increasing_id()), "placed")
    sizes = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n"))
    radii = np.zeros(len(centres))
    for r in sizes.collect():  # one row per centre at most
        radii[r["cell"]] = r["radius"]
    # A full cell is cut into blocks by the hash of the rows' places, which are all different.
    parts = placed.join(F.broadcast(sizes.select("cell", F.ceil(F.col("n") / BLOCK).alias("parts"))), "cell")
    parts = parts.withColumn("block", F.pmod(F.xxhash64("at"), "parts"))
    listed = parts.groupBy("cell", "block").agg(F.collect_list(F.struct("id", "x")).alias("p"))
    blocks = listed.select("cell", "block", F.col("p.id").alias("ids"), F.flatten("p.x").alias("flat"))
    return VectorIndex(centres, radii, norm, stage(blocks, "blocks"), kind)


def _probe(queries: DataFrame, index: VectorIndex, probes: int, beyond: bool) -> DataFrame:
    """(query_id, x, cell, turn): the ``probes`` nearest cells of each query, or those beyond them that can hold a better
    score than ``least``. ``turn`` is the number of nearer cells."""
    centres, radii, norm = index.centres, index.radii, index.norm

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        half = (centres * centres).sum(axis=1) / 2
        for pdf in batches:
            if not len(pdf):
                continue
            q = _matrix(pdf["x"])
            size = np.sqrt((q * q).sum(axis=1))
            inner = q @ centres[:, :-1].T
            # Order by distance from the query brought to the norm of the vectors.
            x = pdf["x"].to_numpy()
            near = np.argsort(half - inner * (norm / np.maximum(size, 1e-300))[:, None], axis=1, kind="stable")
            turn = np.empty_like(near)
            turn[np.arange(len(q))[:, None], near] = np.arange(near.shape[1])
            if beyond:
                reach = inner + size[:, None] * radii
                slack = 1e-9 * (1 + np.abs(reach))
                open_ = reach + slack >= pdf["least"].to_numpy()[:, None]
                row, cell = np.nonzero(open_ & (turn >= probes))
            else:
                row, cell = np.nonzero(turn < probes)
            names = pdf["query_id"].to_numpy()
            yield pd.DataFrame({"query_id": names[row], "x": x[row], "cell": cell.astype("int32"), "turn": turn[row, cell].astype("int32")})

    kind = dict(queries.dtypes)["query_id"]
    return queries.mapInPandas(cells, f"query_id {kind}, x array<double>, cell int, turn int")


def _scan(probed: DataFrame, index: VectorIndex, k: int, skip_self: bool) -> DataFrame:
    """(query_id, id, score, turn): the best ``k`` of each query in each block that it reads."""
    kind = dict(probed.dtypes)["query_id"]
    sizes = probed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("parts"))
    cut = probed.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("query_id"), "parts"))
    asked = cut.groupBy("cell", "part").agg(F.collect_list(F.struct("query_id", "x", "turn")).alias("p"))
    asked = stage(asked.select("cell", F.col("p.query_id").alias("queries"), F.flatten("p.x").alias("wanted"), F.col("p.turn").alias("turns")), "asked")
    # The side with fewer blocks is the one that is broadcast or repeated.
    if is_small(asked.select("cell")):
        both = spread_join(index.blocks, asked, "cell", salt=F.col("block"))
    else:
        both = spread_join(asked, index.blocks, "cell")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, flat, names, wanted, turns in zip(*[pdf[c] for c in columns]):
                ids, names, turns = np.asarray(ids), np.asarray(names), np.asarray(turns)
                scores = np.asarray(wanted).reshape(len(names), -1) @ np.asarray(flat).reshape(len(ids), -1).T
                if skip_self:
                    scores[names[:, None] == ids[None, :]] = -np.inf
                few = min(k, len(ids))
                least = np.partition(scores, len(ids) - few, axis=1)[:, len(ids) - few]
                row, column = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
                yield pd.DataFrame({"query_id": names[row], "id": ids[column], "score": scores[row, column], "turn": turns[row]})

    columns = ["ids", "flat", "queries", "wanted", "turns"]
    return both.select(*columns).mapInPandas(compare, f"query_id {kind}, id {index.kind}, score double, turn int")


def probes_for(index: VectorIndex, queries: DataFrame, k: int = 10, recall: float = 0.95, sample: int = 256, **more) -> int:
    """How many cells to read so that ``recall`` of the true neighbours of ``sample`` queries are found."""
    some = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(sample)
    turns = _best(index, some, k, 1, True, **more).agg(F.percentile("turn", recall)).scalar()
    found = some.sparkSession.range(1).select(turns.alias("turn")).first()["turn"]
    return 1 + math.ceil(found or 0)


def search_index(
    index: VectorIndex, queries: DataFrame, k: int = 10, probes: int = 8, exact: bool = False, skip_self: bool = True, vector: str = "embedding"
) -> DataFrame:
    """(query_id, id, score, rank) of the ``k`` best vectors by inner product for all ``queries`` (query_id, vector).

    Without ``exact`` only the ``probes`` nearest cells of each query are read. ``skip_self`` leaves out the query's own id.
    """
    return _best(index, queries, k, probes, exact, skip_self, vector).drop("turn")


def _best(index: VectorIndex, queries: DataFrame, k: int, probes: int, exact: bool, skip_self: bool = True, vector: str = "embedding") -> DataFrame:
    asked = stage(queries.filter(F.col(vector).isNotNull()).select("query_id", doubles(vector).alias("x")), "queries")
    order = [F.desc("score"), F.asc("id")]
    found = top_by(_scan(_probe(asked, index, probes, False), index, k, skip_self), ["query_id"], order, k)
    if not exact or probes >= len(index.centres):
        return found
    found = stage(found, "found")
    least = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    # Who has fewer than k so far has to look everywhere.
    missing = asked.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(-math.inf)))
    more = _scan(_probe(missing, index, probes, True), index, k, skip_self)
    return top_by(found.drop("rank").unionByName(more), ["query_id"], order, k)
