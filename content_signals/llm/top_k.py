"""Exact top-k by inner product, pruned with segment statistics from coarse to fine.

For unit-free vectors q and x, ``2 <q, x> = |q|^2 + |x|^2 - |q - x|^2``: the
largest product is the smallest distance after the lengths are taken off. The
distance is at least the sum over segments of ``n ((mean difference)^2 +
(deviation difference)^2)``; segments halve from level to level, which tightens
the bound. A candidate is dropped at the first level whose bound cannot reach the
query's k-th best score so far, and only survivors get an exact product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Queries sent to the tasks at once; with ``_BLOCK`` candidates this bounds their memory.
QUERY_BATCH = 1024
#: Vector components sent to the tasks at once: 8 MB, whatever the vectors' length.
BATCH_COMPONENTS = 1 << 20
SCALE = 256
LEVELS = (4, 8, 16)
_BLOCK = 2048
_EXACT = 2.0**52  # sums of products below this are exact as doubles


def _whole(vector) -> np.ndarray | None:
    """floor(scale x) as doubles, or nothing for a vector that takes no part."""
    if vector is None:
        return None
    try:
        values = np.asarray(vector, np.float64)
    except (TypeError, ValueError):
        return None
    return np.floor(SCALE * values) if np.isfinite(values).all() else None


class _Levels:
    """Means and deviations of the vectors' segments, weighted so that a plain product serves."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.square = np.einsum("ij,ij->i", x, x)
        self.parts = []
        for count in LEVELS:
            if count < x.shape[1]:
                edges = np.linspace(0, x.shape[1], count + 1).astype(int)
                size = np.diff(edges)
                mean = np.add.reduceat(x, edges[:-1], axis=1) / size
                square = np.add.reduceat(x * x, edges[:-1], axis=1) / size
                deviation = np.sqrt(np.maximum(square - mean * mean, 0))
                self.parts.append(np.hstack([mean, deviation]) * np.sqrt(np.tile(size, 2)))


def _bound(q: _Levels, x: _Levels, level: int) -> np.ndarray:
    """Upper bound of the product of every query and candidate, from the distance's lower bound."""
    a, b = q.parts[level], x.parts[level]
    cross = a @ b.T
    gap = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * cross
    return (q.square[:, None] + x.square[None, :] - gap) / 2


def _exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Products of paired rows as whole numbers, by Python's own where doubles would round."""
    largest = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if largest < _EXACT:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    sums = [sum(int(a) * int(b) for a, b in zip(r, s)) for r, s in zip(q, x)]
    return np.array(sums, np.int64)  # raises where a score is no 64-bit number


class _Search:
    """The k best candidates of some queries of one length, over blocks of candidates."""

    def __init__(self, ids: list[int], vectors: np.ndarray, k: int):
        self.ids, self.k = np.array(ids, np.int64), k
        self.levels = _Levels(vectors)
        self.query = np.empty(0, np.int64)  # the best so far: query's place, candidate, score
        self.vec = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.floor = np.full(len(ids), -np.inf)
        self.survivors = self.seen = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        x = _Levels(vectors)
        alive = self.ids[:, None] != ids[None, :]
        self.seen += int(alive.sum())
        slack = 1e-9 * (self.levels.square.max(initial=0) + x.square.max(initial=0)) + 0.5
        if np.isfinite(self.floor).any():
            for level in range(len(x.parts)):
                alive &= _bound(self.levels, x, level) >= self.floor[:, None] - slack
        row, column = np.nonzero(alive)
        self.survivors += len(row)
        score = np.empty(len(row), np.int64)
        for start in range(0, len(row), 1 << 16):
            part = slice(start, start + (1 << 16))
            score[part] = _exact_products(self.levels.x[row[part]], x.x[column[part]])
        near = score >= self.floor[row]
        query = np.concatenate([self.query, row[near]])
        vec = np.concatenate([self.vec, ids[column[near]]])
        score = np.concatenate([self.score, score[near]])
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        best = place < self.k
        self.query, self.vec, self.score = query[best], vec[best], score[best]
        last = place == self.k - 1
        self.floor[query[last]] = score[last]


def _batches(queries: DataFrame) -> Iterator[list[tuple[int, list[float]]]]:
    """The queries in batches of a fixed size, one in the driver at a time."""
    batch: list = []
    size = 0
    for row in queries.toLocalIterator():
        vector = _whole(row[1])
        if vector is None:
            continue
        if batch and (len(batch) == QUERY_BATCH or size + len(vector) > BATCH_COMPONENTS):
            yield batch
            batch, size = [], 0
        batch.append((row[0], vector))
        size += len(vector)
    if batch:
        yield batch


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``vectors`` for each of ``queries``.

    Both hold ``vec_id`` and ``embedding``; other columns are not read. Scores are
    whole-number products of floor(256 x). Ties go to the smaller ``vec_id``. Rows
    without id, and vectors that are null or hold null or non-finite components,
    take no part; vectors of another length than the query's are no candidates.
    Rows of the query's own id are left out. A repeated candidate row counts as
    often as it stands; a repeated query row is asked once.

    Each batch of queries is one pass over ``vectors``: a batch has a fixed size,
    so it may be sent to every task. A task returns its own k best per query.
    """
    columns = ["vec_id", "embedding"]
    spark = vectors.sparkSession
    candidates = vectors.select(*columns).filter("vec_id is not null")
    wanted = queries.select(*columns).filter("vec_id is not null").dropDuplicates()
    found = []
    for batch in _batches(wanted):
        packed = spark.sparkContext.broadcast(batch)

        def search(batches: Iterator[pa.RecordBatch], packed=packed) -> Iterator[pa.RecordBatch]:
            by_length: dict[int, _Search] = {}
            for length in {len(v) for _, v in packed.value}:
                own = [(i, v) for i, v in packed.value if len(v) == length]
                by_length[length] = _Search([i for i, _ in own], np.array([v for _, v in own]), k)
            for record in batches:
                for start in range(0, record.num_rows, _BLOCK):
                    part = record.slice(start, _BLOCK)
                    groups: dict[int, list] = {}
                    for i, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                        if (v := _whole(v)) is not None and len(v) in by_length:
                            groups.setdefault(len(v), []).append((i, v))
                    for length, own in groups.items():
                        ids = np.array([i for i, _ in own], np.int64)
                        by_length[length].add(ids, np.array([v for _, v in own]))
            for found in by_length.values():
                arrays = [pa.array(c) for c in (found.ids[found.query], found.vec, found.score)]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

        found.append(candidates.mapInArrow(search, "query_id long, vec_id long, score long"))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
