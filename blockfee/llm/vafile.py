"""Exact top-k search by inner product with a vector-approximation file.

Each component x counts as floor(``scale`` * x). The file, a stored table in the shared
folder, holds beside each vector its cells: the number of the interval, of ``CELLS`` per
axis, in which each component lies. A task first reads cells alone and bounds each
score from both sides: a component can give no more than the better edge of its cell.
It then reads exact vectors from the highest upper bound on, and stops when the next
bound is below the kth exact score: no vector left can be among the best. What tasks
find is merged.

The queries, a stated set, go over the file in blocks of ``BLOCK``. Sums are exact: of
64-bit numbers where no sum can exceed 2**53, else of Python's integers.

Defined cases: rows without id, with a null or empty vector, with a null or non-finite
component, or of another length than most take no part; of the others that share an id
the one with the smallest vector counts, so a query finds an id once; ties of score go to
the smaller id; vectors of any length are read whole; only ``vec_id`` and the vector are
read, so other columns can't clash; a score beyond 64 bits counts as the largest or
smallest of these; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .vectors import one_of_each_id, only_vectors, ranked, read_vectors

#: Intervals on each axis, a byte at most.
CELLS = 64
#: Queries that are sent to the tasks at once.
BLOCK = 2048
#: Rows that are bounded at once, and exact vectors that are read in a step.
SCAN, STEP = 4096, 32
_EXACT = float(2**53)


def _floors(vectors: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(vectors * scale))


def _whole(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)


def build(table: DataFrame, scale: int = 256, column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """The file (vec_id, cells, vector as floors) and the edges of the cells, a row for each axis."""
    rows = only_vectors(table, column)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            _, vectors = read_vectors(batch, column)
            if len(vectors):
                x = _floors(vectors, scale)
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            axis = np.arange(len(low))
            yield pa.record_batch({"axis": axis, "low": low, "high": high})

    # A row for each axis.
    limits = (
        rows.mapInArrow(ends, "axis long, low double, high double")
        .groupBy("axis")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .orderBy("axis")
        .collect()
    )
    low, high = (np.array([r[k] for r in limits]) for k in ("low", "high"))
    inner = np.arange(CELLS + 1) / CELLS
    # Halved before the difference, which may be more than a double can hold.
    edges = low[:, None] * (1 - inner) + high[:, None] * inner
    if len(limits):
        edges[:, 0], edges[:, -1] = low, high
        edges = np.maximum.accumulate(edges, axis=1)

    def approximated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, vectors = read_vectors(batch, column)
            if not len(vectors):
                continue
            x = _floors(vectors, scale)
            cells = np.empty(x.shape, np.uint8)
            for axis in range(x.shape[1]):
                cells[:, axis] = np.clip(np.searchsorted(edges[axis], x[:, axis], side="right") - 1, 0, CELLS - 1)
            yield pa.record_batch(
                {
                    "vec_id": batch.column("vec_id"),
                    "cells": pa.array([c.tobytes() for c in cells], pa.binary()),
                    "vector": pa.array([v.astype("<f8").tobytes() for v in x], pa.binary()),
                }
            )

    distinct = one_of_each_id(rows, column)
    return stored(distinct.mapInArrow(approximated, "vec_id long, cells binary, vector binary"), "va-file"), edges


def _bounds(queries: np.ndarray, cells: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the score of each query with each vector."""
    axis = np.arange(cells.shape[1])
    low, high = edges[axis, cells], edges[axis, cells + 1]
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        lower, upper = up @ low.T + down @ high.T, up @ high.T + down @ low.T
        # Rounding must not cut off what is just inside.
        slack = 1e-9 * (np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T) + 1
        lower, upper = lower - slack, upper + slack
    return np.where(np.isnan(lower), -np.inf, lower), np.where(np.isnan(upper), np.inf, upper)


class _Best:
    """The k best rows of each query so far, with exact scores."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, edges: np.ndarray, k: int) -> None:
        self.query_ids, self.queries, self.edges, self.k = query_ids, queries, edges, k
        largest = max(1.0, float(np.abs(edges).max())) if edges.size else 1.0
        self.small = float(np.abs(queries).sum(axis=1).max()) * largest < _EXACT
        self.whole = None if self.small else _whole(queries)
        kind = np.int64 if self.small else object
        self.top = [(np.zeros(0, np.int64), np.zeros(0, kind)) for _ in queries]

    def _scores(self, i: int, rows: np.ndarray) -> np.ndarray:
        if self.small:
            return (rows @ self.queries[i]).astype(np.int64)
        return np.array([sum(x * y for x, y in zip(row, self.whole[i], strict=True)) for row in _whole(rows)], object)

    def read(self, ids: np.ndarray, cells: np.ndarray, vectors: pa.Array) -> None:
        """Bounds from the cells, then exact vectors while their bounds allow a place among the best."""
        lower, upper = _bounds(self.queries, cells, self.edges)
        own = self.query_ids[:, None] == ids[None, :]
        lower[own] = upper[own] = -np.inf
        for i in range(len(self.queries)):
            known, scores = self.top[i]
            there = np.flatnonzero(~own[i])
            # No row whose upper bound is below the kth lower bound can be among the best.
            if len(there) > self.k:
                there = there[upper[i, there] >= np.partition(lower[i, there], -self.k)[-self.k]]
            there = there[np.argsort(-upper[i, there], kind="stable")]
            for at in range(0, len(there), STEP):
                if len(known) == self.k and upper[i, there[at]] < float(scores[-1]):
                    break
                step = there[at : at + STEP]
                exact = np.stack([np.frombuffer(vectors[int(j)].as_buffer(), "<f8") for j in step])
                known, scores = np.concatenate([known, ids[step]]), np.concatenate([scores, self._scores(i, exact)])
                order = sorted(range(len(known)), key=lambda j: (-scores[j], known[j]))[: self.k]
                known, scores = known[order], scores[order]
            self.top[i] = known, scores

    def rows(self) -> pa.RecordBatch:
        counts = [len(known) for known, _ in self.top]
        scores = [max(-(2**63), min(2**63 - 1, int(s))) for _, scores in self.top for s in scores]
        return pa.record_batch(
            {
                "query_id": np.repeat(self.query_ids, counts),
                "vec_id": np.concatenate([known for known, _ in self.top]),
                "score": pa.array(scores, pa.int64()),
            }
        )


def top_k(
    table: DataFrame, is_query: Column, k: int = 5, scale: int = 256, column: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k rows of highest score for each query."""
    spark = table.sparkSession
    file, edges = build(table, scale, column)
    asked = file.where(is_query).select("vec_id", "vector")
    total = asked.count()
    schema = "query_id long, vec_id long, score long"
    # Blocks by a hash of the id; each is one pass over the file.
    blocks = -(-total // BLOCK)
    found = None
    for number in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).orderBy("vec_id").collect()
        if not block:
            continue
        query_ids = np.array([r.vec_id for r in block])
        queries = np.stack([np.frombuffer(r.vector, "<f8") for r in block])
        sent = spark.sparkContext.broadcast((query_ids, queries, edges))

        def scanned(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            found = _Best(*sent.value, k)
            for batch in batches:
                for start in range(0, len(batch), SCAN):
                    part = batch.slice(start, SCAN)
                    cells = np.stack([np.frombuffer(x.as_buffer(), np.uint8) for x in part.column("cells")])
                    found.read(part.column("vec_id").to_numpy(), cells, part.column("vector"))
            yield found.rows()

        block_found = ranked(file.mapInArrow(scanned, schema), k).select("query_id", "vec_id", "score")
        found = block_found if found is None else found.unionByName(block_found)
    if found is None:
        found = spark.createDataFrame([], schema)
    return ranked(found, k)
