"""Approximate nearest neighbours by shifted space-filling curves.

Each curve turns the vectors by a rotation of its own, keeps a few of the turned axes,
shifts their grid and orders the cells along a Hilbert curve. The order is cut into
ranges of equal numbers of rows, one per task; a query goes to its own range and the two
beside it, and is compared with all that is there, on the whole vectors. The best of all
curves are merged.

The cuts come from a sample of at most ``SAMPLE`` rows; every row is indexed. Equal places
are told apart by a hash of the id, so copies of one vector spread over several ranges
instead of filling one. Ranges with more rows than a task should hold are dealt over
several tasks, and so are their queries.

The fewer ranges and the more curves, the higher the recall: a query sees 3 /
``ranges`` of all rows for each curve, whatever their number. The defaults reach 0.95 and
more even on vectors without any structure, which is the hardest case.

Defined cases: rows without id, with a null, zero or empty vector, with a null or
non-finite component, or of another length than most take no part; of the others that
share an id the one with the smallest vector counts; equal vectors are found as often as
their id differs; ties of cosine go to the smaller id; vectors of any length are read
whole; only ``vec_id`` and the vector are read, so other columns can't clash; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hilbert import hilbert_order
from .shared import stored
from .vectors import best, one_of_each_id, only_vectors, ranked, read_vectors
from .words import mixed

#: Rows that ranges are cut by, at most.
SAMPLE = 20_000
#: Rows that a range has at least, so that a few rows are all compared.
RANGE_ROWS = 50
#: Rows and queries that meet in a task.
TASK_ROWS, TASK_QUERIES = 200_000, 20_000
_AXES, _BITS, _HASH_BITS = 8, 4, 30
_STEP = 4096


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small numbers stay finite.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _keys(units: np.ndarray, ids: np.ndarray, curve: int, spread: np.ndarray) -> np.ndarray:
    """Place along the curve, then a hash of the id."""
    chance = np.random.default_rng(curve)
    size = units.shape[1]
    axes = min(_AXES, size)
    turn, _ = np.linalg.qr(chance.standard_normal((size, size)))
    shift = chance.uniform(-0.5, 0.5, axes)
    grid = (units @ turn[:, :axes]) / spread[curve] + shift
    cells = np.clip((grid + 2.5) / 5 * (1 << _BITS), 0, (1 << _BITS) - 1).astype(np.int64)
    tie = mixed(ids.astype(np.int64).view(np.uint64) + np.uint64(curve)) >> np.uint64(64 - _HASH_BITS)
    return (hilbert_order(cells, _BITS) << _HASH_BITS) | tie.astype(np.int64)


def nearest(
    table: DataFrame, is_query: Column, k: int = 5, curves: int = 10, ranges: int = 16, column: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (cosine) of the k nearest rows found for each query."""
    spark = table.sparkSession
    rows = only_vectors(table, column).where(F.exists(column, lambda x: x != 0))
    rows = stored(one_of_each_id(rows, column), "vectors")
    rows = rows.select("vec_id", column, F.coalesce(is_query, F.lit(False)).alias("asks"))

    total, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    ranges = max(1, min(ranges, total // RANGE_ROWS))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec_id", column).toArrow()
    result = "query_id long, vec_id long, score double"
    if not sample.num_rows:
        return ranked(spark.createDataFrame([], result), k)
    batch = sample.combine_chunks().to_batches()[0]
    _, vectors = read_vectors(batch, column)
    ids, units = batch.column("vec_id").to_numpy(), _unit(vectors)
    axes = min(_AXES, units.shape[1])
    spread = np.empty((curves, axes))
    cuts = np.empty((curves, ranges - 1), np.int64)
    for curve in range(curves):
        turn, _ = np.linalg.qr(np.random.default_rng(curve).standard_normal((units.shape[1],) * 2))
        spread[curve] = np.maximum((units @ turn[:, :axes]).std(axis=0), 1e-9)
        keys = np.sort(_keys(units, ids, curve, spread))
        cuts[curve] = keys[(np.arange(1, ranges) * len(keys)) // ranges]

    row_parts = max(1, -(-total // (ranges * TASK_ROWS)))
    query_parts = max(1, -(-3 * asking // (ranges * TASK_QUERIES)))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row to all tasks that compare it, queries ahead of the rest."""
        for batch in batches:
            _, vectors = read_vectors(batch, column)
            if not len(vectors):
                continue
            ids = batch.column("vec_id").to_numpy()
            asks = np.flatnonzero(batch.column("asks").to_numpy(zero_copy_only=False))
            units = _unit(vectors)
            packed = pa.array([v.astype("<f8").tobytes() for v in vectors], pa.binary())
            row_part = (mixed(ids.view(np.uint64)) % np.uint64(row_parts)).astype(np.int64)
            query_part = (mixed(ids.view(np.uint64)) % np.uint64(query_parts)).astype(np.int64)
            for curve in range(curves):
                place = np.searchsorted(cuts[curve], _keys(units, ids, curve, spread), side="right")
                sent = [
                    (np.arange(len(ids)), place, row_part, np.full(len(ids), part), False)
                    for part in range(query_parts)
                ]
                for beside in (-1, 0, 1):
                    there = asks[(place[asks] + beside >= 0) & (place[asks] + beside < ranges)]
                    for part in range(row_parts):
                        sent.append((there, place[there] + beside, np.full(len(there), part), query_part[there], True))
                for at, where, by_row, by_query, ask in sent:
                    by_row = by_row if ask else by_row[at]
                    slot = ((curve * ranges + where) * row_parts + by_row) * query_parts + by_query
                    yield pa.record_batch(
                        {
                            "slot": pa.array(slot, pa.int32()),
                            "asks": pa.array(np.full(len(at), ask)),
                            "vec_id": pa.array(ids[at]),
                            "vector": packed.take(pa.array(at)),
                        }
                    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries come first; the rest is compared as it comes, keeping the best."""
        asked: list[tuple[np.ndarray, np.ndarray]] = []
        queries = None
        for batch in batches:
            ask = batch.column("asks").to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").to_numpy()
            packed = batch.column("vector")
            units = _unit(np.stack([np.frombuffer(x.as_buffer(), "<f8") for x in packed])) if len(ids) else None
            if ask.any():
                asked.append((ids[ask], units[ask]))
            if ask.all():
                continue
            if queries is None:
                if not asked:
                    return
                queries = tuple(np.concatenate(x) for x in zip(*asked, strict=True))
                top = [(np.zeros(0, np.int64), np.zeros(0))] * len(queries[0])
            ids, units = ids[~ask], units[~ask]
            for at in range(0, len(queries[0]), _STEP):
                scores = queries[1][at : at + _STEP] @ units.T
                scores[queries[0][at : at + _STEP][:, None] == ids[None, :]] = -np.inf
                for i, places in enumerate(best(scores, ids, k)):
                    places = places[places >= 0]
                    known, value = top[at + i]
                    known = np.concatenate([known, ids[places]])
                    value = np.concatenate([value, scores[i, places]])
                    order = np.lexsort((known, -value))[:k]
                    top[at + i] = known[order], value[order]
        if queries is not None:
            counts = [len(x) for x, _ in top]
            yield pa.record_batch(
                {
                    "query_id": np.repeat(queries[0], counts),
                    "vec_id": np.concatenate([x for x, _ in top]),
                }
            )

    slots = curves * ranges * row_parts * query_parts
    found = (
        rows.mapInArrow(dealt, "slot int, asks boolean, vec_id long, vector binary")
        .repartitionById(slots, "slot")
        .sortWithinPartitions(F.desc("asks"))
        .mapInArrow(compared, "query_id long, vec_id long")
        .distinct()
    )
    return ranked(_scored(found, rows, column), k)


def _scored(pairs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """The cosine of each pair, from the original vectors, in one order of summing."""
    a = rows.select(F.col("vec_id").alias("query_id"), F.col(column).alias("x"))
    b = rows.select("vec_id", F.col(column).alias("y"))

    def cosine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = read_vectors(batch, "x")
            _, y = read_vectors(batch, "y")
            scores = (_unit(x) * _unit(y)).sum(axis=1) if len(x) else np.zeros(0)
            yield pa.record_batch(
                {"query_id": batch.column("query_id"), "vec_id": batch.column("vec_id"), "score": pa.array(scores)}
            )

    return pairs.join(a, "query_id").join(b, "vec_id").mapInArrow(cosine, "query_id long, vec_id long, score double")
