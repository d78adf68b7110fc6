"""Vectors of an Arrow batch as a matrix, and the best few of many scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def read_vectors(batch: pa.RecordBatch, column: str = "embedding") -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector of finite numbers of the usual length, and the matrix of these.

    The usual length is that of the first whole vector; see ``only_vectors``.
    """
    values = batch.column(column)
    lengths = np.diff(values.offsets.to_numpy())
    flat = values.values.cast(pa.float64())
    numbers = flat.to_numpy(zero_copy_only=False)
    finite = np.isfinite(numbers)  # a null component reads as nan
    good = values.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
    starts = values.offsets.to_numpy()[:-1]
    bad_upto = np.concatenate(([0], np.cumsum(~finite)))
    good &= bad_upto[starts + lengths] == bad_upto[starts]
    rows = np.flatnonzero(good)
    if not len(rows):
        return rows, np.zeros((0, 0))
    size = int(lengths[rows[0]])
    rows = rows[lengths[rows] == size]
    return rows, numbers[starts[rows][:, None] + np.arange(size)]


def only_vectors(table: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``column`` of rows that take part: an id, and a vector of finite numbers.

    Vectors of another length than most can't be compared and are left out too.
    """
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias(column))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull() & (F.size(column) > 0) & finite)
    # A row for each length.
    sizes = rows.groupBy(F.size(column).alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size(column) == (sizes["size"] if sizes else 0))


def one_of_each_id(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """Of rows with one ``vec_id`` that with the smallest vector, in the order of arrays; combined before the shuffle."""
    return rows.groupBy("vec_id").agg(F.min(column).alias(column))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """For each row of scores, the places of the k highest, ties to the smaller id; -inf is left to the end."""
    if scores.shape[1] > 4 * k:
        cut = np.partition(scores, -k, axis=1)[:, -k]
    else:
        cut = np.full(len(scores), -np.inf)
    out = np.full((len(scores), k), -1)
    for i, (row, least) in enumerate(zip(scores, cut, strict=True)):
        at = np.flatnonzero(row >= least)
        at = at[np.lexsort((ids[at], -row[at]))[:k]]
        at = at[row[at] > -np.inf] if row.dtype.kind == "f" else at
        out[i, : len(at)] = at
    return out


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query (query_id, vec_id, score), with ``rank`` from 1; a query has few rows."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
