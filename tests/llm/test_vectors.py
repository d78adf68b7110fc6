import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockfee.llm import nearest, vafile
from blockfee.llm.hilbert import hilbert_order
from blockfee.llm.queries import op8_nearest

from .data import table

ODD = [
    (0, [1.0, 0.0, 0.5], 1),
    (50, [1.0, 0.0, 0.5], 1),
    (1, [1.0, 0.0, 0.5], 1),
    (2, [-1.0, 2.0, 0.25], 1),
    (3, None, 1),
    (4, [], 1),
    (5, [0.0, 0.0, 0.0], 1),
    (6, [1.0, None, 1.0], 1),
    (7, [float("nan"), 1.0, 1.0], 1),
    (8, [float("inf"), 1.0, 1.0], 1),
    (9, [1.0, 1.0], 1),
    (10, [-0.3, -0.3, 0.001], 1),
    (None, [1.0, 1.0, 1.0], 1),
    (100, None, 1),
]
SCHEMA = "vec_id long, embedding array<double>, score int"


def asks():
    return F.col("vec_id") % 50 == 0


def good(rows):
    return [
        (i, v) for i, v, _ in rows if i is not None and v and len(v) == 3 and all(x is not None and math.isfinite(x) for x in v)
    ]


def brute(rows, score, k=5):
    out = []
    for q, x in rows:
        if q % 50 == 0:
            best = sorted(((-score(x, y), i) for i, y in rows if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def product(x, y):
    return sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(x, y, strict=True))


def cosine(x, y):
    return sum(a * b for a, b in zip(x, y, strict=True)) / math.sqrt(sum(a * a for a in x)) / math.sqrt(sum(b * b for b in y))


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        order = hilbert_order(grid, bits)
        assert sorted(order) == list(range(1 << bits * dims))
        assert (np.abs(np.diff(grid[np.argsort(order)], axis=0)).sum(axis=1) == 1).all()


def test_exact_search_of_odd_rows(spark):
    got = sorted(map(tuple, vafile.top_k(spark.createDataFrame(ODD, SCHEMA), asks()).collect()))
    assert got == brute(good(ODD), product)


#: Queries and candidates twice, with the same vector or another one, and more of an id than are asked for.
REPEATED = [
    *[(q, [1.0, 0.5, 0.5], 1) for q in (0, 0, 50)],
    (50, [2.0, -1.0, 0.25], 1),
    *[(7, [9.0, float(i), 1.0], 1) for i in range(8)],
    *[(i, [1.0, i / 8, -0.5], 1) for i in (1, 2, 2, 3, 4, 5, 6)],
    (8, None, 1),
    (8, [1.0, 1.0, 1.0], 1),
]


def once(rows):
    """Of rows with one id that with the smallest vector."""
    return list({i: v for i, v in sorted(rows, reverse=True)}.items())


def test_exact_search_of_repeated_ids(spark):
    got = sorted(map(tuple, vafile.top_k(spark.createDataFrame(REPEATED, SCHEMA).repartition(3), asks()).collect()))
    assert got == brute(once(good(REPEATED)), product)


def test_nearest_of_repeated_ids(spark):
    rows = spark.createDataFrame(REPEATED, SCHEMA).repartition(3)
    got = sorted(map(tuple, nearest.nearest(rows, asks(), curves=20).collect()))
    want = brute(once(good(REPEATED)), cosine)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want])


@pytest.mark.parametrize("size", [1.0, 1e5, 1e-3])
def test_exact_search_like_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK", 3)
    monkeypatch.setattr(vafile, "SCAN", 64)
    chance = np.random.default_rng(6)
    rows = [(int(i), (chance.standard_normal(3) * size).tolist(), 0) for i in chance.permutation(400)]
    got = sorted(map(tuple, vafile.top_k(spark.createDataFrame(rows, SCHEMA), asks()).collect()))
    assert got == brute(good(rows), product)


def test_exact_search_beyond_doubles(spark):
    """Sums above 2**53 are exact; above 2**63 they count as the largest number, and rank as they are."""
    rows = [(0, [3e9 / 256, 1 / 256], 0), (1, [3e5 / 256, 1 / 256], 0), (2, [3e5 / 256, 0.0], 0), (3, [9e9 / 256, 0.0], 0)]
    got = [tuple(r)[1:] for r in vafile.top_k(spark.createDataFrame(rows, SCHEMA), asks()).orderBy("rank").collect()]
    assert got == [(1, 3, 2**63 - 1), (2, 1, 9 * 10**14 + 1), (3, 2, 9 * 10**14)]


def test_exact_search_without_rows(spark):
    assert vafile.top_k(spark.createDataFrame([], SCHEMA), asks()).count() == 0
    assert vafile.top_k(spark.createDataFrame(ODD[:1], SCHEMA), asks()).count() == 0


def test_cells_spare_most_exact_reads(spark, monkeypatch):
    read = []
    scores = vafile._Best._scores
    monkeypatch.setattr(vafile._Best, "_scores", lambda self, i, rows: read.append(len(rows)) or scores(self, i, rows))
    chance = np.random.default_rng(1)
    x = chance.integers(-200, 200, (4000, 16)).astype(float)
    edges = np.linspace(-200, 200, vafile.CELLS + 1)[None, :].repeat(16, axis=0)
    cells = np.clip(np.searchsorted(edges[0], x, side="right") - 1, 0, vafile.CELLS - 1).astype(np.uint8)
    import pyarrow as pa

    best = vafile._Best(np.array([0]), x[:1], edges, 5)
    best.read(np.arange(4000), cells, pa.array([v.tobytes() for v in x], pa.binary()))
    exact = x @ x[0]
    exact[0] = -np.inf
    assert best.top[0][0].tolist() == np.lexsort((np.arange(4000), -exact))[:5].tolist()
    assert sum(read) < 200


def test_nearest_of_odd_rows(spark):
    got = sorted(map(tuple, nearest.nearest(spark.createDataFrame(ODD, SCHEMA), asks(), curves=40).collect()))
    want = brute([(i, v) for i, v in good(ODD) if any(v)], cosine)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want])


def test_nearest_without_rows(spark):
    assert nearest.nearest(spark.createDataFrame([], SCHEMA), asks()).count() == 0


@pytest.mark.parametrize("task_rows", [nearest.TASK_ROWS, 40])
def test_recall(spark, task_rows, monkeypatch):
    """Also where ranges are dealt over several tasks."""
    monkeypatch.setattr(nearest, "TASK_ROWS", task_rows)
    monkeypatch.setattr(nearest, "TASK_QUERIES", task_rows)
    rows = table(spark, "embeddings", "/root/testdata/sf0.1").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    asks = np.flatnonzero(ids % 50 == 0)
    scores = x[asks] @ x.T
    scores[np.arange(len(asks)), asks] = -9
    want = {(ids[q], ids[i]) for q, row in zip(asks, scores, strict=True) for i in np.argsort(-row)[:5]}
    got = op8_nearest(spark, "/root/testdata/sf0.1").collect()
    assert len(got) == 5 * len(asks)
    assert len(want & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(want)
    place = {int(v): k for k, v in enumerate(ids)}
    for r in got:
        assert r.score == pytest.approx(float(x[place[r.query_id]] @ x[place[r.vec_id]]), abs=1e-12)


def test_copies_of_one_vector_are_dealt_out(spark):
    chance = np.random.default_rng(0)
    rows = [(i, [0.5, 0.25, -0.5], 0) for i in range(2000)]
    rows += [(i, chance.standard_normal(3).tolist(), 0) for i in range(2000, 4000)]
    ids, units = np.arange(4000), nearest._unit(np.array([v for _, v, _ in rows]))
    spread = np.ones((1, 3))
    keys = nearest._keys(units, ids, 0, spread)
    cuts = np.sort(keys)[(np.arange(1, 16) * 4000) // 16]
    assert np.bincount(np.searchsorted(cuts, keys, side="right")).max() < 600
