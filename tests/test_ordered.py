from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blockfee import operators as op
from blockfee.schemas import COIN


def heights(spark, values):
    return spark.createDataFrame([(v,) for v in values], "height long")


def gaps(values, start, stop):
    missing = sorted(set(range(start, stop)) - set(values))
    runs = [[h for _, h in g] for _, g in groupby(enumerate(missing), lambda x: x[1] - x[0])]
    return [(r[0], r[-1]) for r in runs]


def marker(values, start):
    known = {v for v in values if v is not None and (start is None or v >= start)}
    last = (min(known) if start is None else start - 1) - (start is None) if known else None
    while known and last + 1 in known:
        last += 1
    return None if last is None or (start is not None and last < start) else last


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.none() | st.integers(-5, 60), max_size=60), st.integers(0, 20), st.integers(0, 40))
def test_gaps_and_marker(spark, values, start, length):
    loaded = heights(spark, values)
    got = sorted(map(tuple, op.pending_ranges(loaded, start, start + length).collect()))
    assert got == gaps(values, start, start + length)
    for first in (None, start):
        assert op.contiguous_marker(loaded, first).collect()[0][0] == marker(values, first)


def test_marker_stays_below_a_block_that_failed(spark):
    loaded = spark.range(210_000, 260_000).select(F.col("id").alias("height")).where("height <> 234567")
    assert op.contiguous_marker(loaded, 210_000).first()[0] == 234_566
    assert op.progress_marker(loaded).first()[0] == 259_999
    assert [tuple(r) for r in op.pending_ranges(loaded, 210_000, 260_010).collect()] == [(234567, 234567), (260000, 260009)]


def test_numbers_across_partitions(spark):
    values = [(i * 7919 % 5000, f"x{i % 3}") for i in range(5000)] + [(77, "hot")] * 3000 + [(None, "a")] * 2
    rows = spark.createDataFrame(values, "k long, number string").repartition(6)
    got = sorted((r.place, r.k) for r in op.numbered(rows, "k", name="place").collect())
    want = sorted((v[0] for v in values), key=lambda k: (k is not None, k))
    assert got == list(enumerate(want))
    assert op.numbered(rows, "k").columns == ["k", "number"]
    assert op.numbered(rows.limit(0), "k").count() == 0


def test_no_window_over_all_rows(spark):
    rows = spark.range(1000).select(F.col("id").alias("height"), F.col("id").cast(COIN).alias("fee_btc"))
    for result in (op.positional_series(rows, 0, 999), op.pending_ranges(rows, 0, 2000), op.contiguous_marker(rows, 0)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window " in line]
        assert windows and all("_part" in line for line in windows)


def test_equal_points_are_shared_out(spark):
    from blockfee.operators.ordered import dealt_by_range

    rows = spark.range(8000).select(F.lit(5).alias("height"))
    most = dealt_by_range(rows, "height").groupBy("_part").count().agg(F.max("count")).first()[0]
    assert most < 4000


def test_positional_series(spark):
    rows = spark.createDataFrame([(5, "2"), (3, "1"), (5, "1"), (9, "0")], "height long, fee string")
    fees = rows.select("height", F.col("fee").cast(COIN).alias("fee_btc"))
    got = sorted((r.position, r.height, int(r.fee_btc)) for r in op.positional_series(fees, 3, 5, 100).collect())
    assert got == [(100, 3, 1), (101, 5, 1), (102, 5, 2)]


def test_cells_give_their_fees_back(spark):
    fees = spark.createDataFrame([(1, "0.5", 50_000_000, "node"), (2, None, None, "node")], "height long, f string, fee_sat long, source string")
    fees = fees.select("height", F.col("f").cast(COIN).alias("fee_btc"), "fee_sat", "source")
    for value in ("fee_btc", "fee_sat"):
        assert sorted(op.cell_fees(op.fee_cells(fees, value)).collect()) == sorted(fees.collect())


@pytest.mark.parametrize("column", ["previous", "_part"])
def test_clashing_columns(spark, column):
    rows = spark.createDataFrame([(1, 9), (2, 8)], f"height long, {column} long")
    if column == "previous":
        assert sorted(map(tuple, op.with_previous(rows, "height", 0).collect())) == [(1, 0), (2, 1)]
