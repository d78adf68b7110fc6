import pytest
from pyspark.sql import functions as F

from blockfee import operators as op
from blockfee import sinks
from blockfee.schemas import COIN
from blockfee.sinks.ranges import HEIGHT_RANGE


def headers(spark, low, high, mark="a"):
    return spark.range(low, high).select(F.col("id").alias("height"), F.concat(F.lit(mark), "id").alias("hash"))


def test_blocks_are_found_by_partition_and_file_part(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.put_blocks(headers(spark, 0, 45_000).repartition(5), path, 0)
    sinks.put_blocks(headers(spark, 20_000, 20_010, "b"), path, 1)
    for _ in range(2):
        rows = sinks.blocks_between(spark, path, 19_995, 20_015)
        newest = sinks.latest_by_key(rows, keys=["height"])
        want = [(h, f"{'b' if 20_000 <= h < 20_010 else 'a'}{h}") for h in range(19_995, 20_015)]
        assert sorted((r.height, r.hash) for r in newest.collect()) == want
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert HEIGHT_RANGE in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "GreaterThanOrEqual(height,19995), LessThan(height,20015)" in plan.split("PushedFilters: [")[1]
        files = rows.select(F.input_file_name()).distinct().collect()
        assert all(any(f"{HEIGHT_RANGE}={x}" in f[0] for x in (10000, 20000)) for f in files)
        sinks.compact(spark, path, keys=["height"])
    # Within a file heights ascend, in snapshots too.
    for file in (tmp_path / "t/writer=~snapshot").glob("batch=0/rev=0/height_range=*/*.parquet"):
        found = [r.height for r in spark.read.parquet(str(file)).collect()]
        assert found == sorted(found)
    wanted = spark.createDataFrame([(7,), (44_999,), (7,), (99_999,), (None,)], "height long")
    assert sorted(r.hash for r in sinks.blocks_of(spark, path, wanted).collect()) == ["a44999", "a7"]


def fees(spark, low, high, value):
    rows = spark.range(low, high).select(F.col("id").alias("height"), F.lit(value).cast(COIN).alias("fee_btc"), F.lit("node").alias("source"))
    cells = op.fee_cells(rows)
    return cells.withColumn(HEIGHT_RANGE, F.expr("CAST(rowkey AS bigint) div 10000 * 10000"))


def whole(spark, table):
    puts = sinks.read_table(spark, table).where("source = 'node'")
    return sorted(map(tuple, op.fee_buckets(op.cell_fees(sinks.latest_by_key(puts)), 1000).collect()))


def test_only_touched_ranges_are_aggregated_again(spark, tmp_path):
    table, out = str(tmp_path / "t"), str(tmp_path / "b")

    def refreshed():
        done = sinks.refresh_buckets(spark, table, out)
        assert sorted(map(tuple, sinks.read_buckets(spark, out).collect())) == whole(spark, table)
        return done

    def put(rows, batch, **options):
        sinks.put_batch(rows, table, batch, [HEIGHT_RANGE], **options)

    put(fees(spark, 0, 35_000, 1), 0)
    assert refreshed() is None
    before = set((tmp_path / "b").glob("*/part-*"))
    put(fees(spark, 12_000, 13_500, 2), 1)
    assert refreshed() == [10_000]
    after = set((tmp_path / "b").glob("*/part-*"))
    assert len(before & after) >= 3
    assert refreshed() == []
    # Compaction moves cells, but changes none; a put into several ranges, and one by another writer.
    sinks.compact(spark, table)
    assert refreshed() == []
    put(fees(spark, 9_990, 10_010, 3), 2)
    put(fees(spark, 80_000, 80_001, 3), 0, writer="late")
    assert refreshed() == [0, 10_000, 80_000]
    # A batch put again loses cells: where it was and where it is now are done anew.
    put(fees(spark, 30_500, 30_600, 9), 2)
    assert refreshed() == [0, 10_000, 30_000]
    # All cells of a range gone.
    put(fees(spark, 5, 6, 3), 0, writer="late")
    assert refreshed() == [0, 80_000]
    # What was put, compacted and removed in between can't be traced.
    put(fees(spark, 31_000, 31_010, 4), 3)
    put(fees(spark, 1, 2, 4), 4)
    put(fees(spark, 5, 6, 3), 1, writer="late")
    sinks.compact(spark, table, open_batches=1)
    sinks.remove_replaced(spark, table)
    assert refreshed() is None
    with pytest.raises(ValueError, match="divide"):
        sinks.refresh_buckets(spark, table, out, 3000)
    with pytest.raises(ValueError, match="buckets"):
        sinks.refresh_buckets(spark, table, out, 500)


def test_a_refresh_that_failed_is_done_again(spark, tmp_path, monkeypatch):
    table, out = str(tmp_path / "t"), str(tmp_path / "b")
    sinks.put_batch(fees(spark, 0, 20_000, 1), table, 0, [HEIGHT_RANGE])
    sinks.refresh_buckets(spark, table, out)
    sinks.put_batch(fees(spark, 0, 10, 5), table, 1, [HEIGHT_RANGE])
    note = sinks.ranges.note_once

    def failing(spark, path, name, text):
        if name.startswith("refreshed"):
            raise RuntimeError("lost")
        note(spark, path, name, text)

    monkeypatch.setattr(sinks.ranges, "note_once", failing)
    with pytest.raises(RuntimeError):
        sinks.refresh_buckets(spark, table, out)
    monkeypatch.undo()
    assert sinks.refresh_buckets(spark, table, out) == [0]
    assert sorted(map(tuple, sinks.read_buckets(spark, out).collect())) == whole(spark, table)


def test_tables_in_buckets_join_without_shuffle(spark, tmp_path):
    def records(low, high, add):
        return spark.range(low, high).select(F.col("id").alias("height"), (F.col("id") % 7 + add).alias("fee_sat"))

    sides = [records(0, 5000, 0).unionByName(records(10, 11, 3)), records(2500, 7000, F.col("id") % 2)]
    tables = [
        sinks.write_by_height(side, f"side_{i}", str(tmp_path / str(i)), 8) for i, side in enumerate(sides)
    ]
    both = op.compare_sources(*tables)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, op.compare_sources(*sides).collect()))
