import pytest
from pyspark.sql import functions as F

from blockfee import operators as op
from blockfee import sinks
from blockfee.schemas import CELL
from tests.test_operators import transactions


def cells(spark, **values):
    return spark.createDataFrame([(k, "f", "q", v) for k, v in values.items()], CELL)


def latest(spark, path, **options):
    rows = sinks.latest_by_key(sinks.read_table(spark, path), **options).collect()
    return {r.rowkey: r.value for r in rows}


def test_newest_put_wins_and_replay_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.put_batch(cells(spark, a="1", b="1"), path, 0)
    sinks.put_batch(cells(spark, b="2", c="2"), path, 1)
    want = {"a": "1", "b": "2", "c": "2"}
    assert latest(spark, path) == want
    sinks.put_batch(cells(spark, a="1", b="1"), path, 0)
    assert latest(spark, path) == want
    assert sinks.read_table(spark, path).count() == 4


def test_compacted_table_takes_further_puts(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.put_batch(cells(spark, a="1", b="1"), path, 0)
    sinks.put_batch(cells(spark, b="2"), path, 1)
    sinks.compact(spark, path)
    assert sinks.read_table(spark, path).count() == 2
    assert latest(spark, path) == {"a": "1", "b": "2"}
    # A late replay of an old batch loses against what is there.
    sinks.put_batch(cells(spark, a="1", b="1"), path, 0)
    sinks.put_batch(cells(spark, a="3"), path, 2)
    assert latest(spark, path) == {"a": "3", "b": "2"}
    sinks.compact(spark, path)
    assert latest(spark, path) == {"a": "3", "b": "2"}
    assert sinks.read_table(spark, path).count() == 2


def test_compaction_beside_a_writer(spark, tmp_path, monkeypatch):
    """What is put while a snapshot is written is after it."""
    path = str(tmp_path / "t")
    sinks.put_batch(cells(spark, a="1", b="1"), path, 0)
    write = sinks.tables._write

    def write_late(rows, target, partition_by, mode, sort_by):
        if sinks.tables.SNAPSHOT in target:
            monkeypatch.setattr(sinks.tables, "_write", write)
            sinks.put_batch(cells(spark, c="9"), path, 1)
            sinks.put_batch(cells(spark, d="9"), path, 0, writer="new")
        write(rows, target, partition_by, mode, sort_by)

    monkeypatch.setattr(sinks.tables, "_write", write_late)
    sinks.compact(spark, path)
    assert latest(spark, path) == {"a": "1", "b": "1", "c": "9", "d": "9"}
    assert sinks.replaced(spark, path) == [f"{path}/writer=batch/batch=0"]


def test_many_batches_and_compactions(spark, tmp_path):
    path, want = str(tmp_path / "t"), {}
    for batch in range(24):
        put = {f"k{batch % 7}": str(batch), f"n{batch}": "1"}
        want |= put
        sinks.put_batch(cells(spark, **put).coalesce(1), path, batch, writer=f"w{batch % 2}")
        if batch % 10 == 9:
            sinks.compact(spark, path)
            files = sinks.read_table(spark, path).select(F.input_file_name()).distinct()
            assert files.count() <= 8
    assert latest(spark, path) == want


def test_sources_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    for source, unit, value in (("node", "coin", "1.0"), ("explorer", "satoshi", "100000000")):
        rows = cells(spark, a=value).withColumns({"source": F.lit(source), "unit": F.lit(unit)})
        sinks.put_batch(rows, path, 0, writer=source)
    rows = sinks.latest_by_key(sinks.read_table(spark, path)).collect()
    assert sorted((r.source, r.unit, r.value) for r in rows) == [
        ("explorer", "satoshi", "100000000"), ("node", "coin", "1.0"),
    ]


def test_corrected_and_ambiguous_transactions(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = "0a" + "1" * 62, "0b" + "1" * 62
    sinks.put_coinbase(op.coinbase_values(transactions(spark, (first, ["25", "9"]), (second, ["1"]))), path, 0)
    sinks.put_coinbase(op.coinbase_values(transactions(spark, (first, ["30", "1"]), (second, ["1"]), (second, ["2"]))), path, 1)
    parsed = spark.createDataFrame([(1, first, None), (2, second, None)], "height long, txid string, reason string")
    for _ in range(2):
        found = op.look_up_coinbase(parsed, sinks.coinbase_reader(spark, path)(parsed))
        rows = {r.height: r for r in found.collect()}
        assert (rows[1].first_value, rows[1].total_value, rows[1].reason) == (30, 31, None)
        assert rows[2].reason == "ambiguous_transaction"
        sinks.compact_coinbase(spark, path)
    # The later put settles it.
    sinks.put_coinbase(op.coinbase_values(transactions(spark, (second, ["4"]))), path, 2)
    found = op.look_up_coinbase(parsed, sinks.coinbase_reader(spark, path)(parsed))
    assert {r.height: (r.first_value, r.reason) for r in found.collect()} == {1: (30, None), 2: (4, None)}


def test_digits_are_kept_with_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    txid = "0a" + "1" * 62
    values = op.coinbase_values(transactions(spark, (txid, ["1"])))
    sinks.put_coinbase(values, path, 0, digits=1)
    parsed = spark.createDataFrame([(txid, None)], "txid string, reason string")
    assert sinks.coinbase_reader(spark, path)(parsed).count() == 1
    with pytest.raises(ValueError, match="digits"):
        sinks.put_coinbase(values, path, 1, digits=2)
    with pytest.raises(ValueError, match="digits"):
        sinks.put_coinbase(values, str(tmp_path / "u"), 1, digits=9)


def test_partitioned_put(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).select(
        F.col("id").alias("height"), (F.col("id") - F.pmod("id", F.lit(50))).alias("height_range")
    )
    sinks.put_batch(rows, path, 0, partition_by=["height_range"])
    table = sinks.read_table(spark, path).where("height_range = 50")
    assert table.count() == 50
    filters = table._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]
    assert "height_range" in filters.split("PushedFilters")[0]


def test_order_by_sequence_before_batch(spark):
    rows = spark.createDataFrame(
        [("a", "old", 2, 0), ("a", "new", 1, 9), ("b", "x", 1, None), ("b", "y", 1, None)],
        "k string, value string, put_id int, seq int",
    )
    by_seq = sinks.latest_by_key(rows, keys=["k"], order=["seq", "put_id"])
    assert {r.k: r.value for r in by_seq.collect()} == {"a": "new", "b": "y"}
    by_put = sinks.latest_by_key(rows, keys=["k"], order=["put_id", "seq"])
    assert {r.k: r.value for r in by_put.collect()} == {"a": "old", "b": "y"}


def test_coinbase_table_is_read_in_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    first, numeric, other = "0a" + "1" * 62, "1e" + "2" * 62, "07" + "3" * 62
    sinks.put_coinbase(op.coinbase_values(transactions(spark, (first, ["1"]))), path, 0)
    rest = transactions(spark, (first, ["1"]), (numeric, ["2"]), (other, ["3"]))
    sinks.put_coinbase(op.coinbase_values(rest), path, 1)
    parsed = spark.createDataFrame(
        [(first, None), (numeric, None), ("junk", "bad_txid")], "txid string, reason string"
    )
    known = sinks.coinbase_reader(spark, path)(parsed)
    assert sorted((r.txid, r.first_value) for r in known.collect()) == [(first, 1), (numeric, 2)]
    text = known._jdf.queryExecution().executedPlan().toString()
    assert "prefix" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    nothing = sinks.coinbase_reader(spark, path)(parsed.where("reason is not null"))
    assert nothing.count() == 0


def test_a_lower_number_after_a_snapshot_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.put_batch(cells(spark, a="5", b="5"), path, 5)
    sinks.compact(spark, path)
    sinks.put_batch(cells(spark, b="3", c="3"), path, 3)
    sinks.put_batch(cells(spark, c="-1", d="-1"), path, -1)
    want = {"a": "5", "b": "5", "c": "3", "d": "-1"}
    assert latest(spark, path) == want
    sinks.compact(spark, path)
    sinks.put_batch(cells(spark, d="4", a="4"), path, 4)
    assert latest(spark, path) == want | {"d": "4"}


def test_a_batch_put_again_after_a_snapshot_replaces_itself(spark, tmp_path):
    """Its old cells go, the new ones come, and what it had covered comes back."""
    path = str(tmp_path / "t")
    sinks.put_batch(cells(spark, a="4", k="4"), path, 4)
    sinks.put_batch(cells(spark, a="5", b="5", k="5"), path, 5)
    sinks.compact(spark, path)
    sinks.put_batch(cells(spark, z="6"), path, 6)
    sinks.compact(spark, path)
    sinks.put_batch(cells(spark, a="5 right"), path, 5)
    want = {"a": "5 right", "k": "4", "z": "6"}
    for _ in range(2):
        assert latest(spark, path) == want
        sinks.compact(spark, path)
    sinks.put_batch(cells(spark, z="6 right"), path, 6)
    assert latest(spark, path) == want | {"z": "6 right"}


def test_half_written_puts_and_snapshots_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.put_batch(cells(spark, a="1"), path, 0)
    sinks.put_batch(cells(spark, a="2"), path, 0)
    (tmp_path / "t/writer=batch/batch=0/rev=1/_SUCCESS").unlink()
    assert latest(spark, path) == {"a": "1"}
    sinks.put_batch(cells(spark, a="3"), path, 0)
    assert latest(spark, path) == {"a": "3"}
    cells(spark, a="junk").write.parquet(f"{path}/writer={sinks.tables.SNAPSHOT}/batch=0/rev=0")
    assert latest(spark, path) == {"a": "3"}
    sinks.compact(spark, path)
    assert latest(spark, path) == {"a": "3"} and sinks.read_log(spark, path).current() == 0


def test_removed_batches_are_closed(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(4):
        sinks.put_batch(cells(spark, **{f"k{batch}": str(batch), "a": str(batch)}), path, batch)
    sinks.put_batch(cells(spark, s="0"), path, 0, writer="stream-x")
    sinks.compact(spark, path)
    want = {"k0": "0", "k1": "1", "k2": "2", "k3": "3", "a": "3", "s": "0"}
    # The snapshot holds what a stream may still put again, so it can't stand alone.
    assert sinks.remove_replaced(spark, path) == []
    sinks.put_batch(cells(spark, s="0"), path, 0, writer="stream-x")
    sinks.compact(spark, path, open_batches=1)
    gone = sinks.remove_replaced(spark, path)
    assert [d.split("/t/")[1] for d in gone] == [
        "writer=batch/batch=0", "writer=batch/batch=1", "writer=batch/batch=2",
        "writer=stream-x/batch=0/rev=0", "writer=~snapshot/batch=0",
    ]
    assert not (tmp_path / "t/writer=batch/batch=1").exists()
    assert latest(spark, path) == want
    with pytest.raises(ValueError, match="batch 1 of 'batch' is closed"):
        sinks.put_batch(cells(spark, k1="x"), path, 1)
    # A number between closed ones that was never put is free; open ones take revisions.
    sinks.put_batch(cells(spark, n="-7"), path, -7)
    sinks.put_batch(cells(spark, k3="3", a="3"), path, 3)
    want = want | {"n": "-7"}
    assert latest(spark, path) == want
    sinks.compact(spark, path)
    assert latest(spark, path) == want
    sinks.put_batch(cells(spark, k3="3 right"), path, 3)
    want = want | {"k3": "3 right", "a": "2"}
    assert latest(spark, path) == want
    sinks.put_batch(cells(spark, z="9"), path, 9)
    sinks.put_batch(cells(spark, z="9"), path, 9, writer="stream-x")
    sinks.compact(spark, path, open_batches=1)
    sinks.remove_replaced(spark, path)
    assert latest(spark, path) == want | {"z": "9"}
    assert sorted(p.name for p in (tmp_path / "t/writer=~snapshot").iterdir() if p.name[0] != ".") == ["batch=3"]


def test_empty_batches_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = cells(spark, a="1").withColumn("part", F.lit(10))
    sinks.put_batch(rows.limit(0), path, 0, partition_by=["part"])
    assert sinks.read_table(spark, path).count() == 0
    sinks.compact(spark, path)
    sinks.put_batch(rows.withColumn("seq", F.lit(3).cast("long")), path, 1, partition_by=["part"])
    sinks.put_batch(cells(spark, b="1").withColumn("part", F.lit(10)), path, 2, partition_by=["part"])
    table = sinks.read_table(spark, path)
    assert sorted((r.rowkey, r.seq, r.part) for r in table.collect()) == [("a", 3, 10), ("b", None, 10)]
    sinks.compact(spark, path)
    assert (tmp_path / "t/writer=~snapshot/batch=1/rev=0/part=10").exists()
    with pytest.raises(ValueError, match="partitions"):
        sinks.put_batch(rows, path, 3)
    with pytest.raises(ValueError, match="seq is"):
        sinks.put_batch(rows.withColumn("seq", F.lit("x")), path, 3, partition_by=["part"])


def test_reading_takes_no_job(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(3):
        sinks.put_batch(cells(spark, a=str(batch)), path, batch)
        sinks.compact(spark, path)
    spark.sparkContext.setJobGroup("reading", "reading")
    sinks.read_table(spark, path)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("reading")) == []
    spark.sparkContext.setJobGroup("", "")
