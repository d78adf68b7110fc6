"""What is written and shuffled for a lookup, and what a file read whole may hold."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from blockfee import operators as op
from blockfee import plans, sinks
from blockfee.functions import pack_id, unpack_id
from catalogue import queries
from tests.lines import OTHER, TXID, frame, node_line
from tests.test_operators import transactions

SF_DIR = "/root/testdata/sf0.001"


def plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_packed_ids_come_back(spark):
    texts = [TXID, OTHER, TXID.upper(), TXID + "\n", TXID[:-1], "", "junk", "é" * 32, "a" * 32, "\0" * 33, None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, txid string")
    packed = rows.select("i", pack_id(F.col("txid")).alias("p")).select("i", "p", unpack_id(F.col("p")).alias("txid")).collect()
    assert [r.txid for r in sorted(packed)] == texts
    assert len({None if r.p is None else bytes(r.p) for r in packed}) == len(texts)
    assert [len(r.p) for r in sorted(packed)[:2]] == [32, 32]


def test_odd_ids_are_looked_up(spark):
    texts = [TXID, TXID.upper(), TXID + "\n", "", "junk", None]
    parsed = spark.createDataFrame(
        [(t, r) for t in texts for r in (None, "bad_height")], "txid string, reason string"
    )
    known = op.coinbase_values(transactions(spark, *[(t, ["26"]) for t in texts if t is not None]))
    found = op.look_up_coinbase(parsed, known)
    assert found.columns == ["txid", "reason", "first_value", "total_value", "n_outputs"]
    rows = {(r.txid, r.reason, r.n_outputs) for r in found.collect()}
    good = {(t, None, 1) for t in texts if t is not None} | {(None, "missing_transaction", None)}
    assert rows == good | {(t, "bad_height", None) for t in texts}
    attached = op.attach_coinbase(parsed, known)
    assert attached.columns[0] == "txid"
    assert sorted(r.txid for r in attached.collect()) == sorted([t for t in texts if t is not None] * 2)


def test_whole_files_are_small(spark, monkeypatch):
    seen = []
    read = queries.sources.read_lines

    def spy(spark, path, **options):
        seen.append(path)
        return read(spark, path, **options)

    monkeypatch.setattr(queries.sources, "read_lines", spy)
    monkeypatch.setattr(queries, "LINES_PER_WHOLE_FILE", 100)
    blocks = queries.whole_files(spark, SF_DIR).count()
    lines = [len(f.read_text().splitlines()) for f in Path(seen[0].removeprefix("file:")).glob("part-*")]
    assert sum(lines) == blocks == 1500
    assert max(lines) <= 100


def test_refused_lines_are_not_looked_up(spark, tmp_path, monkeypatch):
    known, table, refused = (str(tmp_path / name) for name in ("k", "t", "q"))
    sinks.put_coinbase(op.coinbase_values(transactions(spark, (TXID, ["26"]))), known, 0, digits=1)
    looked_up = []
    look_up = plans.puts.look_up_coinbase

    def spy(parsed, coinbase):
        looked_up.append(parsed.count())
        return look_up(parsed, coinbase)

    monkeypatch.setattr(plans.puts, "look_up_coinbase", spy)
    counts = {}
    put = plans.put_node_fees(sinks.coinbase_reader(spark, known), table, refused, report=lambda _, c: counts.update(c))
    put(frame(spark, node_line(), node_line("210001", tx=[OTHER]), "stray", ""), 0)
    assert looked_up == [2]
    assert {k: v for k, v in counts.items() if v} == {
        "lines": 4, "ok": 1, "missing_transaction": 1, "stray_text": 1, "empty_line": 1}
    rows = sinks.read_table(spark, refused).collect()
    assert sorted((r.reason, r.value) for r in rows if r.value is not None) == [("empty_line", ""), ("stray_text", "stray")]


def ids(first, stop):
    return [f"{i:064x}"[::-1] for i in range(first, stop)]


def test_a_reader_leaves_out_what_nobody_asks_for(spark, tmp_path):
    path = str(tmp_path / "k")
    many = spark.createDataFrame([(t,) for t in ids(0, 5000)], "txid string").selectExpr(
        "txid", "CAST(1 AS decimal(18,8)) AS first_value", "CAST(1 AS decimal(28,8)) AS total_value", "1 AS n_outputs"
    )
    sinks.put_coinbase(many, path, 0, digits=1)
    asked = ids(0, 100) + ids(9000, 9010)
    parsed = spark.createDataFrame([(t, None) for t in asked] * 3 + [(None, None)], "txid string, reason string")
    found = [r.txid for r in sinks.coinbase_reader(spark, path)(parsed).collect()]
    assert set(ids(0, 100)) <= set(found) and len(found) == len(set(found)) < 1000


@pytest.mark.parametrize("count", [0, 1, 10**12])
def test_any_number_of_ids_can_be_asked_for(spark, count):
    table = spark.createDataFrame([(t,) for t in ids(0, 300)], "txid string")
    wanted = spark.createDataFrame([(t,) for t in ids(0, 40)], "txid string")
    found = {r.txid for r in sinks.coinbase._perhaps_among(table, wanted, count).collect()}
    assert set(ids(0, 40)) <= found and len(found) < 60


def test_redriving_looks_up_once(spark, tmp_path, monkeypatch):
    known, table, refused = (str(tmp_path / name) for name in ("k", "t", "q"))
    sinks.put_coinbase(op.coinbase_values(transactions(spark, (TXID, ["26"]))), known, 0, digits=1)
    reader = sinks.coinbase_reader(spark, known)
    plans.put_node_fees(reader, table, refused)(frame(spark, node_line("210001", tx=[OTHER])), 0)
    written = []
    staged = plans.puts._staged

    def spy(rows, path):
        written.append(plan(rows))
        return staged(rows, path)

    monkeypatch.setattr(plans.puts, "_staged", spy)
    plans.redrive_node_fees(reader, table, refused)(spark, 0)
    # The transactions are merged for one lookup, not for a second one that tells which have come.
    assert written[-1].count("min(struct") + written[-1].count("min(named_struct") == 1
    assert sum("Join" in line for line in written[-1].splitlines()) == 2


def test_streamed_dumps_and_tables_are_compressed(spark, monkeypatch, tmp_path):
    seen = []
    stream = queries.sources.stream_lines

    def spy(spark, path, *args):
        seen.append(path)
        return stream(spark, path, *args)

    monkeypatch.setattr(queries.sources, "stream_lines", spy)
    assert queries.stream_fee_node(spark, SF_DIR).count() == 1473
    dump = Path(seen[0].removeprefix("file:"))
    assert all(f.name.endswith(".gz") for f in dump.glob("part-*"))
    sinks.put_batch(spark.range(10), str(tmp_path / "t"), 0)
    assert all(".zstd." in f.name for f in (tmp_path / "t").rglob("part-*"))


def test_node_fees_put_three_times_are_looked_up_once(spark, monkeypatch):
    joins = []
    put = sinks.put_batch

    def spy(rows, *args, **options):
        joins.append("Join" in plan(rows))
        put(rows, *args, **options)

    monkeypatch.setattr(queries.sinks, "put_batch", spy)
    queries.fee_table_upsert(spark, SF_DIR)
    assert joins == [False, True, False, False, False]
