from pyspark.sql import functions as F

from blockfee import operators as op
from blockfee import plans, sinks, sources, streaming
from blockfee.cli import main
from tests.lines import OTHER, TXID, explorer_line, frame, node_line
from tests.test_operators import transactions

THIRD = "e" * 64


def put_known(spark, path, batch, *values):
    sinks.put_coinbase(op.coinbase_values(transactions(spark, *values)), path, batch, digits=1)


def values(spark, table):
    return sorted((r.rowkey, r.value, r.put_by, r.put_id) for r in sinks.read_table(spark, table).collect())


def test_late_transactions(spark, tmp_path):
    known, table, refused = (str(tmp_path / name) for name in ("k", "t", "q"))
    put_known(spark, known, 0, (TXID, ["26"]))
    reader = sinks.coinbase_reader(spark, known)
    lines = frame(spark, node_line(), *[node_line("210001", tx=[OTHER])] * 3, node_line("210002", tx=[THIRD]), "stray",
                  node_line("210003", tx=["d" * 64]))
    plans.put_node_fees(reader, table, refused)(lines, 0)
    first = [("210000", "1.00000000", "batch", 0)]
    redrive = plans.redrive_node_fees(reader, table, refused)
    redrive(spark, 0)
    assert values(spark, table) == first
    put_known(spark, known, 1, (OTHER, ["27"]), (THIRD, ["9"]), (THIRD, ["8"]))
    late = [("210001", "2.00000000", "redrive", 1)]
    for batch in (1, 1, 2):  # run again, and once more with nothing to do
        redrive(spark, batch)
        assert values(spark, table) == first + late
    # An ambiguous transaction waits until a later put settles it.
    put_known(spark, known, 2, (THIRD, ["28"]))
    redrive(spark, 3)
    settled = [("210002", "3.00000000", "redrive", 3)]
    # A number taken before puts again what it put, and what has come since.
    redrive(spark, 1)
    assert values(spark, table) == sorted(first + late + settled)
    rows = sinks.read_table(spark, refused)
    assert {r.reason: r.n for r in rows.groupBy("reason").agg(F.count("*").alias("n")).collect()} == {
        "missing_transaction": 5, "stray_text": 1, "redriven": 2}
    assert not list((tmp_path / "t/_staged").iterdir())


def test_failure_between_the_puts(spark, tmp_path, monkeypatch):
    known, table, refused = (str(tmp_path / name) for name in ("k", "t", "q"))
    put_known(spark, known, 0, (TXID, ["26"]))
    reader = sinks.coinbase_reader(spark, known)
    plans.put_node_fees(reader, table, refused)(frame(spark, node_line("210001", tx=[OTHER])), 0)
    put_known(spark, known, 1, (OTHER, ["27"]))
    put = plans.puts.put_batch

    def failing(rows, path, *args):
        if path == refused:
            raise RuntimeError("lost")
        put(rows, path, *args)

    monkeypatch.setattr(plans.puts, "put_batch", failing)
    redrive = plans.redrive_node_fees(reader, table, refused)
    try:
        redrive(spark, 0)
    except RuntimeError:
        pass
    monkeypatch.undo()
    redrive(spark, 0)
    assert values(spark, table) == [("210001", "2.00000000", "redrive", 0)]


def test_counts_of_every_batch(spark, tmp_path):
    known, dump = str(tmp_path / "k"), tmp_path / "lines"
    dump.mkdir()
    put_known(spark, known, 0, (TXID, ["26"]))
    texts = [[node_line(), "", "stray"], [node_line("210001", tx=[OTHER])], [node_line("x"), node_line("210002"), node_line("210003")]]
    for i, lines in enumerate(texts):
        (dump / f"{i}.txt").write_text("\n".join(lines) + "\n")
    seen = {}
    table, refused = str(tmp_path / "t"), str(tmp_path / "q")
    put = plans.put_node_fees(sinks.coinbase_reader(spark, known), table, refused, report=seen.__setitem__)
    source = sources.stream_lines(spark, str(dump), max_files_per_trigger=1)
    streaming.run_stream(source, put, str(tmp_path / "c"), interval=None)
    assert sorted(c["lines"] for c in seen.values()) == [1, 3, 3]
    puts = {r.put_id: r["count"] for r in sinks.read_table(spark, table).groupBy("put_id").count().collect()}
    left = {r.put_id: r["count"] for r in sinks.read_table(spark, refused).groupBy("put_id").count().collect()}
    for batch, counts in seen.items():
        assert counts["lines"] == puts.get(batch, 0) + left.get(batch, 0)
        assert counts["ok"] == puts.get(batch, 0)
        assert sum(counts.values()) == 2 * counts["lines"]
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    explorer = {}
    put = plans.put_explorer_fees(str(tmp_path / "e"), plans.DROP, report=explorer.__setitem__)
    put(frame(spark, explorer_line(), explorer_line("None"), ""), 4)
    assert {k: v for k, v in explorer[4].items() if v} == {"lines": 3, "ok": 1, "bad_height": 1, "empty_line": 1}


def test_jobs(spark, tmp_path, capsys):
    path = {name: str(tmp_path / name) for name in ("dump", "tx", "late", "t", "q", "h", "e", "b")}
    (tmp_path / "dump").mkdir()
    (tmp_path / "dump/a").write_text("\n".join([node_line(), node_line("210001", tx=[OTHER]), node_line("210002")]))
    transactions(spark, (TXID, ["26"])).write.parquet(path["tx"])
    transactions(spark, (OTHER, ["27"])).write.parquet(path["late"])
    lines, table = ["--lines", path["dump"]], ["--table", path["t"]]
    main(["node-batch", *lines, *table, "--transactions", path["tx"], "--batch-id", "0", "--quarantine", path["q"]])

    def result(job, *more):
        out = str(tmp_path / f"out-{job}-{len(list(tmp_path.iterdir()))}")
        main([job, "--out", out, *more])
        return sorted(map(tuple, spark.read.parquet(out).collect()))

    assert result("marker", *table) == [(210000,)]
    span = ["--first", "210000", "--stop", "210010"]
    assert result("pending", *table, *span, "--ranges") == [(210001, 210001), (210003, 210009)]
    main(["redrive", *table, "--quarantine", path["q"], "--transactions", path["late"], "--batch-id", "0"])
    assert result("marker", *table, "--first", "210000") == [(210002,)]
    assert result("marker", *table, "--first", "209999") == [(None,)]
    points = result("positions", *table, "--first", "210001", "--last", "210002", "--start", "5")
    assert [p[:2] for p in points] == [(5, 210001), (6, 210002)]
    capsys.readouterr()
    for said in ("refreshed: all", "refreshed: 0 ranges"):
        main(["refresh-buckets", *table, "--out", path["b"]])
        assert said in capsys.readouterr().out
    assert sinks.read_buckets(spark, path["b"]).first().blocks == 3
    main(["load-headers", *lines, "--table", path["h"], "--batch-id", "0"])
    main(["load-edges", *lines, "--table", path["e"], "--batch-id", "0"])
    assert len(result("blocks", "--table", path["h"], "--first", "210001", "--stop", "210002")) == 1
    assert len(result("blocks", "--table", path["e"], "--first", "210000", "--stop", "210002")) == 3
    main(["compact", *table, "--open", "1"])
    main(["remove-replaced", *table])
    assert len(values(spark, path["t"])) == 3
