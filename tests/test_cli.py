import pytest

from blockfee import sinks
from blockfee.cli import main
from tests.lines import OTHER, TXID, explorer_line, node_line
from tests.test_operators import transactions


@pytest.fixture
def places(spark, tmp_path):
    dump = tmp_path / "lines"
    dump.mkdir()
    known = str(tmp_path / "tx")
    transactions(spark, (TXID, ["26", "2"])).write.parquet(known)
    return {
        "dump": dump,
        "transactions": known,
        **{name: str(tmp_path / name) for name in ("table", "checkpoint", "quarantine", "out")},
    }


def values(spark, table):
    return {r.rowkey: r.value for r in sinks.read_table(spark, table).collect()}


def node_args(job, p, *more):
    args = [job, "--lines", str(p["dump"]), "--transactions", p["transactions"]]
    return [*args, *more]


def test_node_batch_then_pending(spark, places):
    (places["dump"] / "a").write_text(node_line() + "\n" + node_line("210001", tx=[OTHER]) + "\n\n")
    table = ["--table", places["table"]]
    main(node_args("node-batch", places, *table, "--batch-id", "0", "--quarantine", places["quarantine"]))
    assert values(spark, places["table"]) == {"210000": "1.00000000"}
    refused = sinks.read_table(spark, places["quarantine"]).collect()
    assert sorted(r.reason for r in refused) == ["empty_line", "missing_transaction"]

    main(["pending", *table, "--out", places["out"], "--first", "210000", "--stop", "210003"])
    assert sorted(r.height for r in spark.read.parquet(places["out"]).collect()) == [210001, 210002]


def test_node_rules(spark, places):
    (places["dump"] / "a").write_text(node_line("420000"))
    table = ["--table", places["table"]]
    batch = ["--fail-fast", "--batch-id"]
    main(node_args("node-batch", places, *table, *batch, "0", "--outputs", "all"))
    assert values(spark, places["table"]) == {"420000": "15.50000000"}
    main(node_args("node-batch", places, *table, *batch, "0", "--mode", "positional", "--subsidy", "fixed"))
    assert values(spark, places["table"]) == {"420000": "1.00000000"}


def test_a_second_load_loses_nothing(spark, places, tmp_path):
    table = ["--table", places["table"], "--quarantine", places["quarantine"]]
    (places["dump"] / "a").write_text(node_line())
    other = tmp_path / "other"
    other.mkdir()
    (other / "a").write_text(node_line("210007"))
    main(node_args("node-batch", places, *table, "--batch-id", "1"))
    again = ["node-batch", "--lines", str(other), "--transactions", places["transactions"], *table]
    with pytest.raises(ValueError, match="input-batch-1"):
        main([*again, "--batch-id", "1"])
    main([*again, "--batch-id", "2"])
    main([*again, "--batch-id", "1", "--writer", "second"])
    puts = sinks.read_table(spark, places["table"]).collect()
    assert sorted((r.rowkey, r.put_by, r.put_id) for r in puts) == [
        ("210000", "batch", 1), ("210007", "batch", 2), ("210007", "second", 1),
    ]
    # A replay changes nothing.
    main(node_args("node-batch", places, *table, "--batch-id", "1"))
    assert sorted(sinks.read_table(spark, places["table"]).collect()) == sorted(puts)


def test_a_second_coinbase_load_and_new_checkpoints_lose_nothing(spark, places, tmp_path):
    known, more = str(tmp_path / "known"), str(tmp_path / "more")
    transactions(spark, (OTHER, ["27"])).write.parquet(more)
    load = ["--coinbase", known, "--digits", "1", "--batch-id"]
    main(["coinbase", "--transactions", places["transactions"], *load, "0"])
    with pytest.raises(ValueError, match="input"):
        main(["coinbase", "--transactions", more, *load, "0"])
    main(["coinbase", "--transactions", more, *load, "1"])
    for number, (height, txid) in enumerate((("210000", TXID), ("210001", OTHER))):
        (places["dump"] / "a").write_text(node_line(height, tx=[txid]))
        main(
            ["node-stream", "--lines", str(places["dump"]), "--coinbase", known, "--interval", "", "--fail-fast"]
            + ["--table", places["table"], "--checkpoint", f"{places['checkpoint']}{number}"]
        )
    assert values(spark, places["table"]) == {"210000": "1.00000000", "210001": "2.00000000"}


def test_every_line_is_accounted_for(spark, places, capsys):
    lines = [node_line(), "", "stray", node_line("210001", tx=[OTHER]), node_line("x"), node_line()[:-4]]
    (places["dump"] / "a").write_text("\n".join(lines))
    table = ["--table", places["table"], "--batch-id"]
    main(node_args("node-batch", places, *table, "0", "--drop-refused"))
    said = capsys.readouterr().out
    for reason in ("empty_line", "stray_text", "missing_transaction", "bad_height", "truncated", "ok"):
        assert f"batch 0: {reason}: 1 lines" in said
    with pytest.raises(Exception, match="unusable line"):
        main(node_args("node-batch", places, "--table", places["out"], "--batch-id", "0", "--fail-fast"))
    main(node_args("node-batch", places, *table, "1", "--quarantine", places["quarantine"]))
    put = sinks.read_table(spark, places["table"]).where("put_id = 1").count()
    assert put + sinks.read_table(spark, places["quarantine"]).count() == len(lines)


def test_results_of_a_fee_table(spark, places, tmp_path):
    heights = range(210000, 210030)
    (places["dump"] / "a").write_text("\n".join(node_line(str(h)) for h in heights))
    table = ["--table", places["table"]]
    main(node_args("node-batch", places, *table, "--batch-id", "0", "--fail-fast"))
    explorer = tmp_path / "explorer"
    explorer.mkdir()
    (explorer / "a").write_text("\n".join(explorer_line(str(h), str(h)) for h in heights))
    main(["explorer-batch", "--lines", str(explorer), *table, "--batch-id", "0", "--writer", "explorer", "--fail-fast"])

    def result(job, *more):
        out = str(tmp_path / f"{job}-{len(more)}")
        main([job, *table, "--out", out, *more])
        return [tuple(r) for r in spark.read.parquet(out).collect()]

    assert [r[0] for r in sorted(result("series", "--first", "210005", "--last", "210007"))] == [210005, 210006, 210007]
    assert [(r[0], r[1]) for r in result("buckets", "--blocks", "10")] and len(result("buckets")) == 1
    assert len(result("outliers", "--above", "0")) == 30 and not result("outliers", "--above", "1", "--source", "node")
    assert len(result("top", "--rows", "4")) == 4
    assert {r[4] for r in result("reconcile")} == {"differ"}
    assert result("marker") == [(210029,)]


def test_headers_and_edges_after_a_marker(spark, places, tmp_path):
    (places["dump"] / "a").write_text(node_line("210000") + "\n" + node_line("210001"))
    mark = str(tmp_path / "marker")
    spark.createDataFrame([(210000,)], "last_block_processed long").write.parquet(mark)
    for job, rows, after in (("headers", 2, 1), ("edges", 4, 2)):
        run = [job, "--lines", str(places["dump"]), "--out"]
        main([*run, str(tmp_path / job)])
        main([*run, str(tmp_path / f"{job}-after"), "--after", mark])
        assert spark.read.parquet(str(tmp_path / job)).count() == rows
        assert spark.read.parquet(str(tmp_path / f"{job}-after")).count() == after


def test_pending_reads_the_asked_heights_only(spark, places):
    (places["dump"] / "a").write_text(node_line())
    main(node_args("node-batch", places, "--table", places["table"], "--batch-id", "0", "--fail-fast"))
    from argparse import Namespace

    from blockfee.cli import _loaded

    loaded = _loaded(spark, Namespace(table=places["table"], first=210000, stop=210010))
    filters = loaded._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert "height_range" in filters.split("PushedFilters")[0]


def test_streams(spark, places):
    (places["dump"] / "a").write_text(node_line())
    run = ["--table", places["table"], "--checkpoint", places["checkpoint"], "--interval", "", "--drop-refused"]
    known = places["quarantine"]
    main(["coinbase", "--transactions", places["transactions"], "--coinbase", known, "--batch-id", "0"])
    lines = ["--lines", str(places["dump"]), "--coinbase", known]
    main(["node-stream", *lines, *run, "--max-files", "1"])
    assert values(spark, places["table"]) == {"210000": "1.00000000"}


def test_explorer_jobs(spark, places):
    (places["dump"] / "a").write_text(explorer_line())
    lines = ["--lines", str(places["dump"])]
    main(["explorer-batch", *lines, "--table", places["table"], "--batch-id", "0", "--fail-fast"])
    run = ["--table", places["out"], "--checkpoint", places["checkpoint"], "--interval", "", "--fail-fast"]
    main(["explorer-stream", *lines, *run])
    assert values(spark, places["table"]) == values(spark, places["out"]) == {"210000": "11294626"}


def test_json_stream_and_compaction(spark, places):
    (places["dump"] / "a").write_text('{"id": 1}\n{"id": 1, "n": 2}\n')
    run = ["--table", places["table"], "--checkpoint", places["checkpoint"], "--interval", "", "--fail-fast"]
    main(["json-stream", "--lines", str(places["dump"]), *run, "--seq-path", "$.n"])
    main(["compact", "--table", places["table"], "--kind", "json"])
    assert values(spark, places["table"]) == {"1": '{"id": 1, "n": 2}'}
    assert sinks.read_table(spark, places["table"]).count() == 1


def test_previews(spark, places, capsys):
    (places["dump"] / "a").write_text(node_line())
    main(node_args("node-preview", places))
    assert "|210000|1.00000000|" in capsys.readouterr().out
    (places["dump"] / "a").write_text(explorer_line())
    main(["explorer-preview", "--lines", str(places["dump"]), "--interval", ""])
    # The JVM prints past the capture; the run must just end.
    assert not spark.streams.active
