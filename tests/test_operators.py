from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from blockfee import operators as op
from blockfee import plans, schemas, sources
from tests.lines import OTHER, TXID, explorer_line, frame, node_line


def transactions(spark, *rows):
    return spark.createDataFrame(
        [(txid, [(n, Decimal(v)) for n, v in enumerate(values)]) for txid, values in rows],
        schemas.TRANSACTION,
    )


def fees(spark, *rows):
    return spark.createDataFrame(
        [(h, Decimal(v), int(Decimal(v) * 10**8), "x") for h, v in rows], schemas.FEE
    )


@pytest.mark.parametrize(
    ("values", "first", "everything"),
    [
        (["25"], "0E-8", "0E-8"),
        (["25.00000050"], "5.0E-7", "5.0E-7"),
        (["10", "16"], "-15", "1"),
        (["225.5", "0"], "200.5", "200.5"),
    ],
)
def test_fee_of_first_and_of_all_outputs(spark, values, first, everything):
    coinbase = op.coinbase_values(transactions(spark, (TXID, values)))
    for outputs, want in (("first", first), ("all", everything)):
        row = plans.node_fees(frame(spark, node_line()), coinbase, outputs=outputs).first()
        assert (row.height, row.fee_btc, row.source) == (210000, Decimal(want), "node")
        assert row.fee_sat == int(Decimal(want) * 10**8)


def test_fixed_and_era_subsidy(spark):
    coinbase = op.coinbase_values(transactions(spark, (TXID, ["50"])))
    lines = frame(spark, *[node_line(h) for h in ("209999", "210000", "419999", "420000")])
    by_era = plans.node_fees(lines, coinbase)
    fixed = plans.node_fees(lines, coinbase, mode="positional", subsidy="fixed")
    assert [r.fee_btc for r in by_era.orderBy("height").collect()] == [
        0, 25, 25, Decimal("37.5"),
    ]
    assert {r.fee_btc for r in fixed.collect()} == {25}


def test_output_order_decides_not_row_order(spark):
    rows = [("a", 2, 1, "7"), ("a", 1, 2, "5"), ("a", 1, 1, "9"), ("b", 1, 1, "1")]
    flat = spark.createDataFrame(
        [(t, n, m, Decimal(v)) for t, n, m, v in rows],
        "txid string, n int, m int, value decimal(18,8)",
    )
    by_two = {r.txid: r for r in op.output_values(flat, "txid", ["n", "m"]).collect()}
    assert (by_two["a"].first_value, by_two["a"].total_value, by_two["a"].n_outputs) == (9, 21, 3)
    by_one = op.output_values(flat.where("m = 1"), "txid", ["n"])
    assert {r.txid: r.first_value for r in by_one.collect()} == {"a": 9, "b": 1}


def test_copies_of_a_transaction_do_not_multiply_blocks(spark):
    coinbase = op.coinbase_values(transactions(spark, *[(TXID, ["26", "1"])] * 50))
    lines = frame(spark, *[node_line()] * 3)
    rows = plans.node_fees(lines, coinbase).collect()
    assert [r.fee_btc for r in rows] == [1, 1, 1]


def test_lookup_keeps_every_row(spark):
    coinbase = op.coinbase_values(transactions(spark, (TXID, ["26"])))
    lines = frame(spark, node_line(), node_line("210001", tx=[OTHER]), "", "", "stray")
    outcome = op.look_up_coinbase(op.node_references(lines), coinbase).collect()
    assert sorted((r.height or 0, str(r.reason)) for r in outcome) == [
        (0, "empty_line"),
        (0, "empty_line"),
        (0, "stray_text"),
        (210000, "None"),
        (210001, "missing_transaction"),
    ]
    assert plans.node_fees(lines, coinbase).count() == 1


def test_explorer_fee_units(spark):
    row = plans.explorer_fees(frame(spark, explorer_line(), "", explorer_line("x"))).collect()
    assert [tuple(r) for r in row] == [(210000, Decimal("0.11294626"), 11294626, "explorer")]


def test_fee_cells_print_plain_numbers(spark):
    cells = op.fee_cells(fees(spark, (210000, "0"), (210001, "0.00000050"))).collect()
    assert [r.value for r in cells] == ["0.00000000", "0.00000050"]
    assert tuple(cells[0])[:3] == ("210000", "tx_fee_col", "tx_fee")
    assert (cells[0].source, cells[0].unit) == ("x", "coin")


def test_json_cells(spark):
    line = '{"id": 7, "name": "x"}'
    lines = frame(spark, line, '{"name": "x"}', "not json", '{"id": "k"}')
    records = op.json_records(lines)
    assert [r.reason for r in records.collect()] == [None, "no_id", "bad_json", None]
    cells = op.json_cells(op.accepted(records)).collect()
    assert tuple(cells[0]) == ("7", "cfamily", "cats_json", line)
    assert cells[1].rowkey == "k"


def test_json_records_are_whole_and_keyed_by_a_scalar(spark):
    lines = {
        '{"id":7} junk': "bad_json", '{"id":7}{"id":8}': "bad_json", '{"id":1},5': "bad_json",
        '{"id":1},1': "bad_json", '{"id":1}],[2': "bad_json", "": "bad_json", "{'id':1}": "bad_json",
        '{"id":{"a":1}}': "bad_id", '{"id":[1]}': "bad_id", '{"id":null}': "no_id", "[1]": "no_id",
        '{"id":"{x"}': None, '{"id":1.5}': None, '{"id":true}': None, ' {"id": 12345678901234567890123} ': None,
    }
    got = {r.value: r for r in op.json_records(frame(spark, *lines)).collect()}
    assert {k: r.reason for k, r in got.items()} == lines
    assert [got[k].id for k, reason in lines.items() if reason is None] == ["{x", "1.5", "true", "12345678901234567890123"]


def test_pending_heights(spark):
    loaded = spark.createDataFrame([(1,), (3,), (3,), (9,), (None,)], "height bigint")
    wanted = sources.height_range(spark, 0, 5)
    assert sorted(r.height for r in op.pending_heights(wanted, loaded).collect()) == [0, 2, 4]
    none = loaded.where("height < 0")
    assert op.pending_heights(wanted, none).count() == 5


@pytest.mark.parametrize(("last", "left"), [(None, 5), (-1, 5), (2, 2), (4, 0), (99, 0)])
def test_resume_after_marker(spark, last, left):
    progress = spark.createDataFrame([(last,)], "last_block_processed bigint")
    assert op.heights_after(sources.height_range(spark, 0, 5), progress).count() == left


def test_resume_without_marker_row(spark):
    progress = spark.createDataFrame([], "last_block_processed bigint")
    assert op.heights_after(sources.height_range(spark, 0, 5), progress).count() == 5


def test_progress_marker(spark):
    assert op.progress_marker(fees(spark, (7, "1"), (9, "1"))).first()[0] == 9
    assert op.progress_marker(fees(spark)).first()[0] is None


def test_blocks_at(spark):
    blocks = op.accepted(op.node_blocks(frame(spark, node_line(), node_line("210005"))))
    wanted = spark.createDataFrame([(210000,), (210000,), (210001,)], "height bigint")
    assert [r.height for r in op.blocks_at(wanted, blocks).collect()] == [210000]


def test_series(spark):
    data = fees(spark, (250_000, "1"), (280_000, "2"), (249_999, "3"), (260_000, "201"))
    points = op.fee_series(data, 250_000, 280_000).collect()
    assert [r.height for r in points] == [250_000, 260_000, 280_000]
    assert [r.height for r in op.fee_outliers(data).collect()] == [260_000]
    buckets = {r.bucket_start: r for r in op.fee_buckets(data, 20_000).collect()}
    assert sorted(buckets) == [240_000, 260_000, 280_000]
    assert (buckets[240_000].blocks, buckets[240_000].min_fee, buckets[240_000].sum_fee) == (2, 1, 4)


def test_top_fees_ties_by_height(spark):
    data = fees(spark, (3, "5"), (1, "5"), (2, "9"), (4, "1"))
    assert [r.height for r in op.top_fees(data, 3).collect()] == [2, 1, 3]


def test_compare_sources(spark):
    node = fees(spark, (1, "1"), (2, "2"), (3, "3"), (3, "3"), (5, "1"), (5, "2"))
    explorer = fees(spark, (1, "1"), (2, "2.5"), (4, "4"), (5, "1"))
    rows = {r.height: r for r in op.compare_sources(node, explorer).collect()}
    assert {h: r.status for h, r in rows.items()} == {
        1: "match", 2: "differ", 3: "node_only", 4: "explorer_only", 5: "ambiguous",
    }
    assert rows[2].difference_sat == -50_000_000


def test_era_and_fixed_rule_agree_within_the_second_era(spark):
    coinbase = spark.createDataFrame([(TXID, Decimal("26"))], "txid string, first_value decimal(18,8)")
    blocks = sources.height_range(spark, 210_000, 420_000).withColumn("txid", F.lit(TXID))
    joined = op.attach_coinbase(blocks, coinbase)
    rows = op.node_fee(joined, subsidy="era").agg(F.min("fee_sat"), F.max("fee_sat"), F.count("*"))
    assert tuple(rows.first()) == (10**8, 10**8, 210_000)


def test_absurd_total_does_not_fail_the_job(spark):
    values = ["9999999999", "9999999999"]
    coinbase = op.coinbase_values(transactions(spark, (TXID, values), (OTHER, ["26"])))
    lines = frame(spark, node_line(), node_line("210001", tx=[OTHER]))
    rows = plans.node_fees(lines, coinbase, outputs="all").orderBy("height").collect()
    assert [(r.fee_btc, r.fee_sat) for r in rows] == [(None, None), (1, 10**8)]


def test_unknown_outputs_rule(spark):
    with pytest.raises(ValueError):
        op.node_fee(spark.createDataFrame([], "height bigint"), outputs="last")
