import json
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from blockfee import operators as op
from blockfee import sources
from tests.lines import FULL_TAIL, OTHER, TXID, explorer_line, frame, node_line

STRAY = "No data from Hbase"


def reasons(parsed):
    return [r.reason for r in parsed.collect()]


def test_node_positional_slices(spark):
    heights = ["210000", "99999", "1000001", "1000002", "1234567L", "-1234567", "12 3", "1.5", "9" * 30]
    rows = op.node_references(frame(spark, *map(node_line, heights)), "positional").collect()
    # Whole numbers or nothing.
    assert [r.height for r in rows] == [210000, 99999, 1000001, 1000002, 1234567, None, None, None, None]
    assert {r.txid for r in rows} == {TXID}
    assert [r.reason for r in rows] == [None] * 5 + ["bad_height"] * 4


def test_node_named_takes_any_height(spark):
    lines = frame(spark, node_line("99999"), node_line("1234567L"), node_line(tail=FULL_TAIL))
    rows = op.node_references(lines).collect()
    assert [r.height for r in rows] == [99999, 1234567, 210000]
    assert {r.txid for r in rows} == {TXID}
    assert {r.reason for r in rows} == {None}


def test_named_heights_are_whole_numbers_of_the_block_itself(spark):
    bad = ["210000.5", "12abc", "-5", "'7'", "1e3", "None", "{u'height': 5}", "[7]"]
    lines = [node_line(h) for h in bad]
    deep = "u'a': {u'b': [{u'height': 5, u'tx': [u'00']}, u'} \\\\\\' \\x7b', \"it's {\"]}, "
    good = ["{" + deep + node_line("210007")[1:], node_line(tail=", u'height2': {u'height': 9}}"), node_line("5L ")]
    good += [node_line(tx=[TXID, OTHER] * 20_000), "{u'x': [" + "{u'height': 1}, " * 20_000 + "], " + node_line()[1:]]
    objects = node_line().replace(f"[u'{TXID}', u'{OTHER}']", "[{u'a': [1], u'height': 5}]").replace(": 210000", ": None")
    inner = "{u'n': {u'tx': [u'00']}, " + node_line("210008")[1:]
    lines, good, bad = [*lines, objects], [*good, inner], [*bad, objects]
    only_nested = node_line("1").replace("u'height': 1", "u'y': {u'height': 1}")
    rows = op.node_references(frame(spark, *lines, only_nested, *good).coalesce(1)).collect()
    assert [r.reason for r in rows] == ["bad_height"] * 10 + [None] * 6
    assert [r.height for r in rows[10:]] == [210007, 210000, 5, 210000, 210000, 210008]
    assert {r.txid for r in rows[10:]} == {TXID}


def test_json_lines(spark):
    """What nodes print today."""
    record = {"hash": "ab", "difficulty": 3438908.96015914, "miner": "a: u'b', None, 'Decimal('", "height": 210000,
              "next": {"height": 3, "tx": 4}, "tx": [TXID, OTHER], "time": 5, "nextblockhash": None}
    texts = [json.dumps(record), json.dumps(record, separators=(",", ":")), json.dumps(record | {"height": 2.5})]
    rows = op.node_references(frame(spark, *texts).coalesce(1)).collect()
    assert [(r.height, r.txid, r.reason) for r in rows[:2]] == [(210000, TXID, None)] * 2
    assert rows[2].reason == "bad_height"
    for row in op.node_blocks(frame(spark, *texts).coalesce(1)).collect()[:2]:
        assert (row.hash, row.height, row.time, row.tx, row.nextblockhash, row.reason) == (
            "ab", 210000, 5, [TXID, OTHER], None, None)
        assert str(row.difficulty) == "3438908.96015914"
    explorer = json.dumps({"fees": 7, "transaction_hashes": [OTHER, TXID], "next": {"fees": 9}, "height": 12})
    row = op.explorer_fields(frame(spark, explorer)).first()
    assert (row.height, row.fee_sat, row.reason) == (12, 7, None)


@pytest.mark.parametrize("mode", ["named", "positional"])
def test_node_modes_agree_on_unusable_lines(spark, mode):
    lines = frame(
        spark, "", "   ", None, STRAY, "{u'a': 1}", node_line(tx=["xyz"]), node_line("None")
    )
    assert reasons(op.node_references(lines, mode)) == [
        "empty_line", "empty_line", "empty_line", "stray_text", "bad_height", "bad_txid",
        "bad_height",
    ]


def test_truncated_line(spark):
    cut = frame(spark, node_line()[:-5])
    assert reasons(op.node_references(cut)) == ["truncated"]
    assert reasons(op.node_blocks(cut)) == ["truncated"]
    # Positions before the cut are still there.
    assert reasons(op.node_references(cut, "positional")) == [None]


def test_node_blocks(spark):
    lines = frame(spark, node_line(tail=FULL_TAIL), node_line(tail=", u'version': 2}"))
    full, short = op.node_blocks(lines).collect()
    assert (full.hash, full.height, full.time, full.tx) == ("ab", 210000, 1354116278, [TXID, OTHER])
    assert str(full.difficulty) == "3438908.96015914"
    assert (full.previousblockhash, full.nextblockhash, full.reason) == ("aa", None, None)
    assert (short.previousblockhash, short.time, short.reason) == (None, None, None)


def test_headers_and_edges(spark):
    blocks = op.accepted(op.node_blocks(frame(spark, node_line(tail=", u'version': 2}"))))
    header = op.block_headers(blocks).first()
    assert (header.previousblockhash, header.nextblockhash) == ("", None)
    assert [tuple(r) for r in op.tx_edges(blocks).collect()] == [
        (210000, 0, TXID),
        (210000, 1, OTHER),
    ]


def test_explorer_positional(spark):
    row = op.explorer_fields(frame(spark, explorer_line()), "positional").first()
    assert (row.height_text, row.fee_text) == ("210000", "11294626")
    assert row.fee_text_padded == " 11294626"
    assert (row.height, row.fee_sat, row.reason) == (210000, 11294626, None)


def test_explorer_positional_reads_whole_fees_before_any_key(spark):
    lines = [explorer_line().replace("difficulty", key) for key in ("size", "a_rather_long_key")]
    lines += [explorer_line().replace(", u'difficulty': 1}", "}"), explorer_line(fees="-5"), explorer_line("1000001")]
    rows = op.explorer_fields(frame(spark, *lines), "positional").collect()
    assert [r.fee_sat for r in rows] == [11294626, 11294626, 11294626, None, 11294626]
    assert [r.reason for r in rows] == [None, None, None, "bad_fee", None]
    assert rows[4].height == 1000001


def test_explorer_named(spark):
    hashes = ", ".join(f"u'{OTHER}'" for _ in range(3))
    nested = (
        "{u'next_blocks': [{u'height': 5, u'hash': u'a'}], u'fees': 7L, "
        f"u'transaction_hashes': [{hashes}], u'height': 1234567}}"
    )
    lines = frame(
        spark, explorer_line(), nested, explorer_line(fees="None"), STRAY,
        explorer_line(fees="9" * 25),
    )
    rows = op.explorer_fields(lines).collect()
    assert [(r.height, r.fee_sat) for r in rows[:2]] == [(210000, 11294626), (1234567, 7)]
    assert [r.reason for r in rows[:4]] == [None, None, "bad_fee", "stray_text"]
    assert rows[4].reason in ("bad_fee", "bad_height")


def test_explorer_positional_short_segments(spark):
    lines = frame(spark, ":" * 14, ":" * 15, ":" * 15 + " 12", "")
    rows = op.explorer_fields(lines, "positional").collect()
    assert [r.fee_text for r in rows] == [None] * 4
    assert all(r.reason for r in rows)


@pytest.mark.parametrize("parse", [op.node_references, op.explorer_fields])
def test_unknown_mode(spark, parse):
    with pytest.raises(ValueError):
        parse(frame(spark, ""), "guess")


def test_quarantine_keeps_every_line(spark):
    values = [node_line(), "", STRAY, node_line()[:40], node_line("x"), node_line(tx=[])]
    parsed = op.node_references(frame(spark, *values))
    assert op.accepted(parsed).count() + op.quarantined(parsed).count() == len(values)
    counts = {r.reason: r.lines for r in op.reason_counts(parsed).collect()}
    assert counts == {
        "ok": 1, "empty_line": 1, "stray_text": 1, "truncated": 1, "bad_height": 1, "bad_txid": 1,
    }
    assert {r.value for r in op.quarantined(parsed).collect()} == set(values[1:])


def test_require_all(spark):
    good = op.node_references(frame(spark, node_line()))
    assert op.require_all(good).count() == 1
    bad = op.node_references(frame(spark, node_line(), STRAY))
    with pytest.raises(PySparkException, match="stray_text"):
        op.require_all(bad).collect()


def test_text_source(spark, tmp_path):
    (tmp_path / "a.txt").write_text(node_line() + "\n\n" + STRAY + "\n")
    (tmp_path / "b.txt").write_text(node_line("210001"))
    lines = sources.read_lines(spark, str(tmp_path))
    assert lines.columns == ["value"] and lines.count() == 4
    assert sources.read_lines(spark, f"file:{tmp_path}/b.txt").count() == 1
    whole = sources.read_lines(spark, str(tmp_path / "a.txt"), whole_file=True)
    assert whole.count() == 1
    assert sources.lines_with(lines, "'tx'").count() == 2


def test_line_segments(spark):
    rows = sources.line_segments(frame(spark, "a:b:", "c")).collect()
    assert [tuple(r) for r in rows] == [(0, "a"), (1, "b"), (2, ""), (0, "c")]
    assert [r.segment for r in sources.line_segments(frame(spark, "a.b"), ".").collect()] == [
        "a",
        "b",
    ]


def test_height_range_is_half_open(spark):
    assert [r.height for r in sources.height_range(spark, 5, 8).collect()] == [5, 6, 7]
    assert sources.height_range(spark, 5, 5).count() == 0


def printed(value):
    """How Python 2 prints a value of a block record."""
    if isinstance(value, dict):
        return "{" + ", ".join(f"{printed(k)}: {printed(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ", ".join(printed(v) for v in value) + "]"
    if isinstance(value, str):
        return "u" + ascii(value)
    if isinstance(value, int) and not isinstance(value, bool) and value > 2**31:
        return f"{value}L"
    return repr(value)


HEX = st.text("0123456789abcdef", min_size=1, max_size=20)
COUNT = st.integers(0, 2**53)
RECORD = st.fixed_dictionaries(
    {
        "hash": HEX,
        "confirmations": COUNT,
        "miner": st.text(max_size=20),
        "orphan": st.booleans(),
        "tx": st.lists(st.text("0123456789abcdef", min_size=64, max_size=64), min_size=1, max_size=4),
        "height": st.integers(0, 10**9),
        "nonce": COUNT,
        "difficulty": st.decimals(0, 10**12, places=8, allow_nan=False),
        "nextblockhash": st.none() | HEX,
    }
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data(), st.lists(RECORD, min_size=30, max_size=60))
def test_any_printed_block_is_read_back(spark, data, records):
    texts = []
    for record in records:
        keys = data.draw(st.permutations(list(record)))
        texts.append(printed({k: record[k] for k in keys}))
    rows = op.node_blocks(frame(spark, *texts).coalesce(1)).collect()
    references = op.node_references(frame(spark, *texts).coalesce(1)).collect()
    for record, row, reference in zip(records, rows, references):
        got = {k: row[k] for k in record if k not in ("miner", "orphan")}
        want = {k: v for k, v in record.items() if k in got}
        want["difficulty"] = Decimal(want["difficulty"])
        assert got == want
        assert row.reason is None and reference.reason is None
        assert (reference.height, reference.txid) == (record["height"], record["tx"][0])
