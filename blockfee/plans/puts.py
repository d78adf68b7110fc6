"""Put functions: what a job does with a batch, or a stream with a micro-batch."""

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from blockfee.functions import pack_id, unpack_id
from blockfee.operators import (
    accepted,
    explorer_fee,
    explorer_fields,
    fee_cells,
    json_cells,
    json_records,
    look_up_coinbase,
    node_fee,
    node_references,
    outcome_metrics,
    quarantined,
    refuse_bad_amounts,
    require_all,
)
from blockfee.sinks import put_batch, read_table
from blockfee.sinks.files import remove
from blockfee.sinks.ranges import HEIGHT_RANGE, HEIGHTS

Put = Callable[[DataFrame, int], None]
#: Gets the number of a batch and how many lines it had: ``lines``, ``ok``, and each reason.
Report = Callable[[int, dict[str, int]], None]

#: Instead of a quarantine table: leave refused lines out and print how many, by
#: reason; or fail at the first one.
DROP, FAIL = object(), object()


def print_counts(batch_id: int, counts: dict[str, int]) -> None:
    for reason, lines in sorted(counts.items()):
        if lines and reason != "lines":
            print(f"batch {batch_id}: {reason}: {lines} lines")


def _without_good_lines(parsed: DataFrame, *columns: str) -> DataFrame:
    """Parsed columns; the raw line only where it was refused."""
    line = F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
    return parsed.select(*columns, "reason", line)


def _writer(lines: DataFrame, writer: str | None) -> str:
    """The name under which a batch is put: for a micro-batch, that of its stream."""
    stream = lines.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return writer or (f"stream-{stream}" if stream else "batch")


@contextmanager
def _staged(rows: DataFrame, table: str) -> Iterator[DataFrame]:
    """``rows`` written beside ``table``, to be read more than once, and removed again.

    Whatever is made of them agrees: a transaction that arrives meanwhile, or an executor
    that is lost, can't make a line both accepted and refused, or neither.
    """
    path = f"{table.rstrip('/')}/_staged/{uuid.uuid4().hex}"
    try:
        # Ids are most of it, and take half the space this way.
        rows.write.option("compression", "zstd").parquet(path)
        yield rows.sparkSession.read.schema(rows.schema).parquet(path)
    finally:
        remove(rows.sparkSession, path)


def _put(
    outcome: DataFrame,
    cells: Callable[[DataFrame], DataFrame],
    table: str,
    refused,
    batch_id: int,
    writer: str,
    read_from: str | None,
    partition_by: tuple[str, ...] = (),
    report: Report | None = None,
) -> None:
    """Put the accepted rows, and account for all others.

    The counts come out of the write that stages the outcome, whose tasks Spark counts
    once each, whatever has to be run again.
    """
    if refused is FAIL:
        put_batch(cells(require_all(outcome)), table, batch_id, partition_by, writer, read_from)
        return
    seen = Observation()
    with _staged(outcome.observe(seen, *outcome_metrics()), table) as rows:
        put_batch(cells(accepted(rows)), table, batch_id, partition_by, writer, read_from)
        if refused is not DROP:
            put_batch(quarantined(rows), refused, batch_id, (), writer, read_from)
    report = report or (print_counts if refused is DROP else None)
    if report:
        report(batch_id, dict(seen.get))


def _fee_cells(fees: DataFrame, value: str) -> DataFrame:
    height = F.col("rowkey").cast("bigint")
    return fee_cells(fees, value).withColumn(HEIGHT_RANGE, height - F.pmod(height, F.lit(HEIGHTS)))


def put_node_fees(
    coinbase: Callable[[DataFrame], DataFrame],
    table: str,
    refused,
    mode: str = "named",
    outputs: str = "first",
    subsidy: str = "era",
    writer: str | None = None,
    read_from: str | None = None,
    report: Report | None = None,
) -> Put:
    """Put the fees of node block lines.

    ``refused`` is a table for the lines that are not put, or ``DROP`` or ``FAIL``.
    ``coinbase`` gets the parsed lines of each batch and gives the transactions
    to look them up in, so a stream sees those that arrived since the last batch
    and need not read all of them. Blocks whose transaction is still missing are
    set aside and found again as pending heights, or by ``redrive_node_fees``. ``report``
    gets the counts of each batch.
    """

    def put(lines: DataFrame, batch_id: int) -> None:
        # The long lines are scanned once; what is staged of them is short.
        with _staged(_without_good_lines(node_references(lines, mode), "height", "txid"), table) as parsed:
            known = coinbase(parsed)
            looked_up = refuse_bad_amounts(look_up_coinbase(parsed.where("reason IS NULL"), known), outputs, subsidy)
            columns = ["height", "txid", "reason", "value", "first_value", "total_value"]
            # Refused lines are long, and have nothing to be looked up.
            refused_lines = parsed.where("reason IS NOT NULL")
            _put(
                looked_up.select(*columns).unionByName(refused_lines, allowMissingColumns=True),
                lambda rows: _fee_cells(node_fee(rows, outputs, subsidy), "fee_btc"),
                table,
                refused,
                batch_id,
                _writer(lines, writer),
                read_from,
                (HEIGHT_RANGE,),
                report,
            )

    return put


def put_explorer_fees(
    table: str,
    refused,
    mode: str = "named",
    value: str = "fee_sat",
    writer: str | None = None,
    read_from: str | None = None,
    report: Report | None = None,
) -> Put:
    """Put the fees of explorer block lines, in the unit the explorer states."""

    def put(lines: DataFrame, batch_id: int) -> None:
        _put(
            _without_good_lines(explorer_fields(lines, mode), "height", "fee_sat"),
            lambda rows: _fee_cells(explorer_fee(rows), value),
            table,
            refused,
            batch_id,
            _writer(lines, writer),
            read_from,
            (HEIGHT_RANGE,),
            report,
        )

    return put


def put_json(
    table: str,
    refused,
    id_path: str = "$.id",
    seq_path: str | None = None,
    writer: str | None = None,
    read_from: str | None = None,
    report: Report | None = None,
) -> Put:
    """Put JSON lines under their id.

    Within one batch the record greatest by ``seq_path`` is the newest; without
    it, the greatest text is, so that a replay decides the same way.
    """

    def put(lines: DataFrame, batch_id: int) -> None:
        seq = F.get_json_object("value", seq_path) if seq_path else F.lit(None).cast("string")
        _put(
            json_records(lines, id_path),
            lambda rows: json_cells(rows.withColumn("seq", seq.try_cast("bigint"))),
            table,
            refused,
            batch_id,
            _writer(lines, writer),
            read_from,
            (),
            report,
        )

    return put


#: What the quarantine says of a line whose fee was put after all.
REDRIVEN = "redriven"


def redrive_node_fees(
    coinbase: Callable[[DataFrame], DataFrame],
    table: str,
    quarantine: str,
    outputs: str = "first",
    subsidy: str = "era",
    writer: str = "redrive",
) -> Callable[[SparkSession, int], None]:
    """Put the fees of quarantined blocks whose transaction has come in the meantime.

    Blocks were refused as ``missing_transaction`` by a put into ``quarantine``. Those with
    a transaction in ``coinbase`` now are put into ``table`` under a writer of their own, and
    the quarantine gets a row that says so; what still lacks its transaction, or has an
    ambiguous one, goes on waiting. A batch that is run again, after a failure or
    not, puts what it put before and what has come since.
    """

    def redrive(spark: SparkSession, batch_id: int) -> None:
        rows = read_table(spark, quarantine)
        own = (F.col("put_by") == writer) & (F.col("put_id") == batch_id)
        block = ["height", pack_id(F.col("txid")).alias("_id")]
        settled = rows.where((F.col("put_by") == writer) & ~own).select(*block).distinct()
        waiting = rows.where("reason = 'missing_transaction'").select(*block).distinct()
        waiting = waiting.join(settled, ["height", "_id"], "left_anti")
        nothing = F.lit(None).cast("string")
        waiting = waiting.select(
            "height", unpack_id(F.col("_id")).alias("txid"), nothing.alias("reason"), nothing.alias("value")
        )
        with _staged(waiting, table) as parsed:
            # One lookup tells what has arrived, and what it is.
            known = coinbase(parsed).withColumn("_arrived", F.lit(True))
            arrived = look_up_coinbase(parsed, known).where("_arrived")
            looked_up = refuse_bad_amounts(arrived, outputs, subsidy)
            columns = ["height", "txid", "reason", "value", "first_value", "total_value"]
            with _staged(looked_up.select(*columns), table) as outcome:
                cells = _fee_cells(node_fee(accepted(outcome), outputs, subsidy), "fee_btc")
                put_batch(cells, table, batch_id, (HEIGHT_RANGE,), writer)
                # Last, so that a failure before leaves the lines waiting.
                done = outcome.where("reason IS NULL OR reason <> 'ambiguous_transaction'")
                marked = done.withColumn("reason", F.coalesce("reason", F.lit(REDRIVEN)))
                put_batch(marked, quarantine, batch_id, (), writer)

    return redrive
