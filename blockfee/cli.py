"""Jobs for spark-submit; see ``run_job.py --help``."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockfee import operators as op
from blockfee import plans, schemas, sinks, sources, streaming
from blockfee.session import session
from blockfee.streaming.run import (
    DEFAULT_INTERVAL,
    EXPLORER_TIMEOUT_SECONDS,
    NODE_TIMEOUT_SECONDS,
    PREVIEW_ROWS,
    PREVIEW_TIMEOUT_SECONDS,
)


def _transactions(spark: SparkSession, path: str) -> DataFrame:
    """Values of the transactions in a parquet table (txid, vout)."""
    return op.coinbase_values(spark.read.schema(schemas.TRANSACTION).parquet(path))


def _known(spark: SparkSession, args) -> Callable[[DataFrame], DataFrame]:
    """Look up in the table that the coinbase job writes, or in plain transactions."""
    if args.coinbase:
        return sinks.coinbase_reader(spark, args.coinbase)
    return lambda parsed: _transactions(spark, args.transactions)


def _node_rules(args) -> dict[str, str]:
    return {"mode": args.mode, "outputs": args.outputs, "subsidy": args.subsidy}


def _refused(args):
    return plans.DROP if args.drop_refused else plans.FAIL if args.fail_fast else args.quarantine


def _batch(args) -> dict[str, str]:
    """Under which name a batch is put and what from; a stream has a name of its own."""
    return {"writer": args.writer, "read_from": args.lines} if "batch_id" in args else {}


def _node_put(spark: SparkSession, args) -> plans.Put:
    known = _known(spark, args)
    return plans.put_node_fees(known, args.table, _refused(args), **_node_rules(args), **_batch(args))


def _explorer_put(spark: SparkSession, args) -> plans.Put:
    return plans.put_explorer_fees(args.table, _refused(args), args.mode, **_batch(args))


def coinbase(spark: SparkSession, args) -> None:
    values = _transactions(spark, args.transactions)
    sinks.put_coinbase(
        values, args.coinbase, args.batch_id, args.digits, args.writer, args.transactions
    )


def node_batch(spark: SparkSession, args) -> None:
    _node_put(spark, args)(sources.read_lines(spark, args.lines), args.batch_id)


def explorer_batch(spark: SparkSession, args) -> None:
    _explorer_put(spark, args)(sources.read_lines(spark, args.lines), args.batch_id)


def _stream(spark: SparkSession, args, put: plans.Put) -> None:
    lines = sources.stream_lines(spark, args.lines, args.max_files)
    streaming.run_stream(lines, put, args.checkpoint, args.interval or None, args.timeout)


def node_stream(spark: SparkSession, args) -> None:
    _stream(spark, args, _node_put(spark, args))


def explorer_stream(spark: SparkSession, args) -> None:
    _stream(spark, args, _explorer_put(spark, args))


def json_stream(spark: SparkSession, args) -> None:
    _stream(spark, args, plans.put_json(args.table, _refused(args), args.id_path, args.seq_path))


def node_preview(spark: SparkSession, args) -> None:
    lines = sources.read_lines(spark, args.lines)
    fees = plans.node_fees(lines, _transactions(spark, args.transactions), **_node_rules(args))
    fees.show(args.rows, truncate=False)


def explorer_preview(spark: SparkSession, args) -> None:
    lines = sources.stream_lines(spark, args.lines, args.max_files)
    fees = op.explorer_fields(lines, "positional").select("fee_text_padded")
    streaming.preview_stream(fees, args.rows, args.interval or None, args.timeout)


def _fees(spark: SparkSession, args, source: str | None = None) -> DataFrame:
    """The newest fee of each height in a fee table, by source."""
    puts = sinks.read_table(spark, args.table)
    if source or args.source:
        puts = puts.where(F.col("source") == (source or args.source))
    if "first" in args and args.first is not None:
        low = args.first - args.first % plans.puts.HEIGHTS
        puts = puts.where(F.col(plans.puts.HEIGHT_RANGE).between(low, args.last))
    return op.cell_fees(sinks.latest_by_key(puts))


def _loaded(spark: SparkSession, args) -> DataFrame:
    puts = sinks.read_table(spark, args.table)
    low = args.first - args.first % plans.puts.HEIGHTS
    puts = puts.where(F.col(plans.puts.HEIGHT_RANGE).between(low, args.stop - 1))
    return puts.select(F.col("rowkey").try_cast("bigint").alias("height"))


def redrive(spark: SparkSession, args) -> None:
    known = _known(spark, args)
    run = plans.redrive_node_fees(known, args.table, args.quarantine, args.outputs, args.subsidy, args.writer)
    run(spark, args.batch_id)


def pending(spark: SparkSession, args) -> None:
    if args.ranges:
        op.pending_ranges(_loaded(spark, args), args.first, args.stop).write.parquet(args.out)
        return
    wanted = sources.height_range(spark, args.first, args.stop)
    op.pending_heights(wanted, _loaded(spark, args)).write.parquet(args.out)


def series(spark: SparkSession, args) -> None:
    op.fee_series(_fees(spark, args), args.first, args.last).write.parquet(args.out)


def positions(spark: SparkSession, args) -> None:
    op.positional_series(_fees(spark, args), args.first, args.last, args.start).write.parquet(args.out)


def refresh_buckets(spark: SparkSession, args) -> None:
    done = sinks.refresh_buckets(spark, args.table, args.out, args.blocks, args.source)
    print("refreshed: all" if done is None else f"refreshed: {len(done)} ranges")


def buckets(spark: SparkSession, args) -> None:
    op.fee_buckets(_fees(spark, args), args.blocks).write.parquet(args.out)


def outliers(spark: SparkSession, args) -> None:
    op.fee_outliers(_fees(spark, args), args.above).write.parquet(args.out)


def top(spark: SparkSession, args) -> None:
    op.top_fees(_fees(spark, args), args.rows).write.parquet(args.out)


def reconcile(spark: SparkSession, args) -> None:
    node, explorer = (_fees(spark, args, source) for source in ("node", "explorer"))
    op.compare_sources(node, explorer).write.parquet(args.out)


def _blocks(spark: SparkSession, args) -> DataFrame:
    """Usable blocks of a dump, above the marker if there is one."""
    blocks = op.accepted(op.node_blocks(sources.read_lines(spark, args.lines)))
    return op.heights_after(blocks, spark.read.parquet(args.after)) if args.after else blocks


def headers(spark: SparkSession, args) -> None:
    op.block_headers(_blocks(spark, args)).write.parquet(args.out)


def edges(spark: SparkSession, args) -> None:
    op.tx_edges(_blocks(spark, args)).write.parquet(args.out)


def load_headers(spark: SparkSession, args) -> None:
    sinks.put_blocks(op.block_headers(_blocks(spark, args)), args.table, args.batch_id, args.writer, args.lines)


def load_edges(spark: SparkSession, args) -> None:
    sinks.put_blocks(op.tx_edges(_blocks(spark, args)), args.table, args.batch_id, args.writer, args.lines, ("pos",))


def blocks(spark: SparkSession, args) -> None:
    sinks.blocks_between(spark, args.table, args.first, args.stop).write.parquet(args.out)


def marker(spark: SparkSession, args) -> None:
    """Only what has no gap below it counts as processed."""
    puts = sinks.read_table(spark, args.table).where(F.col("source") == args.source)
    heights = puts.select(F.col("rowkey").try_cast("bigint").alias("height"))
    op.contiguous_marker(heights, args.first).write.mode("overwrite").parquet(args.out)


def compact(spark: SparkSession, args) -> None:
    if args.kind == "coinbase":
        sinks.compact_coinbase(spark, args.table, args.open)
    else:
        sinks.compact(spark, args.table, open_batches=args.open)
    for directory in sinks.replaced(spark, args.table):
        print(f"replaced: {directory}")


def remove_replaced(spark: SparkSession, args) -> None:
    for directory in sinks.remove_replaced(spark, args.table):
        print(f"removed: {directory}")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="run_job.py", description="Block fee jobs.")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(function, summary: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(function.__name__.replace("_", "-"), help=summary)
        sub.set_defaults(function=function)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        return sub

    def rules(sub, outputs: bool) -> None:
        sub.add_argument("--mode", choices=["named", "positional"], default="named")
        if outputs:
            sub.add_argument("--outputs", choices=["first", "all"], default="first")
            sub.add_argument("--subsidy", choices=["era", "fixed"], default="era")

    def lookup(sub) -> None:
        either = sub.add_mutually_exclusive_group(required=True)
        either.add_argument("--transactions", help="parquet table (txid, vout)")
        either.add_argument("--coinbase", help="table written by the coinbase job")

    def account(sub) -> None:
        either = sub.add_mutually_exclusive_group(required=True)
        either.add_argument("--quarantine", help="table for refused lines")
        either.add_argument("--drop-refused", action="store_true", help="print how many, by reason")
        either.add_argument("--fail-fast", action="store_true", help="fail at the first refused line")

    def batch(sub) -> None:
        sub.add_argument("--batch-id", type=int, required=True, help="another for each input")
        sub.add_argument("--writer", default="batch", help="whose numbers these are")

    def stream(sub, timeout: float | None) -> None:
        sub.add_argument("--interval", default=DEFAULT_INTERVAL, help="empty: what is there, then stop")
        sub.add_argument("--timeout", type=float, default=timeout, help="seconds")
        sub.add_argument("--max-files", type=int, help="files per micro-batch")

    for function, outputs in ((node_batch, True), (explorer_batch, False)):
        sub = job(function, "put the fees of a text dump", "lines", "table")
        batch(sub)
        account(sub)
        rules(sub, outputs)
        if outputs:
            lookup(sub)
    for function, outputs, timeout in (
        (node_stream, True, NODE_TIMEOUT_SECONDS),
        (explorer_stream, False, EXPLORER_TIMEOUT_SECONDS),
    ):
        sub = job(function, "put the fees of lines as they arrive", "lines", "table", "checkpoint")
        account(sub)
        rules(sub, outputs)
        stream(sub, timeout)
        if outputs:
            # Reducing all transactions for every micro-batch would not keep up.
            sub.add_argument("--coinbase", required=True, help="table written by the coinbase job")

    sub = job(coinbase, "reduce transactions for lookups", "transactions", "coinbase")
    sub.add_argument("--digits", type=int, default=sinks.coinbase.DIGITS, help="of the id, to partition by")
    batch(sub)
    sub = job(json_stream, "put JSON records under their id", "lines", "table", "checkpoint")
    account(sub)
    sub.add_argument("--id-path", default="$.id")
    sub.add_argument("--seq-path")
    stream(sub, None)

    sub = job(node_preview, "print some fees of a text dump", "lines", "transactions")
    sub.add_argument("--rows", type=int, default=20)
    rules(sub, True)
    sub = job(explorer_preview, "print the fees of lines as they arrive", "lines")
    sub.add_argument("--rows", type=int, default=PREVIEW_ROWS)
    stream(sub, PREVIEW_TIMEOUT_SECONDS)

    sub = job(pending, "write the heights a table lacks", "table", "out")
    sub.add_argument("--first", type=int, required=True)
    sub.add_argument("--stop", type=int, required=True, help="first height beyond")
    sub.add_argument("--ranges", action="store_true", help="a row (first, last) for each gap")
    sub = job(redrive, "put the quarantined blocks whose transaction has come", "quarantine", "table")
    sub.add_argument("--batch-id", type=int, required=True, help="another for each run")
    sub.add_argument("--writer", default="redrive")
    sub.add_argument("--outputs", choices=["first", "all"], default="first")
    sub.add_argument("--subsidy", choices=["era", "fixed"], default="era")
    lookup(sub)
    for function, summary in (
        (series, "write the fees of a range of heights in order"),
        (positions, "write the same fees, numbered in order"),
        (refresh_buckets, "bring buckets up to date with what was put since"),
        (buckets, "write count, least, greatest and total fee of runs of heights"),
        (outliers, "write the blocks above a fee"),
        (top, "write the blocks with the greatest fees"),
        (reconcile, "write the fees of both sources side by side"),
        (marker, "write the last height below which none is missing"),
    ):
        sub = job(function, summary, "table", "out")
        sub.add_argument("--source", choices=["node", "explorer"], default=None if function is reconcile else "node")
        if function in (series, positions):
            sub.add_argument("--first", type=int, required=True)
            sub.add_argument("--last", type=int, required=True)
        if function is positions:
            sub.add_argument("--start", type=int, default=0, help="number of the first point")
        if function is marker:
            sub.add_argument("--first", type=int, help="where the chain begins, else the lowest height put")
        if function in (buckets, refresh_buckets):
            sub.add_argument("--blocks", type=int, default=1000)
        if function is outliers:
            sub.add_argument("--above", type=int, default=200, help="coins")
        if function is top:
            sub.add_argument("--rows", type=int, default=10)
    for function, summary in ((headers, "write block headers"), (edges, "write block-to-transaction edges")):
        sub = job(function, summary, "lines", "out")
        sub.add_argument("--after", help="a marker: only blocks above it")
    for function, summary in ((load_headers, "put block headers by height"), (load_edges, "put block-to-transaction edges by height")):
        sub = job(function, summary, "lines", "table")
        sub.add_argument("--after", help="a marker: only blocks above it")
        batch(sub)
    sub = job(blocks, "write the headers or edges of a range of heights", "table", "out")
    sub.add_argument("--first", type=int, required=True)
    sub.add_argument("--stop", type=int, required=True, help="first height beyond")
    sub = job(compact, "write the newest puts as a snapshot that readers then use", "table")
    sub.add_argument("--kind", choices=["fees", "json", "coinbase"], default="fees")
    sub.add_argument("--open", type=int, default=0, help="newest batches of each writer to leave outside")
    job(remove_replaced, "remove what a snapshot replaces and close its batches", "table")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.function(session(f"blockfee {args.job}"), args)
