"""Every query: (spark, sf_dir) -> DataFrame."""

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockfee import operators as op
from blockfee import plans, sinks, sources, streaming
from blockfee.functions import normalise_text, round_coin, subsidy_sat
from blockfee.schemas import COIN, TOTAL_COIN
from catalogue import standin

Query = Callable[[SparkSession, str], DataFrame]

SERIES_FIRST, SERIES_LAST = 211_000, 214_000
OUTLIER_COINS = 50_000
#: Files of a dump in a micro-batch.
FILES_PER_TRIGGER = 4
#: Lines in a file that is read as one record, under a kilobyte each: a task has a file in memory several times.
LINES_PER_WHOLE_FILE = 5_000


def _node_fees(spark: SparkSession, sf_dir: str, **rules: str) -> DataFrame:
    return plans.node_fees(
        standin.node_lines(spark, sf_dir), standin.coinbase(spark, sf_dir), **rules
    )


def _parity_fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fees by the fixed rules: positions, first output, 25 coins."""
    return _node_fees(spark, sf_dir, mode="positional", subsidy="fixed")


def _accepted_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.accepted(op.node_blocks(standin.node_lines(spark, sf_dir)))


def _written_lines(lines: DataFrame, spark: SparkSession, **options: int | str) -> str:
    """Write lines as a text dump and return its path."""
    path = f"{streaming.work_dir(spark)}/lines"
    lines.select("value").write.options(**options).text(path)
    return path


def _stream(lines: DataFrame, put: plans.Put, spark: SparkSession, base: str) -> None:
    """Write lines as a text dump, then stream it, so many files at a time."""
    # Most of a dump is hexadecimal digits. Its files are read once, each by one task.
    dump = _written_lines(lines, spark, compression="gzip")
    source = sources.stream_lines(spark, dump, FILES_PER_TRIGGER)
    streaming.run_stream(source, put, f"{base}/checkpoint", interval=None)


def fee_node_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parity_fees(spark, sf_dir).select("height", "fee_btc")


def block_named_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standin.node_lines(spark, sf_dir)
    return op.accepted(op.node_references(lines)).select("height", "txid")


def fee_explorer_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standin.explorer_lines(spark, sf_dir)
    return op.accepted(op.explorer_fields(lines, "positional")).select(
        "height_text", "fee_text", "fee_text_padded"
    )


def fee_explorer_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    fees = plans.explorer_fees(standin.explorer_lines(spark, sf_dir))
    return fees.select("height", "fee_sat", "fee_btc")


def coinbase_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standin.node_lines(spark, sf_dir)
    return op.accepted(op.node_references(lines, "positional")).select("height_text", "txid")


def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = standin.table(spark, sf_dir, "documents")
    return documents.select("doc_id", normalise_text(F.col("text")).alias("text"))


def subsidy_by_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    heights = standin.table(spark, sf_dir, "orders").selectExpr(f"{standin.WIDE_HEIGHT} AS height")
    return heights.select("height", subsidy_sat(F.col("height")).alias("subsidy_sat"))


def fee_era(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standin.node_lines(spark, sf_dir, standin.WIDE_HEIGHT)
    return plans.node_fees(lines, standin.coinbase(spark, sf_dir)).drop("source")


def put_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.fee_cells(_parity_fees(spark, sf_dir))


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = op.accepted(op.json_records(standin.json_lines(spark, sf_dir)))
    seq = F.get_json_object("value", "$.event").cast("bigint")
    puts = op.json_cells(records.withColumn("seq", seq))
    return sinks.latest_by_key(puts, order=("seq",)).select("rowkey", "value")


def json_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.json_cells(op.accepted(op.json_records(standin.json_lines(spark, sf_dir))))


def pending_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = sources.height_range(spark, standin.FIRST_HEIGHT, standin.tip(spark, sf_dir))
    return op.pending_heights(wanted, standin.loaded_heights(spark, sf_dir))


def resume_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders")
    blocks = orders.selectExpr(f"{standin.DENSE_HEIGHT} AS height")
    # As if the run had stopped half-way up the chain.
    ends = blocks.agg(F.min("height").alias("low"), F.max("height").alias("high"))
    progress = ends.select(F.expr("(low + high) div 2").alias("last_block_processed"))
    return op.heights_after(blocks, progress)


def block_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.block_headers(_accepted_blocks(spark, sf_dir))


def block_tx_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.tx_edges(_accepted_blocks(spark, sf_dir))


def reward_all_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = op.coinbase_values(standin.transactions(spark, sf_dir))
    references = op.accepted(op.node_references(standin.node_lines(spark, sf_dir)))
    blocks = op.attach_coinbase(references.select("height", "txid"), values)
    fees = op.node_fee(blocks, outputs="all", subsidy="fixed").select("height", "fee_btc")
    return blocks.select("height", "txid", "n_outputs", "total_value").join(fees, "height")


def fee_series_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.fee_series(_parity_fees(spark, sf_dir), SERIES_FIRST, SERIES_LAST)


def fee_series_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.fee_buckets(_parity_fees(spark, sf_dir))


def fee_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.top_fees(_parity_fees(spark, sf_dir))


def fee_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.fee_outliers(_parity_fees(spark, sf_dir), OUTLIER_COINS)


def mode_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standin.explorer_lines(spark, sf_dir)
    return op.compare_sources(_node_fees(spark, sf_dir), plans.explorer_fees(lines))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = op.node_references(standin.flawed_node_lines(spark, sf_dir))
    references = parsed.select("txid", "reason")
    return op.reason_counts(op.look_up_coinbase(references, standin.coinbase(spark, sf_dir)))


def stream_fee_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = streaming.work_dir(spark)
    values = standin.coinbase(spark, sf_dir).drop("l_orderkey")
    # Every micro-batch is a large part of the chain, so few partitions do.
    sinks.put_coinbase(values, f"{base}/coinbase", 0, digits=1)
    known = sinks.coinbase_reader(spark, f"{base}/coinbase")
    refused = f"{base}/refused"
    put = plans.put_node_fees(known, f"{base}/table", refused, mode="positional", subsidy="fixed")
    _stream(standin.node_lines(spark, sf_dir), put, spark, base)
    cells = sinks.read_table(spark, f"{base}/table")
    return cells.select(
        F.col("rowkey").cast("bigint").alias("height"), F.col("value").cast(COIN).alias("fee_btc")
    )


def stream_fee_explorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = streaming.work_dir(spark)
    put = plans.put_explorer_fees(f"{base}/table", f"{base}/refused", mode="positional")
    _stream(standin.explorer_lines(spark, sf_dir), put, spark, base)
    return sinks.read_table(spark, f"{base}/table").select("rowkey", "value")


def stream_json_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = streaming.work_dir(spark)
    put = plans.put_json(f"{base}/table", f"{base}/refused", seq_path="$.event")
    _stream(standin.json_lines(spark, sf_dir), put, spark, base)
    puts = sinks.read_table(spark, f"{base}/table")
    return sinks.latest_by_key(puts, order=("seq", "put_id")).select("rowkey", "value")


def fee_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of dump written as text files and scanned again."""
    node = sources.read_lines(spark, _written_lines(standin.node_lines(spark, sf_dir), spark))
    explorer = sources.read_lines(
        spark, _written_lines(standin.explorer_lines(spark, sf_dir), spark)
    )
    fees = plans.node_fees(node, standin.coinbase(spark, sf_dir))
    return fees.unionByName(plans.explorer_fees(explorer))


def blocks_by_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = sources.height_range(spark, SERIES_FIRST, SERIES_LAST)
    blocks = op.blocks_at(wanted, _accepted_blocks(spark, sf_dir))
    return blocks.select("height", "hash", "merkleroot")


def fee_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All explorer fees put by one writer; node fees by wrong rules by another, compacted. Then a batch with
    a lower number comes late, and the one in the snapshot is put again, right and with even heights only."""
    base = streaming.work_dir(spark)
    table = f"{base}/table"
    explorer = op.fee_cells(plans.explorer_fees(standin.explorer_lines(spark, sf_dir)), "fee_sat")
    sinks.put_batch(explorer, table, 0, writer="explorer")
    fixed = _node_fees(spark, sf_dir, subsidy="fixed", outputs="all")
    sinks.put_batch(op.fee_cells(fixed), table, 5, writer="node")
    sinks.compact(spark, table)
    # Put three times, looked up once.
    op.fee_cells(_node_fees(spark, sf_dir)).write.parquet(f"{base}/node")
    node = spark.read.parquet(f"{base}/node")
    sinks.put_batch(node, table, 3, writer="node")
    for _ in range(2):
        sinks.put_batch(node.where("CAST(rowkey AS bigint) % 2 = 0"), table, 5, writer="node")
    sinks.compact(spark, table)
    return sinks.latest_by_key(sinks.read_table(spark, table))


def line_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node lines that contain a key, flattened into segments, by position."""
    lines = sources.lines_with(standin.node_lines(spark, sf_dir), "'previousblockhash'").select("value")
    return (
        sources.line_segments(lines)
        .groupBy("pos")
        .agg(
            F.count(F.lit(1)).alias("segments"),
            F.sum(F.length("segment")).cast("bigint").alias("characters"),
        )
    )


def progress_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.progress_marker(_parity_fees(spark, sf_dir))


def fee_nested_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fees from transactions with their outputs nested, first output and all of them."""
    values = op.coinbase_values(standin.transactions(spark, sf_dir))
    lines = standin.node_lines(spark, sf_dir)
    first = plans.node_fees(lines, values).select("height", F.col("fee_btc").alias("first_fee"))
    every = plans.node_fees(lines, values, outputs="all").select("height", F.col("fee_btc").alias("all_fee"))
    return first.join(every, "height")


def text_escapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as JSON writes them, decoded again."""
    documents = standin.table(spark, sf_dir, "documents")
    written = F.to_json(F.struct("text"))
    inner = F.substr(written, F.lit(len('{"text":"') + 1), F.length(written) - len('{"text":"') - len('"}'))
    return documents.select("doc_id", normalise_text(inner).alias("text"))


def rounded_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts with eleven places, rounded to eight."""
    orders = standin.table(spark, sf_dir, "orders")
    amount = F.col("o_totalprice").cast("decimal(18,2)") * F.lit(Decimal("0.123456789"))
    return orders.select("o_orderkey", round_coin(amount).alias("amount"))


def redriven_fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third transaction comes late; its blocks are put out of the quarantine."""
    base = streaming.work_dir(spark)
    values = standin.coinbase(spark, sf_dir)
    late = F.col("l_orderkey") % 3 == 0
    sinks.put_coinbase(values.where(~late).drop("l_orderkey"), f"{base}/coinbase", 0, digits=1)
    known = sinks.coinbase_reader(spark, f"{base}/coinbase")
    table, refused = f"{base}/table", f"{base}/refused"
    put = plans.put_node_fees(known, table, refused)
    put(standin.node_lines(spark, sf_dir), 0)
    redrive = plans.redrive_node_fees(known, table, refused)
    redrive(spark, 0)
    sinks.put_coinbase(values.where(late).drop("l_orderkey"), f"{base}/coinbase", 1, digits=1)
    for batch in (1, 1, 2):
        redrive(spark, batch)
    return sinks.read_table(spark, table).select("rowkey", "value", "source", "unit", "put_by", "put_id")


def pending_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = standin.loaded_heights(spark, sf_dir)
    return op.pending_ranges(loaded, standin.FIRST_HEIGHT, standin.tip(spark, sf_dir))


def contiguous_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.contiguous_marker(standin.loaded_heights(spark, sf_dir), standin.FIRST_HEIGHT)


def put_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of a stream were put, and refused for which reason, as its puts counted them."""
    base = streaming.work_dir(spark)
    sinks.put_coinbase(standin.coinbase(spark, sf_dir).drop("l_orderkey"), f"{base}/coinbase", 0, digits=1)
    known = sinks.coinbase_reader(spark, f"{base}/coinbase")
    counts: list[tuple[int, str, int]] = []

    def report(batch_id: int, found: dict[str, int]) -> None:
        counts.extend((batch_id, reason, lines) for reason, lines in found.items() if reason != "lines")

    put = plans.put_node_fees(known, f"{base}/table", f"{base}/refused", report=report)
    _stream(standin.flawed_node_lines(spark, sf_dir), put, spark, base)
    known = [F.struct(*map(F.lit, row)) for row in counts]
    rows = spark.range(1).select(F.inline(F.array(*known)).alias("batch", "reason", "lines")).where("lines > 0")
    return rows.groupBy("reason").agg(F.sum("lines").cast("long").alias("lines"))


def _header_table(spark: SparkSession, sf_dir: str) -> str:
    """Headers put by height in two batches, the later of which has every block below the middle again."""
    table = f"{streaming.work_dir(spark)}/headers"
    headers = op.block_headers(_accepted_blocks(spark, sf_dir))
    sinks.put_blocks(headers, table, 0)
    sinks.put_blocks(headers.where(F.col("height") < SERIES_FIRST + 500), table, 1)
    sinks.compact(spark, table, keys=["height"])
    return table


def header_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sinks.blocks_between(spark, _header_table(spark, sf_dir), SERIES_FIRST, SERIES_LAST)
    return rows.select("height", "hash", "difficulty", "previousblockhash", "put_id")


def headers_of_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of the blocks that have no generation transaction."""
    wanted = pending_heights(spark, sf_dir)
    return sinks.blocks_of(spark, _header_table(spark, sf_dir), wanted).select("height", "hash", "nonce")


def edge_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{streaming.work_dir(spark)}/edges"
    sinks.put_blocks(op.tx_edges(_accepted_blocks(spark, sf_dir)), table, 0, sort_by=("pos",))
    return sinks.blocks_between(spark, table, SERIES_FIRST, SERIES_LAST).select("height", "pos", "txid")


def buckets_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets after a put of all fees by the first output, and one of some by all outputs."""
    base = streaming.work_dir(spark)
    table, out = f"{base}/table", f"{base}/buckets"
    for batch, outputs in enumerate(("first", "all")):
        fees = _node_fees(spark, sf_dir, outputs=outputs)
        if batch:
            fees = fees.where(F.col("height") >= SERIES_LAST)
        cells = op.fee_cells(fees).withColumn("height_range", F.expr("CAST(rowkey AS bigint) div 10000 * 10000"))
        sinks.put_batch(cells, table, batch, ["height_range"])
        sinks.refresh_buckets(spark, table, out)
    return sinks.read_buckets(spark, out)


def reconcile_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources written in buckets of height and compared without another shuffle."""
    base = streaming.work_dir(spark)
    name = base.rsplit("/", 1)[-1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    explorer = plans.explorer_fees(standin.explorer_lines(spark, sf_dir))
    both = {"node": _node_fees(spark, sf_dir), "explorer": explorer}
    tables = [sinks.write_by_height(fees, f"{name}_{k}", f"{base}/{k}", buckets) for k, fees in both.items()]
    return op.compare_sources(*tables)


def positional_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point numbered as a plot counts them, from the first height on."""
    fees = _parity_fees(spark, sf_dir)
    return op.positional_series(fees, standin.FIRST_HEIGHT, standin.tip(spark, sf_dir), standin.FIRST_HEIGHT)


def whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump whose files are read as one record each, and cut into lines afterwards."""
    dump = _written_lines(standin.node_lines(spark, sf_dir), spark, maxRecordsPerFile=LINES_PER_WHOLE_FILE)
    files = sources.read_lines(spark, dump, whole_file=True)
    lines = files.select(F.explode(F.split("value", "\n")).alias("value")).where("value <> ''")
    return op.accepted(op.node_references(lines)).select("height", "txid")


def bounded_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first points of the series, as many as fit a screen."""
    fees = _parity_fees(spark, sf_dir)
    return op.fee_series(fees, standin.FIRST_HEIGHT, standin.tip(spark, sf_dir)).limit(streaming.run.PREVIEW_ROWS)


def interval_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The explorer stream at an interval, for a bounded time, until nothing new comes."""
    base = streaming.work_dir(spark)
    put = plans.put_explorer_fees(f"{base}/table", f"{base}/refused", mode="positional")
    source = sources.stream_lines(spark, _written_lines(standin.explorer_lines(spark, sf_dir), spark), FILES_PER_TRIGGER)
    timeout = streaming.run.EXPLORER_TIMEOUT_SECONDS
    streaming.run_stream(source, put, f"{base}/checkpoint", timeout=timeout, until_idle=True)
    return sinks.read_table(spark, f"{base}/table").select("rowkey", "value")


def stream_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of the first micro-batch, a whole dump in one file, a preview shows."""
    lines = standin.explorer_lines(spark, sf_dir).select("value")
    base = streaming.work_dir(spark)
    lines.repartition(1).write.text(f"{base}/lines")
    fees = op.explorer_fields(sources.stream_lines(spark, f"{base}/lines"), "positional").select("fee_text_padded")

    def show(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/shown/batch={batch_id}")

    streaming.preview_batches(fees, show, interval=None)
    shown = spark.read.schema("fee_text_padded string, batch int").parquet(f"{base}/shown")
    return shown.groupBy("batch").agg(F.count(F.lit(1)).alias("shown"))


def quarantine_explorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.reason_counts(op.explorer_fields(standin.flawed_explorer_lines(spark, sf_dir)))


def quarantine_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.reason_counts(op.json_records(standin.flawed_json_lines(spark, sf_dir)))


def corrected_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions put, those of every third order corrected later, looked up again."""
    table = f"{streaming.work_dir(spark)}/coinbase"
    values = standin.coinbase(spark, sf_dir)
    later = values.where("l_orderkey % 3 = 0").withColumns(
        {
            "first_value": (F.col("first_value") + 5).cast(COIN),
            "total_value": (F.col("total_value") - 3).cast(TOTAL_COIN),
        }
    )
    sinks.put_coinbase(values.drop("l_orderkey"), table, 0, digits=1)
    sinks.put_coinbase(later.drop("l_orderkey"), table, 1, digits=1)
    sinks.compact_coinbase(spark, table)
    parsed = op.node_references(standin.node_lines(spark, sf_dir)).select("height", "txid", "reason")
    found = op.look_up_coinbase(parsed, sinks.coinbase_reader(spark, table)(parsed))
    return found.select("height", "first_value", "total_value", "n_outputs", "reason")


QUERIES: dict[str, Query] = {
    "q01_fee_node_batch": fee_node_batch,
    "q02_block_named_parse": block_named_parse,
    "q03_fee_explorer_batch": fee_explorer_batch,
    "q04_fee_explorer_units": fee_explorer_units,
    "q05_coinbase_ref": coinbase_ref,
    "q06_text_normalise": text_normalise,
    "q07_subsidy_by_height": subsidy_by_height,
    "q08_fee_era": fee_era,
    "q09_put_rows": put_rows,
    "q10_latest_by_key": latest_by_key,
    "q11_json_cells": json_cells,
    "q12_pending_heights": pending_heights,
    "q13_resume_filter": resume_filter,
    "q14_block_headers": block_headers,
    "q15_block_tx_edges": block_tx_edges,
    "q16_reward_all_outputs": reward_all_outputs,
    "q17_fee_series_slice": fee_series_slice,
    "q18_fee_series_bucket": fee_series_bucket,
    "q19_fee_topk": fee_topk,
    "q20_mode_reconcile": mode_reconcile,
    "q21_quarantine": quarantine,
    "q22_stream_fee_node": stream_fee_node,
    "q23_stream_fee_explorer": stream_fee_explorer,
    "q24_stream_json_upsert": stream_json_upsert,
    "q25_fee_text_scan": fee_text_scan,
    "q26_blocks_by_height": blocks_by_height,
    "q27_fee_table_upsert": fee_table_upsert,
    "q28_fee_outliers": fee_outliers,
    "q29_line_segments": line_segments,
    "q30_progress_marker": progress_marker,
    "q31_fee_nested_outputs": fee_nested_outputs,
    "q32_text_escapes": text_escapes,
    "q33_rounded_amounts": rounded_amounts,
    "q34_quarantine_explorer": quarantine_explorer,
    "q35_quarantine_json": quarantine_json,
    "q36_corrected_lookup": corrected_lookup,
    "q37_redriven_fees": redriven_fees,
    "q38_pending_ranges": pending_ranges,
    "q39_contiguous_marker": contiguous_marker,
    "q40_put_counts": put_counts,
    "q41_header_slice": header_slice,
    "q42_headers_of_pending": headers_of_pending,
    "q43_edge_slice": edge_slice,
    "q44_buckets_refreshed": buckets_refreshed,
    "q45_reconcile_by_bucket": reconcile_by_bucket,
    "q46_positional_series": positional_series,
    "q47_whole_files": whole_files,
    "q48_bounded_preview": bounded_preview,
    "q49_interval_stream": interval_stream,
    "q50_stream_preview": stream_preview,
}
