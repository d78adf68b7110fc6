"""Tables by height: blocks that are found without reading all, and buckets kept up to date."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockfee.operators import cell_fees, fee_buckets
from blockfee.sinks.files import matching, read_text, remove
from blockfee.sinks.tables import Log, _batches, latest_by_key, note_once, put_batch, read_log, read_table

#: Heights in a partition.
HEIGHTS = 10_000
HEIGHT_RANGE = "height_range"


def _range_of(height: str = "height"):
    return (F.col(height) - F.pmod(height, F.lit(HEIGHTS))).alias(HEIGHT_RANGE)


def put_blocks(
    rows: DataFrame, path: str, batch_id: int, writer: str = "batch", read_from: str | None = None, sort_by: tuple[str, ...] = ()
) -> None:
    """Put headers or edges (height, ...), partitioned by range of height and sorted by height in each file."""
    put_batch(rows.select("*", _range_of()), path, batch_id, [HEIGHT_RANGE], writer, read_from, ("height", *sort_by))


def blocks_between(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """The rows of heights from ``start`` up to, not including, ``stop``.

    Reads the partitions of these heights only, and of their files the parts whose
    heights reach into the range.
    """
    low = start - start % HEIGHTS
    rows = read_table(spark, path).where(F.col(HEIGHT_RANGE).between(low, stop - 1))
    return rows.where((F.col("height") >= start) & (F.col("height") < stop)).drop(HEIGHT_RANGE)


def blocks_of(spark: SparkSession, path: str, heights: DataFrame) -> DataFrame:
    """The rows of some heights; few heights prune the partitions that are read."""
    wanted = heights.select(_range_of(), "height").distinct()
    return read_table(spark, path).join(wanted, [HEIGHT_RANGE, "height"], "left_semi").drop(HEIGHT_RANGE)


def _touched(spark: SparkSession, table: str, log: Log, known: dict) -> set[int] | None:
    """Ranges that batches put since ``known`` have cells in; None if that can't be told."""
    changed = {batch: rev for batch, rev in log.revisions.items() if known.get(batch) != rev}
    held = _batches(log.snapshots.get(log.current(), {}))
    if any(b not in log.revisions and known.get(b) != rev for b, rev in held.items()):
        return None  # a batch came and was compacted away
    looked = [log.directory(b, r) for b, r in changed.items()]
    for batch in changed:
        if batch in known:  # what the batch had before counts too
            old = log.directory(batch, known[batch])
            if not matching(spark, old, "_SUCCESS"):
                return None
            looked.append(old)
    names = {name for directory in looked for name in matching(spark, directory, f"{HEIGHT_RANGE}=*")}
    return {int(name.split("=")[1]) for name in names}


def refresh_buckets(spark: SparkSession, table: str, out: str, blocks_per_bucket: int = 1000, source: str = "node") -> list[int] | None:
    """Bring the buckets in ``out`` up to date with a fee table; returns the ranges done anew, None for all.

    Only ranges of heights that batches put since the last refresh have cells in are
    aggregated again, and replaced as partitions. What is done is noted last, so a refresh
    that fails is done again by the next.
    """
    if HEIGHTS % blocks_per_bucket:
        raise ValueError(f"buckets must divide {HEIGHTS} heights")
    note_once(spark, out, "buckets", json.dumps([table, blocks_per_bucket, source]))
    numbers = [int(name.split("-")[-1]) for name in matching(spark, out, "_notes/refreshed-*")]
    last = max(numbers, default=-1)
    known = json.loads(read_text(spark, f"{out}/_notes/refreshed-{last}")) if numbers else None
    log = read_log(spark, table)
    ranges = _touched(spark, table, log, {(w, n): r for w, n, r in known}) if known is not None else None
    puts = read_table(spark, table).where(F.col("source") == source)
    if ranges is not None:
        puts = puts.where(F.col(HEIGHT_RANGE).isin(sorted(ranges)))
    if ranges != set():
        buckets = fee_buckets(cell_fees(latest_by_key(puts)), blocks_per_bucket).select("*", _range_of("bucket_start"))
        buckets = buckets.hint("rebalance", HEIGHT_RANGE)
        buckets.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(HEIGHT_RANGE).parquet(out)
        # A range all of whose cells went has no partition to replace the old one. A row for each range.
        filled = {row[0] for row in puts.select(HEIGHT_RANGE).distinct().collect()}
        there = {int(name.split("=")[1]) for name in matching(spark, out, f"{HEIGHT_RANGE}=*")}
        for gone in (there if ranges is None else ranges & there) - filled:
            remove(spark, f"{out}/{HEIGHT_RANGE}={gone}")
    done = {**_batches(log.snapshots.get(log.current(), {})), **log.revisions}
    note_once(spark, out, f"refreshed-{last + 1}", json.dumps([[w, n, r] for (w, n), r in sorted(done.items())]))
    return None if ranges is None else sorted(ranges)


def read_buckets(spark: SparkSession, out: str) -> DataFrame:
    """The buckets as of the last refresh."""
    kind = "bucket_start long, blocks long, min_fee decimal(18,8), max_fee decimal(18,8), sum_fee decimal(28,8)"
    return spark.read.schema(f"{kind}, {HEIGHT_RANGE} long").parquet(out).drop(HEIGHT_RANGE)


def write_by_height(fees: DataFrame, name: str, path: str, buckets: int = 200) -> DataFrame:
    """A catalogue table of fees in hash buckets of height, each sorted; joins with its like need no shuffle.

    ``compare_sources`` of two such tables with as many buckets reads bucket against bucket.
    """
    dealt = fees.repartition(buckets, "height")  # a file for each bucket
    writer = dealt.write.bucketBy(buckets, "height").sortBy("height").option("path", path).format("parquet")
    writer.mode("errorifexists").saveAsTable(name)
    return fees.sparkSession.table(name)
