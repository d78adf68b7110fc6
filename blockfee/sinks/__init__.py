"""Replay-safe keyed tables on plain parquet."""

from blockfee.sinks.coinbase import coinbase_reader, compact_coinbase, put_coinbase
from blockfee.sinks.ranges import blocks_between, blocks_of, put_blocks, read_buckets, refresh_buckets, write_by_height
from blockfee.sinks.tables import compact, latest_by_key, put_batch, read_log, read_table, remove_replaced, replaced

__all__ = [
    "blocks_between",
    "blocks_of",
    "coinbase_reader",
    "compact",
    "compact_coinbase",
    "latest_by_key",
    "put_batch",
    "put_blocks",
    "put_coinbase",
    "read_buckets",
    "read_log",
    "read_table",
    "refresh_buckets",
    "remove_replaced",
    "replaced",
    "write_by_height",
]
