"""Block headers, block-to-transaction edges, blocks by height."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockfee.operators.once import with_columns_once


def block_headers(blocks: DataFrame) -> DataFrame:
    """Header table; the first block has no predecessor and gets an empty text."""
    return blocks.select(
        "hash",
        "confirmations",
        "size",
        "height",
        "version",
        "time",
        "nonce",
        "bits",
        F.col("difficulty").cast("double").alias("difficulty"),
        "chainwork",
        F.coalesce("previousblockhash", F.lit("")).alias("previousblockhash"),
        "nextblockhash",
    )


def tx_edges(blocks: DataFrame) -> DataFrame:
    """One row per transaction of each block, with its place in the block."""
    # Exploding adds a filter on the list's size, which would split it twice.
    lists = with_columns_once(blocks.select("height", "tx"), _tx=F.col("tx"))
    return lists.select("height", F.posexplode("_tx").alias("pos", "txid"))


def blocks_at(heights: DataFrame, blocks: DataFrame) -> DataFrame:
    """The blocks at the given heights; repeated heights repeat nothing."""
    return blocks.join(heights.select("height"), "height", "left_semi")
