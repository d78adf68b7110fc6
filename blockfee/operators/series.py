"""The evolution of the fee over block height."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockfee.operators.ordered import numbered
from blockfee.schemas import COIN, TOTAL_COIN


def fee_series(fees: DataFrame, first: int, last: int) -> DataFrame:
    """(height, fee) points from ``first`` to ``last``, in order of height.

    The row number breaks ties, so the sort can share out many equal points.
    """
    points = fees.where(F.col("height").between(first, last)).select("height", "fee_btc")
    return (
        points.withColumn("_row", F.monotonically_increasing_id())
        .orderBy("height", "fee_btc", "_row")
        .drop("_row")
    )


def positional_series(fees: DataFrame, first: int, last: int, start: int = 0) -> DataFrame:
    """The same points, numbered in order from ``start``: (position, height, fee).

    For plots that count points instead of reading their height.
    """
    points = fees.where(F.col("height").between(first, last)).select("height", "fee_btc")
    placed = numbered(points, "height", "fee_btc", name="position")
    return placed.select((F.col("position") + start).alias("position"), "height", "fee_btc")


def fee_buckets(fees: DataFrame, blocks_per_bucket: int = 1000) -> DataFrame:
    """Count, least, greatest and total fee of each run of heights."""
    start = F.col("height") - F.pmod("height", F.lit(blocks_per_bucket))
    return fees.groupBy(start.alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("blocks"),
        F.min("fee_btc").cast(COIN).alias("min_fee"),
        F.max("fee_btc").cast(COIN).alias("max_fee"),
        F.sum("fee_btc").cast(TOTAL_COIN).alias("sum_fee"),
    )


def fee_outliers(fees: DataFrame, above: int = 200) -> DataFrame:
    """Blocks whose fee is greater than a number of coins."""
    return fees.where(F.col("fee_btc") > F.lit(above)).select("height", "fee_btc")


def top_fees(fees: DataFrame, count: int = 10) -> DataFrame:
    """The blocks with the greatest fees, lower heights first among equals."""
    return (
        fees.select("height", "fee_btc")
        .orderBy(F.col("fee_btc").desc(), F.col("height"))
        .limit(count)
    )
