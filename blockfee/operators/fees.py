"""The transaction fee of a block."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockfee.functions import block_subsidy, to_coin, to_satoshi
from blockfee.schemas import COIN


def node_fee(blocks: DataFrame, outputs: str = "first", subsidy: str = "era") -> DataFrame:
    """Fee = what the generation transaction pays out, less the subsidy.

    ``outputs``: ``first`` counts the first output only, ``all`` every output.
    ``subsidy``: ``era`` halves it with the height, ``fixed`` is always 25 coins.
    """
    fee = _fee(outputs, subsidy)
    return blocks.select("height", fee.alias("fee_btc")).select(
        "height",
        "fee_btc",
        to_satoshi(F.col("fee_btc")).alias("fee_sat"),
        F.lit("node").alias("source"),
    )


def _fee(outputs: str, subsidy: str) -> Column:
    if outputs not in ("first", "all"):
        raise ValueError(f"unknown outputs rule: {outputs!r}")
    paid = F.col("first_value" if outputs == "first" else "total_value")
    # One absurd amount must not fail the job: beyond what money can be, it is null.
    return (paid - block_subsidy(F.col("height"), subsidy)).try_cast(COIN)


def refuse_bad_amounts(
    looked_up: DataFrame, outputs: str = "first", subsidy: str = "era"
) -> DataFrame:
    """Give blocks whose fee can't be money a reason."""
    bad = F.when(_fee(outputs, subsidy).isNull(), "bad_amount")
    return looked_up.withColumn("reason", F.coalesce("reason", bad))


def explorer_fee(blocks: DataFrame) -> DataFrame:
    """Fee records from the fee that the explorer states itself."""
    return blocks.select(
        "height",
        to_coin(F.col("fee_sat")).alias("fee_btc"),
        "fee_sat",
        F.lit("explorer").alias("source"),
    )
