"""Exact money: coins as decimal(18,8), the smallest unit as bigint."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from blockfee.schemas import COIN

# Fixed values of the protocol.
SATOSHI_PER_COIN = 100_000_000
FIRST_SUBSIDY_SAT = 50 * SATOSHI_PER_COIN
HALVING_INTERVAL = 210_000
HALVINGS_UNTIL_ZERO = 64

#: The subsidy of heights 210,000 to 419,999, in coins.
FIXED_SUBSIDY = Decimal(25)


def to_satoshi(coins: Column) -> Column:
    """Coins to the smallest unit."""
    return (coins * F.lit(SATOSHI_PER_COIN)).cast("bigint")


def to_coin(satoshi: Column) -> Column:
    """The smallest unit to coins; null where the amount cannot be money."""
    scaled = satoshi.cast("decimal(20,0)") * F.lit(Decimal("0.00000001"))
    return scaled.try_cast(COIN)


def round_coin(amount: Column) -> Column:
    """Round any number to the eight places money has."""
    return F.round(amount.cast("decimal(38,18)"), 8).cast(COIN)


def subsidy_sat(height: Column) -> Column:
    """Mining subsidy of a block in the smallest unit: 50 coins, halved per era."""
    era = F.call_function("div", height, F.lit(HALVING_INTERVAL)).cast("int")
    # A shift by 64 or more wraps around, so later eras are spelled out.
    return F.when(
        height < HALVING_INTERVAL * HALVINGS_UNTIL_ZERO,
        F.call_function("shiftright", F.lit(FIRST_SUBSIDY_SAT).cast("bigint"), era),
    ).when(height.isNotNull(), F.lit(0).cast("bigint"))


def block_subsidy(height: Column, rule: str) -> Column:
    """Subsidy in coins, by height (``era``) or the constant 25 (``fixed``)."""
    if rule == "era":
        return to_coin(subsidy_sat(height))
    if rule == "fixed":
        return F.lit(FIXED_SUBSIDY).cast(COIN)
    raise ValueError(f"unknown subsidy rule: {rule!r}")
