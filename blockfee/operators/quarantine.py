"""Split parsed rows into usable and unusable ones."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Every reason that lines are refused for.
REASONS = (
    "empty_line",
    "stray_text",
    "truncated",
    "bad_height",
    "bad_txid",
    "bad_fee",
    "bad_amount",
    "bad_json",
    "bad_id",
    "no_id",
    "missing_transaction",
    "ambiguous_transaction",
)


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows without a reason against them."""
    return parsed.where(F.col("reason").isNull()).drop("reason")


def quarantined(parsed: DataFrame) -> DataFrame:
    """Refused rows, with the reason."""
    return parsed.where(F.col("reason").isNotNull())


def require_all(parsed: DataFrame) -> DataFrame:
    """Fail the job at the first refused line instead of setting it aside."""
    message = F.concat(
        F.lit("unusable line ("), F.col("reason"), F.lit("): "), F.coalesce(F.left("value", F.lit(200)), F.lit(""))
    )
    checked = F.when(F.col("reason").isNull(), True).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return parsed.where(checked).drop("reason")


def reason_counts(parsed: DataFrame) -> DataFrame:
    """Number of lines per reason; usable lines count as ``ok``."""
    return parsed.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(
        F.count(F.lit(1)).alias("lines")
    )


def outcome_metrics() -> list[Column]:
    """For ``observe``: all rows, the usable ones (``ok``), and those with each reason."""
    refused = [F.count_if(F.col("reason") == reason).alias(reason) for reason in REASONS]
    return [F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reason").isNull()).alias("ok"), *refused]
