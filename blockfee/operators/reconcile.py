"""Compare the fee of the same heights as derived by two routes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_height(fees: DataFrame, name: str) -> DataFrame:
    # Copies of a height merge before the shuffle, so the full join below meets
    # each height once per side; unequal copies are reported, not hidden.
    return (
        fees.where(F.col("height").isNotNull())
        .groupBy("height")
        .agg(F.min("fee_sat").alias(f"{name}_fee_sat"), F.max("fee_sat").alias(f"_{name}_max"))
    )


def compare_sources(node: DataFrame, explorer: DataFrame) -> DataFrame:
    """Both fees of each height side by side, their difference and a status."""
    both = _per_height(node, "node").join(_per_height(explorer, "explorer"), "height", "full_outer")
    left, right = F.col("node_fee_sat"), F.col("explorer_fee_sat")
    ambiguous = (left != F.col("_node_max")) | (right != F.col("_explorer_max"))
    status = (
        F.when(ambiguous, "ambiguous")
        .when(left.isNull(), "explorer_only")
        .when(right.isNull(), "node_only")
        .when(left == right, "match")
        .otherwise("differ")
    )
    return both.select(
        "height",
        "node_fee_sat",
        "explorer_fee_sat",
        (left - right).alias("difference_sat"),
        status.alias("status"),
    )
