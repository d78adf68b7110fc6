"""From lines to fee records, for batches and micro-batches alike."""

from pyspark.sql import DataFrame

from blockfee.operators import (
    accepted,
    attach_coinbase,
    explorer_fee,
    explorer_fields,
    node_fee,
    node_references,
)


def node_fees(
    lines: DataFrame,
    coinbase: DataFrame,
    mode: str = "named",
    outputs: str = "first",
    subsidy: str = "era",
) -> DataFrame:
    """Fees of node block lines; they shrink to (height, txid) before the join."""
    references = accepted(node_references(lines, mode)).select("height", "txid")
    return node_fee(attach_coinbase(references, coinbase), outputs, subsidy)


def explorer_fees(lines: DataFrame, mode: str = "named") -> DataFrame:
    """Fees of explorer block lines, as they state them; no shuffle at all."""
    return explorer_fee(accepted(explorer_fields(lines, mode)))
