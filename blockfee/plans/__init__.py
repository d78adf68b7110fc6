"""Whole jobs, composed of operators."""

from blockfee.plans.fees import explorer_fees, node_fees
from blockfee.plans.puts import (
    DROP,
    FAIL,
    Put,
    Report,
    put_explorer_fees,
    put_json,
    put_node_fees,
    redrive_node_fees,
)

__all__ = [
    "DROP",
    "FAIL",
    "Put",
    "Report",
    "explorer_fees",
    "node_fees",
    "put_explorer_fees",
    "put_json",
    "put_node_fees",
    "redrive_node_fees",
]
