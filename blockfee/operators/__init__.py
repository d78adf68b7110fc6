"""DataFrame -> DataFrame operators, shared by batch jobs and streams."""

from blockfee.operators.blocks import block_headers, blocks_at, tx_edges
from blockfee.operators.cells import cell_fees, fee_cells, json_cells, json_records
from blockfee.operators.coinbase import (
    attach_coinbase,
    coinbase_values,
    look_up_coinbase,
    merge_copies,
    output_values,
)
from blockfee.operators.fees import explorer_fee, node_fee, refuse_bad_amounts
from blockfee.operators.parse import explorer_fields, node_blocks, node_references
from blockfee.operators.quarantine import accepted, outcome_metrics, quarantined, reason_counts, require_all
from blockfee.operators.reconcile import compare_sources
from blockfee.operators.ordered import numbered, with_previous
from blockfee.operators.resume import (
    contiguous_marker,
    heights_after,
    pending_heights,
    pending_ranges,
    progress_marker,
)
from blockfee.operators.series import fee_buckets, fee_outliers, fee_series, positional_series, top_fees

__all__ = [
    "accepted",
    "attach_coinbase",
    "block_headers",
    "blocks_at",
    "cell_fees",
    "coinbase_values",
    "compare_sources",
    "contiguous_marker",
    "explorer_fee",
    "explorer_fields",
    "fee_buckets",
    "fee_cells",
    "fee_outliers",
    "fee_series",
    "heights_after",
    "json_cells",
    "json_records",
    "look_up_coinbase",
    "merge_copies",
    "node_blocks",
    "node_fee",
    "node_references",
    "numbered",
    "outcome_metrics",
    "output_values",
    "pending_heights",
    "pending_ranges",
    "positional_series",
    "progress_marker",
    "quarantined",
    "reason_counts",
    "refuse_bad_amounts",
    "require_all",
    "top_fees",
    "tx_edges",
    "with_previous",
]
