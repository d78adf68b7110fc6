"""Column functions; every one compiles to built-in Spark expressions."""

from blockfee.functions.ids import pack_id, unpack_id
from blockfee.functions.literal import JSON_OPTIONS, list_items, literal_to_json
from blockfee.functions.money import (
    SATOSHI_PER_COIN,
    block_subsidy,
    round_coin,
    subsidy_sat,
    to_coin,
    to_satoshi,
)
from blockfee.functions.text import ascii_only, normalise_text, to_json_text, unescape

__all__ = [
    "JSON_OPTIONS",
    "SATOSHI_PER_COIN",
    "ascii_only",
    "block_subsidy",
    "list_items",
    "literal_to_json",
    "normalise_text",
    "pack_id",
    "round_coin",
    "subsidy_sat",
    "to_coin",
    "to_json_text",
    "to_satoshi",
    "unescape",
    "unpack_id",
]
