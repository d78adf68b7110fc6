"""Rows of a keyed table: (rowkey, family, qualifier, value), all text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockfee.functions import to_coin, to_satoshi
from blockfee.operators.once import with_columns_once
from blockfee.schemas import COIN

# Names under which results are stored.
FEE_FAMILY, FEE_QUALIFIER = "tx_fee_col", "tx_fee"
UNITS = {"fee_btc": "coin", "fee_sat": "satoshi"}
JSON_FAMILY, JSON_QUALIFIER = "cfamily", "cats_json"


def fee_cells(fees: DataFrame, value: str = "fee_btc", rowkey: str = "height") -> DataFrame:
    """One cell per fee record, keyed by height, with the source and unit of the value."""
    return fees.select(
        F.col(rowkey).cast("string").alias("rowkey"),
        F.lit(FEE_FAMILY).alias("family"),
        F.lit(FEE_QUALIFIER).alias("qualifier"),
        F.col(value).cast("string").alias("value"),
        "source",
        F.lit(UNITS[value]).alias("unit"),
    )


def cell_fees(cells: DataFrame) -> DataFrame:
    """The fee records that cells were made of, whatever unit their values are in."""
    coins = F.col("unit") == "coin"
    fee_sat = F.when(coins, to_satoshi(F.when(coins, F.col("value")).try_cast(COIN))).otherwise(
        F.col("value").try_cast("bigint")
    )
    fees = cells.select(F.col("rowkey").cast("bigint").alias("height"), fee_sat.alias("fee_sat"), "source")
    return fees.select("height", to_coin(F.col("fee_sat")).alias("fee_btc"), "fee_sat", "source")


def json_records(lines: DataFrame, id_path: str = "$.id") -> DataFrame:
    """Add the ``id`` of each JSON line and ``reason`` (null if the line is JSON and its id a scalar)."""
    # Inside a list nothing can follow the record but the list's own end.
    listed = with_columns_once(lines, _listed=F.try_parse_json(F.concat(F.lit("["), "value", F.lit(",1]"))))
    path = id_path.replace("$", "$[0]", 1)
    whole = F.try_variant_get("_listed", "$[1]", "int").eqNullSafe(F.lit(1)) & F.try_variant_get(
        "_listed", "$[2]", "variant"
    ).isNull()
    kind = F.schema_of_variant(F.try_variant_get("_listed", path, "variant"))
    keyed = with_columns_once(
        listed,
        _whole=whole,
        _scalar=~(kind.startswith("OBJECT") | kind.startswith("ARRAY")),
        id=F.try_variant_get("_listed", path, "string"),
    )
    reason = (
        F.when(~F.col("_whole"), "bad_json").when(F.col("id").isNull(), "no_id").when(~F.col("_scalar"), "bad_id")
    )
    return keyed.withColumn("reason", reason).drop("_listed", "_whole", "_scalar")


def json_cells(records: DataFrame) -> DataFrame:
    """One cell per JSON record: the raw line, keyed by its id.

    Columns beyond ``value`` and ``id`` are kept, to order puts of the same key.
    """
    others = [name for name in records.columns if name not in ("value", "id", "reason")]
    return records.select(
        F.col("id").alias("rowkey"),
        F.lit(JSON_FAMILY).alias("family"),
        F.lit(JSON_QUALIFIER).alias("qualifier"),
        "value",
        *others,
    )
