"""Values of generation transactions, and their lookup by transaction id."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockfee.functions import pack_id, unpack_id
from blockfee.schemas import COIN, TOTAL_COIN


def coinbase_values(transactions: DataFrame) -> DataFrame:
    """Reduce decoded transactions to ``first_value``, ``total_value``, ``n_outputs``."""
    zero = F.lit(0).cast(TOTAL_COIN)
    outputs = F.transform("vout", lambda output: output["value"].cast(TOTAL_COIN))
    return merge_copies(
        transactions.select(
            "txid",
            F.get("vout", 0)["value"].cast(COIN).alias("first_value"),
            F.aggregate(
                outputs, zero, lambda total, value: (total + value).cast(TOTAL_COIN)
            ).alias("total_value"),
            F.size("vout").alias("n_outputs"),
        )
    )


def merge_copies(values: DataFrame) -> DataFrame:
    """One row per transaction, so that the lookup below never multiplies blocks.

    A whole row: of the greatest ``put_id``, if there are any, then of the later
    writer. ``ambiguous`` says that copies put together differ. Copies merge before the
    shuffle, however many there are.
    """
    columns = ("first_value", "total_value", "n_outputs")
    put_id = F.col("put_id") if "put_id" in values.columns else F.lit(0).cast("bigint")
    put_by = F.col("put_by") if "put_by" in values.columns else F.lit("")
    known = F.col("ambiguous") if "ambiguous" in values.columns else F.lit(False)
    row = F.struct(*columns, known.alias("ambiguous"))
    # The grouping has one column more than the lookup key. The lookup then
    # shuffles both sides anew, the shape in which adaptive execution can split
    # a hot txid; the extra shuffle carries one short row per transaction, its id
    # packed, and a number that is the same for nearly all.
    merged = (
        values.where(F.col("txid").isNotNull())
        .withColumn("_id", pack_id(F.col("txid")))
        .groupBy("_id", F.octet_length("_id").alias("_spread"))
        .agg(
            F.max(F.struct(put_id.alias("put_id"), put_by.alias("put_by"), row.alias("row"))).alias("_last"),
            # The other end of the same put: of its rows the least.
            F.min(F.struct((-put_id).alias("put_id"), row.alias("row"))).alias("_first"),
        )
    )
    return merged.select(
        unpack_id(F.col("_id")).alias("txid"),
        *[F.col(f"_last.row.{name}").alias(name) for name in columns],
        ((F.col("_last.row") != F.col("_first.row")) | F.col("_last.row.ambiguous")).alias("ambiguous"),
    )


def output_values(
    outputs: DataFrame, key: str, order: list[str], value: str = "value"
) -> DataFrame:
    """The same three values from a flat table with one row per output.

    The first output is the least by ``order``, then by value. Everything
    aggregates before the shuffle with constant state per key.
    """
    if len(order) == 1:
        # Fixed-width buffers keep this a hash aggregation.
        first = F.min_by(value, order[0])
    else:
        first = F.min(F.struct(*order, F.col(value).alias("_first")))["_first"]
    return outputs.groupBy(key).agg(
        first.cast(COIN).alias("first_value"),
        F.sum(value).cast(TOTAL_COIN).alias("total_value"),
        F.count(F.lit(1)).cast("int").alias("n_outputs"),
    )


def attach_coinbase(references: DataFrame, coinbase: DataFrame) -> DataFrame:
    """Look up each block's generation transaction; unknown and ambiguous ids are left out.

    ``coinbase`` has one row per ``txid``. No side is forced to broadcast. Ids are
    shuffled packed.
    """
    if "ambiguous" in coinbase.columns:
        coinbase = coinbase.where(~F.col("ambiguous")).drop("ambiguous")
    found = _packed(references).join(_packed(coinbase), "_key", "inner")
    return found.select(unpack_id(F.col("_key")).alias("txid"), "*").drop("_key")


def _packed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_key``, the packed id, in place of ``txid``."""
    return rows.withColumn("_key", pack_id(F.col("txid"))).drop("txid")


def look_up_coinbase(parsed: DataFrame, coinbase: DataFrame) -> DataFrame:
    """The same lookup that keeps every row and gives unknown ids a reason.

    Rows refused before get a join key of their own that matches nothing, so a
    mass of them does not pile up in one task. It is shorter than any packed id.
    """
    usable = F.col("reason").isNull()
    alone = F.monotonically_increasing_id().cast("string").cast("binary")
    keyed = parsed.withColumn("_key", F.when(usable, pack_id(F.col("txid"))).otherwise(alone))
    # The key says what the id of a usable row is.
    keyed = keyed.withColumn("txid", F.when(~usable, F.col("txid")))
    found = keyed.join(_packed(coinbase), "_key", "left")
    found = found.withColumn("txid", F.when(usable, unpack_id(F.col("_key"))).otherwise(F.col("txid"))).drop("_key")
    bad = F.when(F.col("n_outputs").isNull(), "missing_transaction")
    if "ambiguous" in found.columns:
        bad = bad.when(F.col("ambiguous"), "ambiguous_transaction")
    return found.withColumn("reason", F.coalesce("reason", bad)).drop("ambiguous")
