"""A table of generation transactions that can be read in parts.

A stream looks up few ids per micro-batch. The table is therefore kept reduced
to one short row per transaction, and partitioned by the first digits of the id.
How many digits is noted with the table.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockfee.operators import merge_copies
from blockfee.sinks.tables import compact, note_once, put_batch, read_note, read_table

DIGITS = 2
#: Readers ask for partitions by name; there are 16 ** MOST_DIGITS at most.
MOST_DIGITS = 3
#: Bits by which a reader tells most of the rows that nobody asks for.
MOST_BITS = 1 << 27


def _prefix(txid: str, digits: int) -> Column:
    # The letter keeps partition values from being read as numbers.
    return F.concat(F.lit("x"), F.substring(txid, 1, digits))


def put_coinbase(
    values: DataFrame,
    path: str,
    batch_id: int,
    digits: int = DIGITS,
    writer: str = "batch",
    read_from: str | None = None,
) -> None:
    """Add one batch of transactions, reduced by ``coinbase_values``.

    More ``digits`` make smaller partitions: 16 with one, 256 with two. All
    batches of a table have the same number.
    """
    if not 1 <= digits <= MOST_DIGITS:
        raise ValueError(f"digits must be 1 to {MOST_DIGITS}")
    note_once(values.sparkSession, path, "digits", str(digits))
    rows = values.withColumn("prefix", _prefix("txid", digits))
    if "ambiguous" not in rows.columns:
        rows = rows.withColumn("ambiguous", F.lit(False))
    put_batch(rows, path, batch_id, ["prefix"], writer, read_from)


def _perhaps_among(table: DataFrame, wanted: DataFrame, count: int) -> DataFrame:
    """The rows of ``table`` whose id is among the ``count`` ids of ``wanted``, and a tenth of the others.

    So what is shuffled for a batch is as much as the batch needs, however large the table
    is. Each id sets a bit by its hash; the bits are broadcast, at most 16 MB of them.
    """
    bits = min(MOST_BITS, 8 << max(12, count.bit_length()))
    number = F.pmod(F.xxhash64("txid"), F.lit(bits))
    maps = (
        wanted.select(number.alias("_number"))
        .groupBy(F.bitmap_bucket_number("_number").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("_bits"))
    )
    place = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    set_there = F.getbit(byte, (place % 8).cast("int")) == 1
    return table.join(F.broadcast(maps), (F.bitmap_bucket_number(number) == F.col("_bucket")) & set_there, "left_semi")


def coinbase_reader(spark: SparkSession, path: str) -> Callable[[DataFrame], DataFrame]:
    """Read those partitions of the table that parsed lines ask for, and of their rows few others than those."""
    digits = int(read_note(spark, path, "digits") or DIGITS)

    def read(parsed: DataFrame) -> DataFrame:
        usable = parsed.where(F.col("reason").isNull())
        # Hexadecimal digits: never more values than the table has partitions.
        wanted = usable.groupBy(_prefix("txid", digits).alias("prefix")).agg(F.count(F.lit(1)).alias("ids")).collect()
        table = read_table(spark, path).where(F.col("prefix").isin([r.prefix for r in wanted]))
        return merge_copies(_perhaps_among(table, usable, sum(r.ids for r in wanted)))

    return read


def compact_coinbase(spark: SparkSession, path: str, open_batches: int = 0) -> None:
    """Compaction with the keys of this table; copies of a batch that differ both stay."""
    values = ["first_value", "total_value", "n_outputs", "ambiguous"]
    compact(spark, path, ["txid", "prefix", *values], ["put_id", "put_by"], ["prefix"], open_batches)
