"""Rows in one order across all partitions, without ever sorting them in one task.

Rows are dealt out by ranges of the order and stored once, so that every pass sees the
same partitions. What a partition needs to know of those before it, a count or a last
value, is one row for each partition, and goes over the driver.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockfee.streaming.work import work_dir


def dealt_by_range(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``_part``, stored; partitions follow each other in the order of their numbers.

    A running number is the last thing ordered by, so that many equal rows are shared out.
    """
    spark = rows.sparkSession
    numbered = rows.withColumn("_tie", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = numbered.repartitionByRange(parts, *order, "_tie").withColumn("_part", F.spark_partition_id())
    path = f"{work_dir(spark)}/dealt"
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def _carried(dealt: DataFrame, rows: list[tuple[int, int | None]]) -> DataFrame:
    """``dealt`` with ``_carried``, a number for each partition."""
    # A row for each partition: their number doesn't follow the number of rows.
    known = [F.struct(F.lit(p).alias("_part"), F.lit(c).cast("long").alias("_carried")) for p, c in rows]
    none = F.expr("CAST(array() AS array<struct<_part: int, _carried: bigint>>)")
    small = dealt.sparkSession.range(1).select(F.inline(F.array(*known) if known else none))
    return dealt.join(F.broadcast(small), "_part")


def numbered(rows: DataFrame, *order: str, name: str = "number") -> DataFrame:
    """``rows`` with their place in the order, from 0; places of equal rows are interchangeable."""
    dealt = dealt_by_range(rows, *order)
    counts = sorted((r["_part"], r["count"]) for r in dealt.groupBy("_part").count().collect())
    before, total = [], 0
    for part, count in counts:
        before.append((part, total))
        total += count
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_tie"))
    placed = _carried(dealt, before).withColumn(name, F.col("_carried") + inside - 1)
    return placed.select(*[c for c in rows.columns if c != name], name)


def with_previous(rows: DataFrame, column: str, first: int | None = None) -> DataFrame:
    """``rows`` with ``previous``, the value of ``column`` in the row before; ``first`` before all rows."""
    dealt = dealt_by_range(rows, column)
    lasts = sorted((r["_part"], r["last"]) for r in dealt.groupBy("_part").agg(F.max(column).alias("last")).collect())
    carried = [(part, first if i == 0 else lasts[i - 1][1]) for i, (part, _) in enumerate(lasts)]
    before = F.lag(column).over(Window.partitionBy("_part").orderBy(column, "_tie"))
    placed = _carried(dealt, carried).withColumn("previous", F.coalesce(before, "_carried"))
    return placed.select(*[c for c in rows.columns if c != "previous"], "previous")
