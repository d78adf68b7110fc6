"""Which heights are done and which are still to load."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockfee.operators.ordered import with_previous


def pending_heights(wanted: DataFrame, loaded: DataFrame) -> DataFrame:
    """Wanted heights that have not been loaded.

    Repeated loads of a height merge before the shuffle.
    """
    done = loaded.select("height").distinct()
    return wanted.select("height").join(done, "height", "left_anti")


def pending_ranges(loaded: DataFrame, start: int, stop: int) -> DataFrame:
    """The heights from ``start`` up to, not including, ``stop`` that have not been loaded, as ranges.

    A row (first, last) for each gap, so that what is nearly complete, or nearly empty,
    takes few rows. Nulls and heights beyond the range don't matter.
    """
    inside = loaded.select("height").where((F.col("height") >= start) & (F.col("height") < stop)).distinct()
    # The first height beyond stands for the end.
    end = loaded.sparkSession.range(stop, stop + 1).withColumnRenamed("id", "height")
    steps = with_previous(inside.unionByName(end), "height", start - 1)
    gaps = steps.where(F.col("height") - F.col("previous") > 1)
    return gaps.select((F.col("previous") + 1).alias("first"), (F.col("height") - 1).alias("last"))


def progress_marker(fees: DataFrame) -> DataFrame:
    """One row with the highest block processed; null if there is none."""
    return fees.agg(F.max("height").alias("last_block_processed"))


def contiguous_marker(loaded: DataFrame, start: int | None = None) -> DataFrame:
    """One row with the last block before the first gap, so that nothing below it is missing.

    Counting from ``start``, or else from the lowest height; null if there is nothing there.
    """
    heights = loaded.select("height").where(F.col("height").isNotNull()).distinct()
    if start is not None:
        heights = heights.where(F.col("height") >= start)
    steps = with_previous(heights, "height", None if start is None else start - 1)
    gap = F.col("height") - F.col("previous") > 1
    ends = steps.agg(F.min(F.when(gap, F.col("previous"))).alias("before_gap"), F.max("height").alias("last"))
    marker = F.coalesce("before_gap", "last")
    # Before the start there is nothing that could have been processed.
    if start is not None:
        marker = F.when(marker >= start, marker)
    return ends.select(marker.alias("last_block_processed"))


def heights_after(blocks: DataFrame, progress: DataFrame) -> DataFrame:
    """Blocks above the progress marker; all of them while there is no marker.

    The marker enters as a scalar subquery, so it filters the scan directly.
    """
    last = F.coalesce(progress.select("last_block_processed").scalar(), F.lit(-1))
    return blocks.where(F.col("height") > last)
