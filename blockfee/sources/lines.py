"""Text sources: one record per line, in a single column ``value``.

The parsers only need that column, so any other source that yields it (for
example a message queue, with its payload cast to string) works as well.
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str], whole_file: bool = False) -> DataFrame:
    """Scan text files; ``whole_file`` makes each file one record."""
    return spark.read.text(path, wholetext=whole_file)


def stream_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream the lines of files as they arrive in a directory.

    Unlike a socket this source can be replayed, so a failed run loses nothing.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("value")


def lines_with(lines: DataFrame, text: str) -> DataFrame:
    """Lines that contain a piece of text."""
    return lines.where(F.contains("value", F.lit(text)))


def line_segments(lines: DataFrame, separator: str = ":") -> DataFrame:
    """One row per segment of each line, with its position."""
    parts = F.split("value", re.escape(separator))
    others = [F.col(name) for name in lines.columns if name != "value"]
    return lines.select(*others, F.posexplode(parts).alias("pos", "segment"))
