"""Heights to work on."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def height_range(spark: SparkSession, start: int, stop: int) -> DataFrame:
    """Heights ``start`` up to, not including, ``stop``."""
    return spark.range(start, stop).select(F.col("id").alias("height"))
