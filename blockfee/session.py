"""The Spark session of jobs."""

from pyspark.sql import SparkSession


def session(name: str = "blockfee", settings: dict[str, str] | None = None) -> SparkSession:
    """A session for a job, with the settings of spark-submit.

    Nothing is set here that would override those, above all no master.
    ``settings`` are for sessions started in another way.
    """
    builder = SparkSession.builder.appName(name)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
