"""Small files and listings, in whatever file system a table is in."""

import re
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def matching(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths below ``folder`` that match a glob pattern, relative to it."""
    base = re.sub(r"([\\{}\[\]*?])", r"\\\1", folder.rstrip("/"))
    system, where = _open(spark, f"{base}/{pattern}")
    depth = pattern.count("/") + 1
    statuses = system.globStatus(where) or []
    return ["/".join(status.getPath().toString().split("/")[-depth:]) for status in statuses]


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file, or None if there is none."""
    system, where = _open(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that isn't there yet, whole or not at all; whether that was so."""
    system, where = _open(spark, path)
    if system.exists(where):
        return False
    folder, name = path.rsplit("/", 1)
    _, draft = _open(spark, f"{folder}/.{uuid.uuid4().hex}-{name}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    # Of two that come this far, a file system that can refuse lets one through.
    done = system.rename(draft, where)
    if not done:
        system.delete(draft, False)
    return done


def remove(spark: SparkSession, path: str) -> None:
    """Remove a directory with all that is in it."""
    system, where = _open(spark, path)
    system.delete(where, True)
