"""Intermediate results in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SETTING = "spark.checkpoint.dir"


_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once for each application."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="llm-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _sent.add(app)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Only a local session, as in tests, may leave the setting out; it gets a folder of
    its own. On a cluster a missing setting is an error: executors would each write to
    a disk that the others do not see.
    """
    base = spark.conf.get(_SETTING, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set(_SETTING, base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(_nullable(df.schema)).parquet(path)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def running_totals(df: DataFrame, order: list[str], values: dict[str, str]) -> DataFrame:
    """``df`` with a column for each of ``values``, new name to summed column.

    A new column is the sum over all rows up to this one in the order of ``order``, which
    must tell rows apart unless they add nothing. Rows are dealt out by range, so a
    common value of the first columns is split by the next; each partition sums on its
    own and gets the totals of those before it. The dealt rows are stored once, so that
    both passes see the same partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "dealt")
    totals = dealt.groupBy("_part").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in values.items()])
    # A row for each partition: their number doesn't follow the number of rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_sum_{k}") for k in values]
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.select("*", *[F.sum(v).over(inside).alias(f"_in_{k}") for k, v in values.items()])
    return summed.join(F.broadcast(offsets), "_part").select(
        *df.columns, *[(F.col(f"_in_{k}") + F.col(f"_sum_{k}")).alias(k) for k in values]
    )
