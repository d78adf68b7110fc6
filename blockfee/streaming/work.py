"""Where intermediate files go."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession) -> str:
    """A new path in the shared folder of the cluster, ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="blockfee-")
    return f"{shared.rstrip('/')}/blockfee-{uuid.uuid4().hex}"
