"""A corpus from raw documents to mixed, tokenised training text.

Each stage works on what the one before kept and gives back the columns of
``documents``; the last gives the token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockfee.llm import bpe, jaccard, line_dedup, mixing, quality
from blockfee.llm.queries import quality_weights
from blockfee.llm.shared import send_package, stored

#: Words, steps and pairs of tokens that a worker keeps: the heaps that earlier stages grew leave less room.
KEPT = 60_000

#: Rows that go to a Python worker at once, in place of Spark's 10,000: whole documents, some of them very long.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _prepare(spark: SparkSession) -> None:
    """The package where the tasks run, and smaller batches unless the session has its own size."""
    send_package(spark)
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes; it learns from the labels of those still there."""
    _prepare(spark)
    return quality.kept(docs, quality_weights(spark, docs, sf_dir), threshold=0.3)


def no_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a later document has too."""
    _prepare(spark)
    return line_dedup.without_repeated_lines(docs)


def _keyed(docs: DataFrame, name: str) -> DataFrame:
    """``row``, the columns of ``docs``, and ``row_key``, a number of each row's own; stored once, so that it stays."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_key"), F.struct(*docs.columns).alias("row"))
    return stored(rows, name)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that link with each other, directly or over others, the one with the smallest ``doc_id``.

    Rows are judged on their own, whatever ids they share. A null id counts as larger than
    any other; a row that is linked with nothing, with or without an id, stays. Of a group's
    rows with its smallest id, null or not, the one with the smallest hash stays.
    """
    _prepare(spark)
    keyed = _keyed(docs, "rows")
    groups = jaccard.components(keyed.select(F.col("row_key").alias("doc_id"), "row.text")).select(
        F.col("doc_id").alias("row_key"), "component_id"
    )
    order = F.struct(
        F.col("row.doc_id").isNull().alias("none"),
        F.col("row.doc_id").alias("doc_id"),
        F.xxhash64("row").alias("hash"),
        "row_key",
    )
    ranked = keyed.select("row_key", order.alias("order")).join(groups, "row_key")
    first = ranked.groupBy("component_id").agg(F.min("order")["row_key"].alias("row_key")).select("row_key")
    return keyed.join(first, "row_key", "left_semi").select("row.*")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each row as often as it takes that row, whatever ids rows share."""
    _prepare(spark)
    keyed = _keyed(docs, "rows")
    mix = mixing.mixed(keyed.select("row_key", "row.doc_id", "row.source", "row.text"), row_key="row_key")
    taken = mix.where("taken > 0").select("row_key", (F.col("taken") / F.col("size")).cast("int").alias("times"))
    repeated = keyed.join(taken, "row_key")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` of each document of the mix."""
    _prepare(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encoded(docs, ranks, public_tokenizers.PATTERN, kept=KEPT)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("line dedup", no_shared_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing to target weights", mixed_sources),
    ("byte-level BPE", token_ids),
]

#: SQL can express neither the classifier nor the merges.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
