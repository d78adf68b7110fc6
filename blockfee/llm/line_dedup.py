"""Line dedup: lines that many documents share stay only in the last of these documents.

Three passes. Distinct line hashes are counted; those in enough documents go into
shards, each a minimal perfect hash with arrays for fingerprint, count and last
document (``line_index``). The documents' line hashes, 24 bytes each and without any
text, are sent to the shards and probe the arrays; lines are never joined with lines.
What is to be dropped goes back to the documents by their id and a hash of their text.

A shard has at most about ``SHARD_LINES`` lines. A shard that a very common line makes
hot is copied to as many tasks as its share of the probes asks for.

Defined cases: a null or empty text is one empty line, and null becomes an empty text;
rows that share a ``doc_id`` count as one document, and if it is the largest all keep the
line; each row without an id counts as a document of its own, smaller than any other; a text
of any length is read whole; an empty table gives an empty result. All columns are kept
whatever their names; ``counts`` replace columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .line_index import LineIndex
from .shared import stored
from .words import mixed, slices

SHARD_LINES = 1 << 18
_SPACE = b" \t\n\x0b\x0c\r"
#: Stands for a null doc_id.
_NO_ID = -(2**63)


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line stripped and in lower case (ASCII only), or None if it is too short to count."""
    key = line.strip(_SPACE)
    if len(key) < min_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key.lower()


def _hashes(text: str | None, min_chars: int) -> list[tuple[int, int] | None]:
    """128 bits for each line, None for short ones."""
    out = []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        key = line_key(line, min_chars)
        out.append(None if key is None else divmod(xxhash.xxh3_128_intdigest(key), 1 << 64))
    return out


def _line_hashes(part: pa.RecordBatch, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, key of the row, high and low half of each distinct line of each row."""
    docs, keys, pairs = [], [], []
    columns = [part.column(name).to_pylist() for name in ("doc_id", "key", "text")]
    for doc_id, key, text in zip(*columns, strict=True):
        lines = {x for x in _hashes(text, min_chars) if x}
        pairs += lines
        docs += [_NO_ID if doc_id is None else doc_id] * len(lines)
        keys += [key] * len(lines)
    halves = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
    return np.array(docs, np.int64), np.array(keys, np.int64), halves[:, 0], halves[:, 1]


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``key``, which tells rows with one id, or none, but different texts apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key"))


def _ids_repeat(docs: DataFrame) -> bool:
    ids = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count()
    return not ids.where("count > 1").isEmpty()


def _shard(high: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(high.view(np.uint64)) % np.uint64(shards)).astype(np.int64)


def repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Hash (``high``, ``low``), ``n`` documents and ``last`` document of each line in ``min_docs`` documents or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, _, high, low = _line_hashes(part, min_chars)
                yield pa.record_batch({"doc": doc, "high": high, "low": low})

    lines = _keyed(docs).mapInArrow(run, "doc long, high long, low long")
    if _ids_repeat(docs):
        # Rows of one id are one document; a row without an id is a document of its own.
        alone = F.when(F.col("doc") == _NO_ID, F.monotonically_increasing_id())
        lines = lines.withColumn("alone", alone).distinct().drop("alone")
    counted = lines.groupBy("high", "low").agg(F.count("*").alias("n"), F.max("doc").alias("last"))
    return counted.where(F.col("n") >= min_docs)


def _indexed(repeated: DataFrame, shards: int) -> DataFrame:
    """``shard``, its ``index`` and the number of ``probes`` that will hit it."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        high, low = rows["high"].to_numpy(np.int64), rows["low"].to_numpy(np.int64)
        index = LineIndex.build(
            high.view(np.uint64), low.view(np.uint64), rows["n"].to_numpy(np.int64), rows["last"].to_numpy(np.int64)
        )
        return pd.DataFrame(
            {"shard": [rows["shard"].iloc[0]], "index": [index.to_bytes()], "probes": [int(rows["n"].sum())]}
        )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("shard", pa.array(_shard(batch.column("high").to_numpy(), shards)))

    return (
        repeated.mapInArrow(numbered, "high long, low long, n long, last long, shard long")
        .groupBy("shard")
        .applyInPandas(build, "shard long, index binary, probes long")
    )


def dropped_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc``, ``key`` of its text, and ``high`` of each line that goes; the id of a document without one is the least long."""
    spark = docs.sparkSession
    repeated = stored(repeated_lines(docs, min_chars, min_docs), "repeated-lines")
    shards = max(1, -(-repeated.count() // SHARD_LINES))
    indexes = stored(_indexed(repeated, shards), "line-index")

    # A row for each shard, not for each line.
    stats = indexes.select("shard", "probes").toPandas()
    share = np.full(shards, 1 / shards)
    np.maximum.at(share, stats["shard"].to_numpy(np.int64), (stats["probes"] / max(1, stats["probes"].sum())).to_numpy())
    copies = np.ceil(share * int(spark.conf.get("spark.sql.shuffle.partitions"))).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(copies)))
    slots = int(first[-1])
    sent = spark.sparkContext.broadcast((first, copies))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, count = sent.value
        for batch in batches:
            for part in slices(batch):
                doc, key, high, low = _line_hashes(part, min_chars)
                shard = _shard(high, shards)
                salt = (mixed((doc ^ key).view(np.uint64)) % count[shard].astype(np.uint64)).astype(np.int64)
                none = pa.nulls(len(doc), pa.binary())
                columns = {"slot": start[shard] + salt, "doc": doc, "key": key, "high": high, "low": low}
                yield pa.record_batch({**columns, "index": none})

    places = spark.createDataFrame(
        pd.DataFrame({"shard": np.arange(shards), "start": first[:-1], "copies": copies}),
        "shard long, start long, copies long",
    )
    nothing = F.lit(0).cast("long")
    copied = indexes.join(places, "shard").select(
        F.explode(F.sequence("start", F.expr("start + copies - 1"))).alias("slot"),
        nothing.alias("doc"),
        nothing.alias("key"),
        nothing.alias("high"),
        nothing.alias("low"),
        "index",
    )
    asked = _keyed(docs).mapInArrow(probes, "slot long, doc long, key long, high long, low long, index binary")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            column = batch.column("index")
            known = len(batch) - column.null_count
            if known:
                index = LineIndex.from_bytes(column[0].as_py())
                batch = batch.slice(known)
            if index is None or not len(batch):
                continue
            doc, key, high, low = (batch.column(k).to_numpy() for k in ("doc", "key", "high", "low"))
            number = index.find(high, low)
            gone = number >= 0
            gone[gone] = (index.counts[number[gone]] >= min_docs) & (index.last[number[gone]] != doc[gone])
            yield pa.record_batch({"doc": doc[gone], "key": key[gone], "high": high[gone]})

    return (
        copied.unionByName(asked)
        .repartitionById(slots, F.col("slot").cast("int"))
        .sortWithinPartitions(F.col("index").isNull())
        .mapInArrow(answer, "doc long, key long, high long")
    )


def without_repeated_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, counts: tuple[str, str] | None = None
) -> DataFrame:
    """``docs`` with shared lines dropped from ``text``, all columns kept.

    ``counts`` names two columns to add: lines before, and lines dropped.
    """
    gone = (
        dropped_lines(docs, min_chars, min_docs)
        .groupBy("doc", "key")
        .agg(F.collect_set("high").alias("high"))  # of one text's lines, however many rows have it
    )
    columns = docs.columns
    own: Column = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    # Columns of docs travel in a struct, so that none can clash.
    keyed = docs.select(own.alias("doc"), F.xxhash64("text").alias("key"), F.struct(*columns).alias("row"))
    joined = keyed.join(gone, ["doc", "key"], "left")
    flat = joined.select(
        *[F.col(f"row.{c}").alias(f"c{i}") for i, c in enumerate(columns)], F.col("high").alias("gone")
    )
    at = columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, lost = [], [], []
            for text, gone in zip(batch.column(at).to_pylist(), batch.column("gone").to_pylist(), strict=True):
                lines = (text or "").split("\n")
                if gone:
                    known = {x % (1 << 64) for x in gone}
                    stays = [
                        line
                        for line, h in zip(lines, _hashes(text, min_chars), strict=True)
                        if h is None or h[0] not in known
                    ]
                else:
                    stays = lines
                texts.append("\n".join(stays))
                before.append(len(lines))
                lost.append(len(lines) - len(stays))
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[at] = pa.array(texts, arrays[at].type)
            arrays += [pa.array(before, pa.int64()), pa.array(lost, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])

    out = ", ".join(
        [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)]
        + [f"c{len(columns)} long", f"c{len(columns) + 1} long"]
    )
    cleaned = flat.mapInArrow(cut, out)
    names = [*columns, *(counts or ())]
    return cleaned.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if i >= len(columns) or c not in (counts or ())]
    )
