"""Token ids as Arrow files of equal-length sequences and masks.

A shard file is in the Arrow IPC file format: a stream of record batches and a footer
with their places, so any sequence is found and mapped without copying or reading the
rest. Columns are ``ids`` and ``mask``, fixed-size lists of one length; ids take 16 bits
where the vocabulary allows. The ids of a shard's documents stand one after another in
ascending order of ``doc_id``; only the last sequence is filled up, with the mask unset.
A second file beside it says where each document begins.

Shards are ranges of ``doc_id``. Each task writes under a name of its own, and only the
manifest, which Spark commits, says which files count: a task that is run again leaves
nothing that is read.

Defined cases: a null or empty text has only the end id; rows with equal ``doc_id`` stand
in the order of their texts; a null ``doc_id`` comes first; a text of any length is
encoded whole; an empty table gives an empty manifest and result.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cuts import KnownCuts
from .shared import shared_folder, stored
from .words import slices

#: Sequences in a record batch, and bytes of text that a task works on at once.
BATCH = 64
TEXT_SLICE = 8 << 20
_DOCUMENTS = pa.schema({"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64()})
MANIFEST = "shard long, folder string, name string, n_docs long, n_tokens long, n_sequences long"


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


class TokenFile:
    """A shard: sequences by number and documents by place."""

    def __init__(self, folder: str, name: str) -> None:
        fs, path = _file_system(folder)
        self.tokens = pa.ipc.open_file(self._open(fs, f"{path}/{name}.tokens.arrow"))
        self.documents = pa.ipc.open_file(self._open(fs, f"{path}/{name}.documents.arrow"))
        self.length = self.tokens.schema.field("ids").type.list_size

    @staticmethod
    def _open(fs: pafs.FileSystem, path: str):
        return pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of a sequence, views of the file."""
        batch = self.tokens.get_batch(i // BATCH)
        at = (i % BATCH) * self.length
        ids = batch.column("ids").flatten().to_numpy()
        return ids[at : at + self.length], batch.column("mask").flatten().slice(at, self.length)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """``n`` ids from place ``start`` of the shard on, a view for each record batch."""
        size = BATCH * self.length
        while n:
            at = start % size
            ids = self.tokens.get_batch(start // size).column("ids").flatten().to_numpy()[at : at + n]
            yield ids
            start, n = start + len(ids), n - len(ids)


class _Writer:
    """Packs ids into sequences as they come."""

    def __init__(self, folder: str, name: str, length: int, kind: pa.DataType) -> None:
        fs, path = _file_system(folder)
        fs.create_dir(path, recursive=True)
        self.length, self.kind, self.left = length, kind, np.zeros(0, kind.to_pandas_dtype())
        self.schema = pa.schema({"ids": pa.list_(kind, length), "mask": pa.list_(pa.bool_(), length)})
        self.out = fs.open_output_stream(f"{path}/{name}.tokens.arrow")
        self.tokens = pa.ipc.new_file(self.out, self.schema)
        self.out_documents = fs.open_output_stream(f"{path}/{name}.documents.arrow")
        self.documents = pa.ipc.new_file(self.out_documents, _DOCUMENTS)
        self.n_docs = self.n_tokens = self.n_sequences = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        """Documents with their ids, one after another, and how many each has."""
        starts = self.n_tokens + np.cumsum(counts) - counts
        self.documents.write_batch(
            pa.record_batch([doc_ids.cast(pa.int64()), pa.array(starts), pa.array(counts)], schema=_DOCUMENTS)
        )
        self.n_docs += len(counts)
        self.n_tokens += int(counts.sum())
        joined = np.concatenate([self.left, ids.astype(self.left.dtype)])
        size = BATCH * self.length
        whole = len(joined) - len(joined) % size
        for at in range(0, whole, size):
            self._write(joined[at : at + size], size)
        self.left = joined[whole:].copy()

    def _write(self, ids: np.ndarray, n: int) -> None:
        mask = np.arange(len(ids)) < n
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
        ]
        self.tokens.write_batch(pa.record_batch(columns, schema=self.schema))
        self.n_sequences += len(ids) // self.length

    def close(self) -> None:
        if len(self.left):
            filled = np.zeros(-(-len(self.left) // self.length) * self.length, self.left.dtype)
            filled[: len(self.left)] = self.left
            self._write(filled, len(self.left))
        for x in (self.tokens, self.out, self.documents, self.out_documents):
            x.close()


@cache
def _encoder(path: str) -> tuple[KnownCuts, int]:
    """An encoder and its number of ids, one for each Python worker."""
    # Tasks run side by side already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode_many(texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return KnownCuts(encode_many), tokenizer.get_vocab_size()


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int, length: int = 2048, folder: str | None = None
) -> DataFrame:
    """Write all documents' ids below ``folder``; returns the manifest, a row for each shard.

    ``tokenizer_path`` is a file of the tokenizers library with byte-level BPE, read where
    the tasks run. ``folder`` is any that pyarrow can write to, by default a new one in
    ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, n_ids = _encoder(tokenizer_path)
        kind = pa.uint16() if max(n_ids, end_id + 1) <= 1 << 16 else pa.uint32()
        writer = name = None
        for batch in batches:
            for part in slices(batch, size=TEXT_SLICE):
                if writer is None:
                    shard = TaskContext.get().partitionId()
                    name = f"{shard:06d}-{uuid.uuid4().hex}"
                    writer = _Writer(folder, name, length, kind)
                ids, counts = encoder.encode(part.column("text"))
                writer.add(part.column("doc_id"), np.insert(ids, np.cumsum(counts), end_id), counts + 1)
        if writer is not None:
            writer.close()
            row = [shard, folder, name, writer.n_docs, writer.n_tokens, writer.n_sequences]
            yield pa.record_batch([pa.array([x]) for x in row], names=MANIFEST.replace(",", "").split()[::2])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, "doc_id")
    return stored(ranges.sortWithinPartitions("doc_id", "text").mapInArrow(run, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32``, read from the files.

    ``ids_crc32`` is the checksum of the ids as little-endian 32-bit integers.
    """
    # A row for each shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    parts = manifest.agg(F.max("shard")).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["folder"], row["name"])
                for i in range(file.documents.num_record_batches):
                    docs = file.documents.get_batch(i)
                    sums = []
                    for start, n in zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist(), strict=True):
                        crc = 0
                        for ids in file.ids(start, n):
                            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    starts = docs.column("start").to_numpy() + row["before"]
                    yield pa.record_batch(
                        {
                            "doc_id": docs.column("doc_id"),
                            "start": pa.array(starts, pa.int64()),
                            "n_tokens": docs.column("n_tokens"),
                            "ids_crc32": pa.array(sums, pa.int64()),
                        }
                    )

    return placed.repartitionById((parts or 0) + 1, F.col("shard").cast("int")).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
