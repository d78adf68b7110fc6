"""A keyed table as a log of batches.

Every put writes a directory of its own, ``writer=<name>/batch=<n>/rev=<r>``. Writing a batch
of a writer again adds its next revision, which replaces the ones before it as soon as it is
whole; a replayed batch so changes nothing, and no reader meets half of one. Rows carry
``put_id`` and ``put_by``, the number and writer of their batch. Reading takes the newest
put per key: the greater number, then the greater ``seq``, then the later writer by name.

Compaction writes the newest puts of all batches it finds as one snapshot, and then a note
that lists exactly the batches and revisions in it, as ranges. Readers take the snapshot and
every batch it doesn't hold, whatever its number: one that came late with a lower number
is read like any other. A batch that is put again after it went into a snapshot reopens it:
readers pass over each snapshot that holds an older revision, to the one before or to the
batches themselves. ``remove_replaced`` gives their space back and closes them for good: a
put into a closed number is refused.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockfee.schemas import CELL_KEY
from blockfee.sinks.files import create_text, matching, read_text, remove

#: Writer name of snapshots; no other writer may have it.
SNAPSHOT = "~snapshot"
NOTES = "_notes"

#: A batch of a writer.
Batch = tuple[str, int]


def read_note(spark: SparkSession, path: str, name: str) -> str | None:
    """What was noted beside a table, or None."""
    return read_text(spark, f"{path}/{NOTES}/{name}")


def note_once(spark: SparkSession, path: str, name: str, text: str) -> None:
    """Note something that must never be another; fails if it is."""
    if not create_text(spark, f"{path}/{NOTES}/{name}", text):
        known = read_note(spark, path, name)
        if known != text:
            raise ValueError(f"{path}: {name} is {known!r}, not {text!r}")


def _ranges(batches: dict[Batch, int]) -> dict[str, list[list[int]]]:
    """Batches and their revisions as [first, last, revision] of each writer."""
    ranges: dict[str, list[list[int]]] = defaultdict(list)
    for (writer, number), rev in sorted(batches.items()):
        own = ranges[writer]
        if own and own[-1][1] == number - 1 and own[-1][2] == rev:
            own[-1][1] = number
        else:
            own.append([number, number, rev])
    return dict(ranges)


def _held(ranges: dict[str, list[list[int]]], batch: Batch) -> int | None:
    """The revision of a batch in a snapshot, or None."""
    writer, number = batch
    return next((rev for first, last, rev in ranges.get(writer, []) if first <= number <= last), None)


@dataclass
class Log:
    """What is in a table: the newest whole revision of each batch, snapshots, and what they hold."""

    path: str
    revisions: dict[Batch, int] = field(default_factory=dict)
    older: list[tuple[str, int, int]] = field(default_factory=list)
    #: Of each snapshot that is there, what it holds; and the greatest number ever noted.
    snapshots: dict[int, dict[str, list[list[int]]]] = field(default_factory=dict)
    noted: int = -1
    #: The snapshot whose batches are closed for good.
    sealed: int = -1

    def directory(self, batch: Batch, rev: int) -> str:
        return f"{self.path}/writer={batch[0]}/batch={batch[1]}/rev={rev}"

    def valid(self, version: int) -> bool:
        """Whether no batch in a snapshot was put again."""
        if version == self.sealed:
            return True
        held = self.snapshots[version]
        return all(_held(held, batch) in (None, rev) for batch, rev in self.revisions.items())

    def current(self) -> int:
        """The latest snapshot that counts, or -1."""
        return next((v for v in sorted(self.snapshots, reverse=True) if self.valid(v)), -1)

    def closed(self, batch: Batch) -> bool:
        return self.sealed in self.snapshots and _held(self.snapshots[self.sealed], batch) is not None

    def directories(self) -> list[str]:
        """What a reader reads."""
        version = self.current()
        held = self.snapshots.get(version, {})
        found = [self.directory((SNAPSHOT, version), 0)] if version >= 0 else []
        return found + [self.directory(b, r) for b, r in sorted(self.revisions.items()) if _held(held, b) is None]


def read_log(spark: SparkSession, path: str) -> Log:
    """One listing, and a small file for each snapshot that is looked at."""
    path = path.rstrip("/")
    log = Log(path)
    whole: set[int] = set()
    for found in matching(spark, path, "writer=*/batch=*/rev=*/_SUCCESS"):
        writer, number, rev = re.fullmatch(r"writer=(.*)/batch=(-?\d+)/rev=(\d+)/_SUCCESS", found).groups()
        batch, rev = (writer, int(number)), int(rev)
        if writer == SNAPSHOT:
            whole.add(batch[1])
            continue
        known = log.revisions.get(batch)
        if known is not None:
            log.older.append((*batch, min(known, rev)))
        log.revisions[batch] = max(rev, -1 if known is None else known)
    names = [name.split("/")[-1] for name in matching(spark, path, f"{NOTES}/s*-*")]
    numbers = {kind: [int(n.split("-")[1]) for n in names if re.fullmatch(rf"{kind}-\d+", n)] for kind in ("snapshot", "sealed")}
    log.noted = max(numbers["snapshot"], default=-1)
    log.sealed = max(numbers["sealed"], default=-1)
    for version in sorted(whole & set(numbers["snapshot"]), reverse=True):
        log.snapshots[version] = json.loads(read_note(spark, path, f"snapshot-{version}"))
        if version <= log.sealed:
            break
    return log


def put_batch(
    rows: DataFrame,
    path: str,
    batch_id: int,
    partition_by: Sequence[str] = (),
    writer: str = "batch",
    read_from: str | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """Write one batch of puts.

    With ``partition_by``, rows are rebalanced on those columns: adaptive
    execution then splits a value that holds most rows and joins small ones. ``sort_by``
    orders the rows of each file, so that readers can skip parts of it.
    ``read_from`` says what the batch was made from; the same number with another
    input is refused instead of replacing what was put.
    """
    if writer == SNAPSHOT or "/" in writer:
        raise ValueError(f"no name for a writer: {writer!r}")
    spark, batch = rows.sparkSession, (writer, int(batch_id))
    if read_from is not None:
        note_once(spark, path, f"input-{writer}-{batch_id}", read_from)
    puts = rows.withColumns(
        {"put_id": F.lit(batch_id).cast("bigint"), "put_by": F.lit(writer)}
    )
    _note_schema(spark, path, puts.schema)
    note_once(spark, path, "partitions", json.dumps([*partition_by]))
    note_once(spark, path, "order", json.dumps([*sort_by]))
    log = read_log(spark, path)
    _refuse_closed(log, batch)
    # What an interrupted put left under this number isn't whole, so it may go.
    target = log.directory(batch, log.revisions.get(batch, -1) + 1)
    _write(puts, target, partition_by, "overwrite", sort_by)
    _refuse_closed(read_log(spark, path), batch)


def _refuse_closed(log: Log, batch: Batch) -> None:
    if log.closed(batch):
        raise ValueError(f"{log.path}: batch {batch[1]} of {batch[0]!r} is closed; give what corrects it a new number")


def _write(rows: DataFrame, path: str, partition_by: Sequence[str], mode: str, sort_by: Sequence[str] = ()) -> None:
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    # Hexadecimal digits, most of what is kept, take half the space this way.
    writer = rows.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _note_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Note the columns of a put, so that a table of empty batches can be read, and one whose columns grew."""
    columns = T.StructType([T.StructField(f.name, f.dataType, True) for f in sorted(schema, key=lambda f: f.name)])
    _together(path, [columns, *_schemas(spark, path)])
    text = columns.json()
    note_once(spark, path, f"columns-{zlib.crc32(text.encode()):08x}", text)


def _schemas(spark: SparkSession, path: str) -> list[T.StructType]:
    names = sorted(matching(spark, path, f"{NOTES}/columns-*"))
    return [T.StructType.fromJson(json.loads(read_text(spark, f"{path}/{name}"))) for name in names]


def _together(path: str, schemas: list[T.StructType]) -> T.StructType:
    """Every column of the schemas; a column can't be of two types."""
    fields: dict[str, T.StructField] = {}
    for column in (c for schema in schemas for c in schema):
        known = fields.setdefault(column.name, column)
        if known.dataType.simpleString() != column.dataType.simpleString():
            raise ValueError(f"{path}: {column.name} is {known.dataType.simpleString()}, not {column.dataType.simpleString()}")
    return T.StructType(list(fields.values()))


def read_directories(spark: SparkSession, path: str, directories: Sequence[str]) -> DataFrame:
    """The rows of some batches or snapshots of a table."""
    reader = spark.read
    if schemas := _schemas(spark, path):
        reader = reader.schema(_together(path, schemas))
    if not directories:
        return reader.parquet(path) if not schemas else spark.createDataFrame([], _together(path, schemas))
    return reader.option("basePath", path).parquet(*directories).drop("writer", "batch", "rev")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All puts that the latest snapshot doesn't hold, and the newest ones in it."""
    return read_directories(spark, path, read_log(spark, path).directories())


def cell_keys(puts: DataFrame) -> list[str]:
    """What tells cells apart; results of different sources are different cells."""
    return [name for name in (*CELL_KEY, "source") if name in puts.columns]


def latest_by_key(
    puts: DataFrame,
    keys: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """The newest put per key by ``order``, ties going to the greatest row.

    By default the later batch wins, within a batch the greater ``seq``, if the
    table has that column, and then the writer whose name comes later. An
    aggregation with one row of state per key, combined before the shuffle, so a key
    that was put very often costs no more than any other.
    """
    keys = list(keys or cell_keys(puts))
    if order is None:
        order = [name for name in ("put_id", "seq", "put_by") if name in puts.columns]
    others = [name for name in puts.columns if name not in keys and name not in order]
    newest = puts.groupBy(*keys).agg(F.max(F.struct(*order, *others)).alias("_newest"))
    return newest.select(*keys, *[F.col("_newest")[name].alias(name) for name in (*others, *order)])


def compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
    open_batches: int = 0,
) -> None:
    """Write the newest put per key as the next snapshot, which readers then use.

    Reads the last snapshot that counts and what it doesn't hold. The newest
    ``open_batches`` batches of each writer stay outside, where a stream may still replay
    them. What a snapshot replaces stays where it is until ``remove_replaced``. It is
    partitioned and sorted as the table is.
    """
    known = json.loads(read_note(spark, path, "partitions") or "[]")
    if partition_by is not None and [*partition_by] != known:
        raise ValueError(f"{path} is partitioned by {known}, not {[*partition_by]}")
    order_in_files = json.loads(read_note(spark, path, "order") or "[]")
    log = read_log(spark, path)
    newest = _newest(log, open_batches)
    version = log.current()
    held = log.snapshots.get(version, {})
    if any(_held(held, batch) is not None for batch in newest):
        # What is to stay outside is in that snapshot: begin at one that doesn't hold it.
        fitting = [v for v in log.snapshots if log.valid(v) and all(_held(log.snapshots[v], b) is None for b in newest)]
        version = max(fitting, default=-1)
        held = log.snapshots.get(version, {})
    taken = {b: r for b, r in log.revisions.items() if _held(held, b) is None and b not in newest}
    directories = [log.directory((SNAPSHOT, version), 0)] if version >= 0 else []
    directories += [log.directory(b, r) for b, r in sorted(taken.items())]
    rows = read_directories(spark, path, directories)
    number = log.noted + 1
    # What an interrupted compaction left is not noted, so it may go.
    target = log.directory((SNAPSHOT, number), 0)
    _write(latest_by_key(rows, keys, order), target, known, "overwrite", order_in_files)
    everything = {**_batches(held), **taken}
    note_once(spark, path, f"snapshot-{number}", json.dumps(_ranges(everything), sort_keys=True))


def _batches(ranges: dict[str, list[list[int]]]) -> dict[Batch, int]:
    return {
        (writer, number): rev for writer, own in ranges.items() for first, last, rev in own for number in range(first, last + 1)
    }


def _newest(log: Log, count: int) -> set[Batch]:
    """The ``count`` newest batches of each writer."""
    numbers: dict[str, list[int]] = defaultdict(list)
    for writer, number in log.revisions:
        numbers[writer].append(number)
    return {(w, n) for w, own in numbers.items() for n in sorted(own, reverse=True)[:count]} if count else set()


def replaced(spark: SparkSession, path: str) -> list[str]:
    """Directories of batches and snapshots that readers don't look at any more."""
    log = read_log(spark, path)
    version = log.current()
    if version < 0:
        return []
    held = log.snapshots[version]
    batches = {b for b in log.revisions if _held(held, b) is not None} | {(SNAPSHOT, v) for v in log.snapshots if v != version}
    return sorted(f"{log.path}/writer={writer}/batch={number}" for writer, number in batches)


def remove_replaced(spark: SparkSession, path: str) -> list[str]:
    """Remove what a snapshot replaces, close its batches for good, and return the directories.

    The snapshot is the latest that counts and doesn't hold the newest batch of any writer,
    which a stream may put again after a failure; ``compact(..., open_batches=1)`` leaves
    those outside. Older revisions go too. No reader that began before may still be running.
    """
    log = read_log(spark, path)
    newest = _newest(log, 1)
    bases = [v for v, held in log.snapshots.items() if log.valid(v) and all(_held(held, b) is None for b in newest)]
    base = max(bases, default=-1)
    gone = [log.directory((writer, number), rev) for writer, number, rev in log.older]
    if base >= 0:
        # From here on its batches are closed, also where removing them is interrupted.
        if base != log.sealed:
            note_once(spark, path, f"sealed-{base}", "")
        held = log.snapshots[base]
        gone += [f"{log.path}/writer={w}/batch={n}" for w, n in log.revisions if _held(held, (w, n)) is not None]
        gone += [f"{log.path}/writer={SNAPSHOT}/batch={v}" for v in log.snapshots if v < base]
    for directory in gone:
        remove(spark, directory)
    return sorted(gone)
