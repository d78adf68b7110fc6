"""N-gram Jaccard join, exact: documents whose sets of word shingles are alike, as groups.

Size-aware, heavy and light. Copies of a set are one class first. Light classes (few
shingles) enumerate subsets: two sets of sizes n and m link exactly if they share a
subset of as many shingles as their sizes ask for, so whoever holds the same subset is
linked without any comparing. Heavy classes scan inverted lists of their rarest
shingles; whoever meets in a list is a candidate. Up to which size a set is light is
chosen by the cost of both ways.

Near copies of one text would meet in every list, all pairs of them. So sets that share
a min-hash band are first compared with a leader, those that it leaves apart with a few
more, and what turns out linked is one group. Lists then give only pairs from different
groups, which no link is lost by: a link inside a group would join nothing. Nor does the
boundary count such pairs. Candidates pass a bound from bitmaps of the sets, then the
exact comparison.

Nor need a set that no leader was linked with meet all of a large group: in a list where
groups would meet in many pairs, each member meets a few of the largest group first.
What that links is merged before the list is gone through again, with more of them each
time and at last with all pairs of groups that are still apart.

Shingles are ordered by a sketch of counts over all documents, rare ones first. The
sketch never counts too little, so a list that could be longer than a task should hold
is known before; those few go through joins that split (``_hot_pairs``).

Defined cases: a null or empty text, or one without words, has an empty set and is
linked with nothing; a text of fewer words than a shingle is one shingle; rows with
equal ``doc_id`` are documents of their own that share the id; a null ``doc_id`` counts
as larger than any other, and a group of only such rows has a null id; a text of any
length is read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import connected
from .shared import stored
from .words import mixed, shingle_set, slices, word_hashes

#: The largest set that may be light.
LIGHT_MOST = 24
#: Comparing two sets costs as much as so many rows.
COMPARE = 50
#: Places of the sketch, 32 bits each.
PLACES = 1 << 20
#: A list may hold so many rows more than twice the sketch's mean and still go to one task.
LIST_ROWS = 20_000
#: Candidates from lists are handed on in pieces of about so many.
_PAIRS = 1 << 18
_BANDS, _ROWS = 6, 3
#: Leaders of those who share a band's value: the first for all of them, the others for whom it leaves apart.
_LEADERS = 16
#: How many of a list's largest group its other members meet at first, and how many times as many the next time.
_FEW, _STEP = 4, 16
#: What the bitmaps must leave over of two sets' sizes for the pair to be all but surely linked.
_SURE = 0.03
_SEEDS = mixed(np.arange(1, _BANDS * _ROWS + 1, dtype=np.uint64)) | np.uint64(1)
#: Stands for a null doc_id.
_NO_ID = 2**63 - 1


class Rule:
    """Link if 100 * intersection >= percent * union, in terms of sizes."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def overlap(self, n, m):
        """The least intersection of linked sets of sizes n and m."""
        return -((-self.percent * (n + m)) // (100 + self.percent))

    def fits(self, small, large):
        return 100 * small >= self.percent * large

    def probe(self, n):
        """How many of a set's rarest shingles hold one that it shares with any linked set."""
        return n - -((-self.percent * n) // 100) + 1

    def index(self, n):
        """The same where the linked set is not smaller."""
        return n - self.overlap(n, n) + 1

    def partners(self, n: int) -> range:
        return range(-(-self.percent * n // 100), 100 * n // self.percent + 1)

    def subsets(self, n: int) -> int:
        """How many subsets a light set of size n enumerates."""
        return sum(math.comb(n, self.overlap(n, m)) for m in self.partners(n) if self.overlap(n, m) <= n)


def _bitmap(shingles: np.ndarray) -> bytes:
    """Parities of the shingles in as many places as the next power of two, 64 at least."""
    size = max(64, 1 << (len(shingles) - 1).bit_length())
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _apart(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles that only one of two sets has."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):  # place p of the smaller bitmap holds p, p + size, ... of the larger
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return int(np.bitwise_count(x ^ y).sum())


def _read_sets(part: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Document and set of each row."""
    hashes, offsets = word_hashes(part.column("text"))
    ids = part.column("doc_id").to_pylist()
    for doc_id, a, b in zip(ids, offsets[:-1], offsets[1:], strict=True):
        yield _NO_ID if doc_id is None else doc_id, shingle_set(hashes[a:b], n)


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    high, low = divmod(xxhash.xxh3_128_intdigest(shingles.tobytes()), 1 << 64)
    return high - (1 << 63), low - (1 << 63)


def _place(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(PLACES - 1)).astype(np.int64)


def _ids(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


_READ = (
    "doc long, n int, high long, low long, bands array<long>, bits binary, small array<long>, sketch binary"
)


def read_documents(docs: DataFrame, n: int) -> DataFrame:
    """A row for each document with what its set is known by, and one for each task with its counts of shingles."""
    schema = pa.schema(
        [
            ("doc", pa.int64()),
            ("n", pa.int32()),
            ("high", pa.int64()),
            ("low", pa.int64()),
            ("bands", pa.list_(pa.int64())),
            ("bits", pa.binary()),
            ("small", pa.list_(pa.int64())),
            ("sketch", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(PLACES, np.uint32)
        for batch in batches:
            for part in slices(batch):
                rows, all_places = [], []
                for doc, shingles in _read_sets(part, n):
                    row = {"doc": doc, "n": len(shingles)}
                    if len(shingles):
                        all_places.append(_place(shingles))
                        row["high"], row["low"] = _digest(shingles)
                        least = np.array([(shingles * seed).min() for seed in _SEEDS]).reshape(_BANDS, _ROWS)
                        row["bands"] = [xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) for x in least]
                        row["bits"] = _bitmap(shingles)
                        if len(shingles) <= LIGHT_MOST:
                            row["small"] = shingles.view(np.int64).tolist()
                    rows.append(row)
                if all_places:
                    counts += np.bincount(np.concatenate(all_places), minlength=PLACES).astype(np.uint32)
                yield pa.RecordBatch.from_pylist(rows, schema)
        if counts.any():
            yield pa.RecordBatch.from_pylist([{"n": -1, "sketch": _packed(counts)}], schema)

    return _ids(docs).mapInArrow(run, _READ)


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<u8" if counts.dtype.itemsize == 8 else "<u4").tobytes(), 1)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(PLACES, np.uint64)
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            data = zlib.decompress(packed)
            total += np.frombuffer(data, "<u4" if len(data) == 4 * PLACES else "<u8")
    yield pa.record_batch({"sketch": pa.array([_packed(total)], pa.binary())})


def _sketch(read: DataFrame) -> np.ndarray:
    """The counts of all tasks, added up in groups of 32 until one is left."""
    left = read.where("sketch is not null").select("sketch")
    n = left.count()
    while n > 1:
        n = -(-n // 32)
        left = stored(left.repartition(n).mapInArrow(_summed, "sketch binary"), "sketch")
    total = np.zeros(PLACES, np.uint64)
    for row in left.collect():  # one row of fixed size
        data = zlib.decompress(row.sketch)
        total += np.frombuffer(data, "<u4" if len(data) == 4 * PLACES else "<u8")
    return total


def light_bound(sizes: dict[int, int], met: float, rule: Rule) -> int:
    """Up to which size sets are light, by cost in rows.

    ``sizes`` counts classes by size, up to ``LIGHT_MOST``; ``met`` is how many other
    sets a list leads to on average.
    """

    def cost(bound: int) -> float:
        return sum(
            count * (rule.subsets(n) if n <= bound else rule.probe(n) * (1 + COMPARE * met))
            for n, count in sizes.items()
        )

    return min(range(LIGHT_MOST + 1), key=cost)


def light_links(classes: DataFrame, bound: int, rule: Rule) -> DataFrame:
    """Links among classes of at most ``bound`` shingles.

    A subset's key names both sizes. All of the smaller size that hold it link with all
    of the larger size, so they are one group as soon as both are there; of one size, all
    that hold it link.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lows, highs, numbers, sizes = [], [], [], [], []
            for number, small in zip(batch.column("class").to_pylist(), batch.column("small").to_pylist(), strict=True):
                n = len(small)
                shingles = [x.to_bytes(8, "little", signed=True) for x in small]
                for m in rule.partners(n):
                    size = rule.overlap(n, m)
                    if m > bound or size > min(n, m):
                        continue
                    subsets = [xxhash.xxh3_128_digest(b"".join(x)) for x in combinations(shingles, size)]
                    keys += subsets
                    lows += [min(n, m)] * len(subsets)
                    highs += [max(n, m)] * len(subsets)
                    numbers += [number] * len(subsets)
                    sizes += [n] * len(subsets)
            yield pa.record_batch(
                [pa.array(keys, pa.binary())]
                + [pa.array(x, pa.int32()) for x in (lows, highs, sizes)]
                + [pa.array(numbers, pa.int64())],
                names=["key", "low", "high", "n", "class"],
            )

    held = classes.where(F.col("n") <= bound).select("class", "small").mapInArrow(
        run, "key binary, low int, high int, n int, class long"
    )
    key = ["key", "low", "high"]
    least = held.groupBy(key).agg(
        F.min("class").alias("least"), F.min("n").alias("from_n"), F.max("n").alias("to_n"), F.count("*").alias("k")
    )
    shared = least.where("k > 1 and from_n = low and to_n = high").select(*key, "least")
    return held.join(shared, key).where(F.col("class") != F.col("least")).select(
        F.col("class").alias("a"), F.col("least").alias("b")
    )


def _bands(classes: DataFrame) -> DataFrame:
    return classes.select("class", F.posexplode("bands").alias("band", "value"))


def _with_leaders(members: DataFrame, bands: DataFrame, orders: range) -> DataFrame:
    """Pairs (a, b) of a member and the leaders of its bands, the first in ``bands`` by each order."""
    first = [F.min(F.struct(F.xxhash64("class", F.lit(k)).alias("order"), "class"))["class"] for k in orders]
    # Stored, so that the join has exchanges of its own and a common value can be split.
    leaders = stored(
        bands.groupBy("band", "value")
        .agg(F.count("*").alias("k"), F.array(*first).alias("leaders"))
        .where("k > 1")
        .select("band", "value", "leaders"),
        "leaders",
    )
    named = members.join(leaders, ["band", "value"])
    pairs = named.select(F.col("class").alias("a"), F.explode(F.array_distinct("leaders")).alias("b"))
    return pairs.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _leaders(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of a class and the first leader of each of its bands; one order serves all bands."""
    return _with_leaders(_bands(classes), _bands(classes), range(1))


def _led(classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of classes and leaders that the bitmaps let pass.

    Only classes that share a band and for which no first leader is all but surely linked
    meet the other leaders, each the first by an order of its own.
    """
    first = stored(_leaders(classes), "first-leaders")
    led = stored(_possible(first, classes, rule), "led")
    near = led.where(F.col("spare") >= _SURE).select(F.explode(F.array("a", "b")).alias("class")).distinct()
    apart = first.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(near, "class", "left_anti")
    bands = _bands(classes)
    more = _with_leaders(bands.join(apart, "class", "left_semi"), bands, range(1, _LEADERS))
    more = more.join(first, ["a", "b"], "left_anti")
    return stored(led.unionByName(_possible(more, classes, rule)), "led")


def _met(classes: DataFrame, grouped: DataFrame, sketch: np.ndarray, rule: Rule) -> float:
    """How many sets of other groups a set meets on average in one list of its rarest shingles.

    Taken from the lists of all classes that may be light, as they would be scanned.
    """
    counts = classes.sparkSession.sparkContext.broadcast(np.minimum(sketch, 2**32 - 1).astype(np.uint32))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, tokens = [], []
            for root, small in zip(batch.column("root").to_pylist(), batch.column("small").to_pylist(), strict=True):
                shingles = np.array(small, np.int64).view(np.uint64)
                order = np.lexsort((shingles, counts.value[_place(shingles)]))[: rule.probe(len(shingles))]
                tokens.append(shingles[order].view(np.int64))
                roots.append(np.full(len(order), root, np.int64))
            if tokens:
                yield pa.record_batch({"token": np.concatenate(tokens), "root": np.concatenate(roots)})

    small = classes.where(F.col("n") <= LIGHT_MOST).select("class", "small").join(grouped.select("class", "root"), "class")
    own = small.select("root", "small").mapInArrow(rarest, "token long, root long").groupBy("token", "root").count()
    each = F.col("count").cast("double")
    lists = own.groupBy("token").agg(F.sum(each).alias("k"), F.sum(each * each).alias("inside"))
    total = lists.agg(F.sum(F.col("k") * F.col("k") - F.col("inside")).alias("met"), F.sum("k").alias("k")).first()
    return total["met"] / total["k"] if total["k"] else 0.0


def _possible(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) that the bitmaps' bound lets pass, and by how much (``spare``)."""
    known = classes.select("class", "n", "bits")
    both = pairs.join(known.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa")), "a")
    both = both.join(known.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy().astype(np.int64), batch.column("nb").to_numpy().astype(np.int64)
            most = na + nb - 2 * rule.overlap(na, nb)
            bits = zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), strict=True)
            spare = most - np.array([_apart(x, y) for x, y in bits], np.int64)
            passed = batch.select(["a", "b"]).append_column("spare", pa.array(spare / np.maximum(1, na + nb)))
            yield passed.filter(pa.array(spare >= 0))

    return both.mapInArrow(run, "a long, b long, spare double")


def _bloom(ids: np.ndarray, bits: int) -> np.ndarray:
    seeds = np.array([1, 2, 3], np.uint64)
    return mixed(ids.astype(np.int64).view(np.uint64)[:, None] + seeds * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bits)


#: Bits of the filter that keeps most other texts from being read again; its size doesn't follow the data.
_BLOOM = 1 << 23


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the ids in column ``doc``, put together in groups of 32."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(_BLOOM, bool)
        for batch in batches:
            bits[_bloom(batch.column("doc").to_numpy(), _BLOOM).ravel().astype(np.int64)] = True
        yield pa.record_batch({"bits": pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(_BLOOM // 8, np.uint8)
        for batch in batches:
            for x in batch.column("bits").to_pylist():
                bits |= np.frombuffer(zlib.decompress(x), np.uint8)
        yield pa.record_batch({"bits": pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary())})

    left = stored(ids.select("doc").mapInArrow(made, "bits binary"), "filter")
    n = left.count()
    while n > 1:
        n = -(-n // 32)
        left = stored(left.repartition(n).mapInArrow(merged, "bits binary"), "filter")
    bits = np.zeros(_BLOOM // 8, np.uint8)
    for row in left.collect():  # one row of fixed size
        bits |= np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return np.unpackbits(bits).astype(bool)


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, rule: Rule) -> DataFrame:
    """Those of ``pairs`` (a, b) that are linked, by their whole sets."""
    needed = stored(
        pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(
            classes.select("class", "doc", "high", "low"), "class"
        ),
        "needed",
    )
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(np.packbits(_filter_of(needed)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(wanted.value).astype(bool)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
            for part in slices(batch.filter(pa.array(bits[_bloom(ids, _BLOOM).astype(np.int64)].all(axis=1)))):
                rows = [(doc, *_digest(s), s.tobytes()) for doc, s in _read_sets(part, n) if len(s)]
                columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
                yield pa.record_batch(
                    [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.binary())],
                    names=["doc", "high", "low", "shingles"],
                )

    sets = stored(
        _ids(docs)
        .mapInArrow(run, "doc long, high long, low long, shingles binary")
        .join(needed, ["doc", "high", "low"])
        .select("class", "shingles"),
        "sets",
    )
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("xa")), "a")
    both = both.join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("xb")), "b")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("xa"), batch.column("xb"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), "<u8") for s in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= rule.percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(compared, "a long, b long")


def _entries(
    docs: DataFrame, grouped: DataFrame, sketch: np.ndarray, longest: int, n: int, rule: Rule
) -> DataFrame:
    """The rarest shingles of each class, in order; from ``hot_from`` on, their lists may be longer than ``longest``."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(np.minimum(sketch, 2**32 - 1).astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc, shingles in _read_sets(part, n):
                    if len(shingles):
                        often = counts.value[_place(shingles)]
                        order = np.lexsort((shingles, often))[: rule.probe(len(shingles))]
                        first = shingles[order]
                        hot_from = int(np.searchsorted(often[order], longest))
                        rows.append((doc, *_digest(shingles), hot_from, first.view(np.int64)))
                columns = list(zip(*rows, strict=True)) if rows else [(), (), (), (), ()]
                yield pa.record_batch(
                    [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.list_(pa.int64()))],
                    names=["doc", "high", "low", "hot_from", "tokens"],
                )

    tokens = _ids(docs).mapInArrow(run, "doc long, high long, low long, hot_from long, tokens array<long>")
    return tokens.join(grouped.select("doc", "high", "low", "class", "root", "n"), ["doc", "high", "low"]).select(
        "class", "root", "n", "hot_from", "tokens"
    )


def _meets(n, at, m, bt, rule: Rule):
    """Whether sets of sizes n <= m with a common shingle at these places of theirs may be linked by this list."""
    return (at < rule.index(n)) & (1 + np.minimum(n - at - 1, m - bt - 1) >= rule.overlap(n, m))


def _few_of_largest(
    number: np.ndarray, group: np.ndarray, n: np.ndarray, few: int, rule: Rule
) -> tuple[np.ndarray, np.ndarray]:
    """Places, in a list sorted by size, of each member of another group and of ``few`` that fit in the largest."""
    largest = group == np.bincount(group).argmax()
    inside, others = np.flatnonzero(largest), np.flatnonzero(~largest)
    sizes = n[inside]
    low = np.searchsorted(sizes, -(-rule.percent * n[others] // 100), side="left")
    span = np.searchsorted(sizes, 100 * n[others] // rule.percent, side="right") - low
    others, low, span = others[span > 0], low[span > 0], span[span > 0]
    # Evenly spaced, from a place of the member's own on.
    first = (mixed(number[others].view(np.uint64)) % span.astype(np.uint64)).astype(np.int64)
    steps = np.arange(few)[None, :]
    at = low[:, None] + (first[:, None] + steps * np.maximum(1, span // few)[:, None]) % span[:, None]
    each = steps < span[:, None]
    return np.broadcast_to(others[:, None], at.shape)[each], inside[at[each]]


def _list_pairs(rows: dict[str, np.ndarray], rule: Rule, few: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) from the lists of whole tokens, sorted by token, in pieces.

    Lists whose groups meet in more than ``few`` pairs a member give so many at most, and a
    row with their ``token``.
    """
    token, number, root, n, at = (rows[k] for k in ("token", "class", "root", "n", "at"))
    n, at = n.astype(np.int64), at.astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    ends = np.append(starts[1:], len(token))
    several = np.minimum.reduceat(root, starts) != np.maximum.reduceat(root, starts)
    left, right, held, left_open = [], [], 0, []

    def piece() -> pa.RecordBatch:
        pairs = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right)]
        columns = [pa.array(x, pa.int64()) for x in (*pairs, left_open)]
        for i, size in ((0, len(left_open)), (1, len(left_open)), (2, len(pairs[0]))):
            parts = [columns[i], pa.nulls(size, pa.int64())]
            columns[i] = pa.concat_arrays(parts if i < 2 else parts[::-1])
        return pa.record_batch(columns, names=["a", "b", "token"])

    for a, b in zip(starts[several], ends[several], strict=True):
        order = a + np.lexsort((number[a:b], n[a:b]))
        sizes = n[order]
        if len(order) > 2 * few + 1:  # else its pairs can't be more
            _, group, counts = np.unique(root[order], return_inverse=True, return_counts=True)
            if len(order) ** 2 - int((counts.astype(np.int64) ** 2).sum()) > 2 * few * len(order):
                i, j = _few_of_largest(number[order], group, sizes, few, rule)
                x, y = order[np.minimum(i, j)], order[np.maximum(i, j)]
                met = _meets(n[x], at[x], n[y], at[y], rule)
                left.append(number[x[met]])
                right.append(number[y[met]])
                left_open.append(int(token[a]))
                held += int(met.sum()) + 1
                if held >= _PAIRS:
                    yield piece()
                    left, right, held, left_open = [], [], 0, []
                continue
        for i in range(len(order)):
            x = order[i]
            if at[x] >= rule.index(int(n[x])):
                continue
            # Partners come later in the order of size, up to the largest that fits.
            stop = np.searchsorted(sizes, 100 * sizes[i] // rule.percent, side="right")
            other = order[i + 1 : stop]
            other = other[root[other] != root[x]]
            other = other[_meets(n[x], at[x], n[other], at[other], rule)]
            left.append(np.full(len(other), number[x]))
            right.append(number[other])
            held += len(other)
            if held >= _PAIRS:
                yield piece()
                left, right, held, left_open = [], [], 0, []
    if held:
        yield piece()


def _cold_pairs(rows: DataFrame, rule: Rule, few: int) -> DataFrame:
    """Candidates (a, b) from lists that one task can hold, and the ``token`` of each that isn't gone through yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "class", "root", "n", "at"]
        kept: dict[str, np.ndarray] | None = None
        for batch in batches:
            new = {k: batch.column(k).to_numpy() for k in names}
            if kept is not None:
                new = {k: np.concatenate([kept[k], new[k]]) for k in names}
            # The last token may go on in the next batch.
            done = int(np.searchsorted(new["token"], new["token"][-1])) if len(new["token"]) else 0
            kept = {k: v[done:] for k, v in new.items()}
            if done:
                yield from _list_pairs({k: v[:done] for k, v in new.items()}, rule, few)
        if kept is not None and len(kept["token"]):
            yield from _list_pairs(kept, rule, few)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "token").sortWithinPartitions("token").mapInArrow(run, "a long, b long, token long")


def _may_link(rule: Rule):
    """Whether sets of sizes n_a and n_b may be linked that share a shingle at at_a and at_b."""
    needed = F.ceil(rule.percent * (F.col("n_a") + F.col("n_b")) / (100 + rule.percent))
    most = 1 + F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) - 1
    return (100 * F.least("n_a", "n_b") >= rule.percent * F.greatest("n_a", "n_b")) & (most >= needed)


def _hot_few(rows: DataFrame, rule: Rule) -> DataFrame:
    """Candidates from lists of any length: each member with a few of the list's largest group."""
    few = [F.min(F.struct(F.xxhash64("token", "class", F.lit(k)).alias("order"), "class", "n", "at")) for k in range(_FEW)]
    groups = rows.groupBy("token", "root").agg(F.count("*").alias("k"), F.array(*few).alias("few"))
    largest = stored(
        groups.groupBy("token")
        .agg(F.count("*").alias("groups"), F.max(F.struct("k", "root", "few")).alias("largest"))
        .where("groups > 1")
        .select("token", "largest"),
        "largest",
    )
    own = [F.col(c).alias(f"{c}_a") for c in ("class", "n", "at")]
    met = rows.join(largest, "token").where("root != largest.root").select(
        *own, F.explode(F.array_distinct("largest.few")).alias("other")
    )
    pairs = met.select("*", *[F.col(f"other.{c}").alias(f"{c}_b") for c in ("class", "n", "at")])
    return pairs.where(_may_link(rule)).select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))


def _hot_pairs(rows: DataFrame, rule: Rule) -> DataFrame:
    """Candidates from lists of any length: groups in a list first, then the members of groups that may link."""
    groups = rows.groupBy("token", "root").agg(F.min("n").alias("from_n"), F.max("n").alias("to_n"))
    several = groups.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    groups = groups.join(several, "token")
    left = groups.select("token", *[F.col(c).alias(f"{c}_a") for c in ("root", "from_n", "to_n")])
    right = groups.select("token", *[F.col(c).alias(f"{c}_b") for c in ("root", "from_n", "to_n")])
    near = left.join(right, "token").where(
        (F.col("root_a") < F.col("root_b"))
        & (100 * F.col("to_n_a") >= rule.percent * F.col("from_n_b"))
        & (100 * F.col("to_n_b") >= rule.percent * F.col("from_n_a"))
    )
    for side in "ab":
        members = rows.select(
            "token",
            F.col("root").alias(f"root_{side}"),
            *[F.col(c).alias(f"{c}_{side}") for c in ("class", "n", "at")],
        )
        near = near.join(members, ["token", f"root_{side}"])
    return near.where(_may_link(rule)).select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))


def _rooted(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with ``root``, the smallest class of the group."""
    roots = connected(links)
    return classes.join(roots, classes["class"] == roots["node"], "left").select(
        *[classes[c] for c in classes.columns], F.coalesce("root", "class").alias("root")
    )


def _between(pairs: DataFrame, rooted: DataFrame) -> DataFrame:
    """``pairs`` whose classes are in different groups, with the groups."""
    for side in "ab":
        group = rooted.select(F.col("class").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(group, side)
    return pairs.where("root_a != root_b")


def _merged(rooted: DataFrame, links: DataFrame) -> DataFrame:
    """``rooted`` with the groups joined that ``links`` (root_a, root_b) connect."""
    between = connected(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    first = between.withColumnRenamed("root", "first")
    return rooted.join(first, F.col("root") == F.col("node"), "left").select(
        *[F.coalesce("first", "root").alias("root") if c == "root" else F.col(c) for c in rooted.columns]
    )


def components(docs: DataFrame, n: int = 5, percent: int = 80, list_rows: int = LIST_ROWS) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the group's smallest ``doc_id``) of every row of ``docs``."""
    rule = Rule(percent)
    read = stored(read_documents(docs, n), "sets-read")
    sketch = _sketch(read)
    rows = read.where("n >= 0").select("doc", "n", "high", "low", "bands", "bits", "small")
    # A set of a class is any of its equal copies' sets.
    classes = stored(
        rows.where("n > 0")
        .groupBy("high", "low", "n")
        .agg(F.min("doc").alias("doc"), *[F.min(c).alias(c) for c in ("bands", "bits", "small")])
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )

    # First the likeliest leader of each, then what would still join groups.
    led = _led(classes, rule)
    best = led.groupBy("a").agg(F.max(F.struct("spare", "b"))["b"].alias("b"))
    known = classes.select("class", "n", "doc", "high", "low")
    rooted = stored(_rooted(known, verified(best, classes, docs, n, rule)), "rooted")
    others = _between(led, rooted).groupBy("a", "root_b").agg(F.max(F.struct("spare", "b"))["b"].alias("b"))
    links = _between(verified(others.select("a", "b"), classes, docs, n, rule), rooted)
    grouped = stored(_merged(rooted, links), "grouped")

    sizes = dict(classes.where(F.col("n") <= LIGHT_MOST).groupBy("n").count().collect())
    bound = light_bound(sizes, _met(classes, grouped, sketch, rule), rule)
    grouped = stored(_merged(grouped, _between(light_links(classes, bound, rule), grouped)), "grouped")
    # Sets that a heavy one could link with, light ones near the bound among them.
    heavy = classes.where(100 * F.col("n") >= percent * (bound + 1))

    longest = int(2 * sketch.mean()) + list_rows
    listed = grouped.join(heavy.select("class"), "class", "left_semi")
    entries = stored(_entries(docs, listed, sketch, longest, n, rule), "entries")
    rows_of_lists = entries.select("class", "root", "n", "hot_from", F.posexplode("tokens").alias("at", "token"))
    columns = ["token", "class", "root", "n", "at"]
    cold = rows_of_lists.where("at < hot_from").select(columns)
    hot = rows_of_lists.where("at >= hot_from").select(columns)

    def linked(pairs: DataFrame) -> DataFrame:
        """``grouped`` with the groups joined that linked ones of ``pairs`` connect."""
        ordered = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        candidates = stored(_possible(ordered, classes, rule).select("a", "b"), "candidates")
        more = verified(candidates, classes, docs, n, rule)
        return stored(_merged(grouped, _between(more, grouped)), "grouped")

    def regrouped(rows: DataFrame) -> DataFrame:
        return rows.drop("root").join(grouped.select("class", "root"), "class").select(columns)

    # Lists in which too many groups meet are gone through again when a few of their pairs have been tried.
    few, any_hot = _FEW, not hot.isEmpty()
    found = stored(_cold_pairs(cold, rule, few), "listed")
    pairs = found.where("a is not null").select("a", "b")
    grouped = linked(pairs.unionByName(_hot_few(hot, rule)) if any_hot else pairs)
    lists = stored(cold.join(found.where("token is not null").select("token"), "token", "left_semi"), "lists")
    while not lists.isEmpty():
        few *= _STEP
        found = stored(_cold_pairs(regrouped(lists), rule, few), "listed")
        grouped = linked(found.where("a is not null").select("a", "b"))
        lists = stored(lists.join(found.where("token is not null").select("token"), "token", "left_semi"), "lists")
    if any_hot:
        grouped = linked(_hot_pairs(regrouped(hot), rule))
    final = grouped.select("high", "low", "doc", "root")
    smallest = final.groupBy("root").agg(F.min("doc").alias("component"))
    named = stored(final.join(smallest, "root").select("high", "low", "component"), "components")

    result = rows.select("doc", "n", "high", "low").join(named, ["high", "low"], "left")
    no_id = F.lit(_NO_ID)
    component = F.coalesce("component", "doc")
    return result.select(
        F.when(F.col("doc") != no_id, F.col("doc")).alias("doc_id"),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(component != no_id, component).alias("component_id"),
    )
