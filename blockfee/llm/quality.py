"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

Features of a text are its words, its pairs of words, the shapes of words (case and
punctuation) alone and in pairs, and whether a word repeats one of the words before it,
each hashed to one of ``DIMENSIONS`` places and weighed by its share of the text's
words. A score is the sigmoid of a sparse dot product.

Defined cases: a null or empty text has no features and scores by the bias alone; rows
with equal texts score alike; a text of any length is read whole; an empty table gives
an empty result; without usable labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import filled, mixed, slices

DIMENSIONS = 1 << 18
#: How far back a repeated word is looked for.
_BACK = 8
_FAMILIES = 4 + _BACK


def _shape(word: str) -> str:
    """Case and punctuation of a word: ``Aa``, ``a,``, ``A!!``, ``|``; digits are ``0``, runs of one kind shrink."""
    out: list[str] = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not (out and out[-1] == kind and kind in "Aa0"):
            out.append(kind)
        if len(out) == 12:
            break
    return "".join(out)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the features, a row for each word and a column for each kind of feature, and where texts begin.

    A place of -1 holds no feature.
    """
    split = pc.ascii_split_whitespace(filled(texts))
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    words = split.flatten()
    kept = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(kept)))[offsets]
    words = words.filter(pa.array(kept))
    n = len(words)
    places = np.full((n, _FAMILIES), -1, np.int64)
    if not n:
        return places, offsets
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy()
    known = coded.dictionary.to_pylist()
    word = np.fromiter((xxhash.xxh3_64_intdigest(w.lower(), 1) for w in known), np.uint64, len(known))[index]
    shape = np.fromiter((xxhash.xxh3_64_intdigest(_shape(w), 2) for w in known), np.uint64, len(known))[index]
    # How many words of the same text stand before each word.
    behind = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    size = np.uint64(DIMENSIONS)
    places[:, 0] = word % size
    places[:, 1] = shape % size
    for column, hashes in ((2, word), (3, shape)):
        pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:]) % size
        places[1:, column] = np.where(behind[1:] >= 1, pairs.astype(np.int64), -1)
    for back in range(1, _BACK + 1):
        same = (index[back:] == index[:-back]) & (behind[back:] >= back)
        place = xxhash.xxh3_64_intdigest(f"same{back}", 3) % DIMENSIONS
        places[back:, 3 + back] = np.where(same, place, -1)
    return places, offsets


def _sparse(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of one text and their values."""
    found, counts = np.unique(places[places >= 0], return_counts=True)
    return found, counts / max(1, len(places))


@dataclass
class Leader:
    """Follow-the-regularised-leader for logistic loss, with a learning rate for each weight."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1

    def __post_init__(self) -> None:
        # The last place is the bias.
        self.z = np.zeros(DIMENSIONS + 1)
        self.n = np.zeros(DIMENSIONS + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = (sigmoid(float(w @ values)) - label) * values
        squared = self.n[at] + gradient**2
        self.z[at] += gradient - (np.sqrt(squared) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = squared


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 6000, epochs: int = 8
) -> np.ndarray:
    """Weights, the bias last, learnt from at most ``max_rows`` labelled documents.

    ``labels`` has ``doc_id`` and the 0/1 column ``label``; rows with a null are left
    out. The sample, the rows with the smallest hash of ``doc_id``, is the same at every
    run. Its features are made where the texts are; one task goes over them.
    """
    sample = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # max_rows bounds the side that is broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                places, offsets = features(part.column("text"))
                rows = [_sparse(places[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "label": part.column("label"),
                        "at": pa.array([at.astype("<i4").tobytes() for at, _ in rows], pa.binary()),
                        "x": pa.array([x.astype("<f4").tobytes() for _, x in rows], pa.binary()),
                    }
                )

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (r["label"], np.frombuffer(r["at"], "<i4"), np.frombuffer(r["x"], "<f4").astype(float))
            for batch in batches
            for r in batch.to_pylist()
        ]
        leader = Leader()
        order = np.random.default_rng(7)
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                known, at, x = rows[i]
                leader.learn(np.append(at, DIMENSIONS), np.append(x, 1.0), known)
        yield pa.record_batch({"weights": pa.array([leader.weights(slice(None)).astype("<f8").tobytes()], pa.binary())})

    rows = (
        texts.mapInArrow(made, "doc_id long, label int, at binary, x binary")
        .repartition(1)
        .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "at")
        .mapInArrow(learnt, "weights binary")
        .collect()
    )
    # No row if there was no task, so nothing to learn from.
    return np.frombuffer(rows[0].weights, "<f8") if rows else np.zeros(DIMENSIONS + 1)


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The score of each text."""
    places, offsets = features(texts)
    # Place -1 takes the last entry of the extended weights, which is 0.
    by_word = np.append(weights[:-1], 0.0)[places].sum(axis=1)
    total = np.concatenate(([0.0], np.cumsum(by_word)))
    counts = np.diff(offsets)
    return sigmoid((total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(1, counts) + weights[-1])


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id`` and ``score`` of every row of ``docs``, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                score = scores(part.column("text"), shared.value)
                yield pa.record_batch({"doc_id": part.column("doc_id"), "score": pa.array(score)})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def kept(docs: DataFrame, weights: np.ndarray, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(scores(part.column("text"), shared.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)
