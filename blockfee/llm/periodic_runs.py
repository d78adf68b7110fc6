"""Runs of repeated words: maximal stretches with a period, found by block convolution.

A run is a stretch of consecutive words with smallest period q whose length is at least
``max(least, 2 * q)`` and that can't be extended keeping that period. At the scale of blocks of B words, B a
power of two, periods from 2B - 1 to 4B - 2 are sought: wherever a run has such a period, at
least 2B - 1 words in a row equal those q further on, so one whole block of the grid is
among them. For each block, the squared differences between it and every place of the window
that follows are summed by an exact integer number-theoretic transform; a sum of zero is an
occurrence, and its distance a candidate for q. Blocks that follow each other at one distance
are joined, checked word by word, and extended by less than a block on either side.

Before the transform, blocks are left out that can have no occurrence in the window (a word
of them isn't found there again) or none that is new (they and the window lie within a run
of a shorter period, so that every distance would be a multiple of it). Stretches with the
same two ends are one run, whose period is the smallest of them.

Texts are worked through in slices, with a word of its own between any two, and a
long text is a slice of its own; memory follows the words of a slice.

Cases: null and empty texts, and texts with fewer than ``least`` words, have no runs and
``collapsed`` of a null text is empty. Very long texts and words are taken whole. Ties in the
longest run go to the smallest start, then period. Repeated rows and ids are rows of their
own. An empty table gives an empty result. Extra columns are kept whatever their names; those
with the names of ``runs`` and ``collapsed`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ntt import LARGEST, MODULUS, convolved
from .words import filled, slices

#: Bytes of text, about, that are worked through at once, and numbers of a transform.
SLICE_BYTES = 4 << 20
CHUNK = 1 << 18
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...``, ``counts[i]`` of them, for all i in turn."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _matched(words: np.ndarray, one: np.ndarray, two: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words from places ``one`` on equal those from ``two`` on, going by ``step``, up to ``most``."""
    found = np.zeros(len(one), np.int64)
    going = np.arange(len(one))
    width = min(16, most)
    while len(going) and width > 0:
        chunk = np.arange(width) * step
        pieces = max(1, CHUNK // width)
        rest = []
        for at in range(0, len(going), pieces):
            some = going[at : at + pieces]
            a = one[some] + step * found[some]
            b = two[some] + step * found[some]
            i, j = a[:, None] + chunk, b[:, None] + chunk
            inside = (i >= 0) & (j >= 0) & (i < len(words)) & (j < len(words))
            same = inside & (words[np.where(inside, i, 0)] == words[np.where(inside, j, 0)])
            length = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
            found[some] += length
            rest.append(some[(length == width) & (found[some] < most)])
        going = np.concatenate(rest)
        width = min(2 * width, 1 << 14, max(1, most - int(found[going].min())) if len(going) else 1)
    return np.minimum(found, most)


def _occurrences(words: np.ndarray, starts: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Block starts and distances, ``low`` to ``high``, at which a block's codes come again.

    Codes are small enough for sums of squares to stay below the modulus, so a sum that
    is zero modulo it is zero; words that share a code are told apart later.
    """
    bits = min(20, (int(MODULUS // size).bit_length() - 1) // 2)
    codes = (words.astype(np.uint64) * _GOLDEN) >> np.uint64(64 - bits)
    codes = np.concatenate((codes, np.zeros(high + size, np.uint64)))  # windows may end beyond the last word
    squares = np.concatenate(([0], np.cumsum(codes * codes)))
    window, length = high - low + size, 4 * size
    found_starts, found_distances = [], []
    pieces = max(1, CHUNK // length)
    for at in range(0, len(starts), pieces):
        some = starts[at : at + pieces]
        blocks = np.zeros((len(some), length), np.uint64)
        blocks[:, :size] = codes[some[:, None] + np.arange(size)][:, ::-1]
        texts = np.zeros((len(some), length), np.uint64)
        texts[:, :window] = codes[some[:, None] + low + np.arange(window)]
        products = convolved(texts, blocks)[:, size - 1 : size + high - low]
        there = some[:, None] + low + np.arange(high - low + 1)
        both = squares[there + size] - squares[there] + (squares[some + size] - squares[some])[:, None]
        i, j = np.nonzero(both == 2 * products)
        found_starts.append(some[i])
        found_distances.append(low + j)
    if not found_starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_starts), np.concatenate(found_distances)


def _within(runs: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """For each block start the run of period ``size`` / 2 at most that holds the whole block, or -1.

    Two such runs can't share a block: their common part would have a smaller period.
    """
    inner = np.flatnonzero((runs[:, 2] * 2 <= size) & (runs[:, 1] >= size))
    first = -(-runs[inner, 0] // size)
    last = (runs[inner, 0] + runs[inner, 1]) // size
    some = last > first
    inner, first, count = inner[some], first[some], (last - first)[some]
    covered = np.full(int(starts[-1]) // size + 1 if len(starts) else 0, -1, np.int64)
    places = _places(first, count)
    keep = places < len(covered)
    covered[places[keep]] = np.repeat(inner, count)[keep]
    return covered[starts // size]


def _stretches(words: np.ndarray, starts: np.ndarray, distances: np.ndarray, size: int) -> np.ndarray:
    """Maximal stretches (start, end, distance) of words that equal those at the distance, around the given blocks."""
    order = np.lexsort((starts, distances))
    starts, distances = starts[order], distances[order]
    whole = _matched(words, starts, starts + distances, 1, size) == size
    starts, distances = starts[whole], distances[whole]
    if not len(starts):
        return np.zeros((0, 3), np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (distances[1:] != distances[:-1]) | (starts[1:] != starts[:-1] + size)
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(starts)) - 1
    left, right, gap = starts[firsts], starts[lasts] + size, distances[firsts]
    left = left - _matched(words, left - 1, left - 1 + gap, -1, size)
    right = right + _matched(words, right, right + gap, 1, size)
    return np.stack((left, right, gap), axis=1)


def find_runs(words: np.ndarray, least: int, longest: int | None = None) -> np.ndarray:
    """All runs of a sequence of word numbers: rows (start, length, period) by start, then period.

    ``longest`` bounds how many words a run may have, if something is known of it.
    """
    count = len(words)
    longest = count if longest is None else min(longest, count)
    runs = np.zeros((0, 3), np.int64)
    if count < 2 or longest < max(2, least):
        return runs
    order = np.argsort(words, kind="stable")
    again = np.full(count, count, np.int64)  # how far on the same word comes next
    same = words[order[1:]] == words[order[:-1]]
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    # The periods up to the smallest scale's highest; shorter runs than 2B - 1 words and a period need none below.
    size = 1 if least < 5 else 2
    low = 1
    while low <= longest // 2 and 4 * size <= LARGEST:
        high = 4 * size - 2
        starts = np.arange(count // size, dtype=np.int64) * size
        near = again[: len(starts) * size].reshape(-1, size).max(axis=1) <= high
        starts = starts[near]
        if len(starts):
            held = _within(runs, starts, size)
            end = np.where(held >= 0, runs[held, 0] + runs[held, 1], 0) if len(runs) else np.zeros(len(starts), np.int64)
            fresh = starts + high + size > end
            starts, held, end = starts[fresh], held[fresh], end[fresh]
            at, distances = _occurrences(words, starts, size, low, high)
            inside = at + distances + size < count + 1
            at, distances = at[inside], distances[inside]
            place = np.searchsorted(starts, at)
            known = held[place] >= 0
            if known.any():
                period = np.where(known, runs[held[place], 2], 1)
                known &= (distances % period == 0) & (at + distances + size <= end[place])
            found = _stretches(words, at[~known], distances[~known], size)
            length = found[:, 1] - found[:, 0] + found[:, 2]
            good = (length >= 2 * found[:, 2]) & (length >= least)
            new = np.stack((found[:, 0], length, found[:, 2]), axis=1)[good]
            runs = _distinct(np.concatenate((runs, new)))
        low = high + 1
        size *= 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _distinct(runs: np.ndarray) -> np.ndarray:
    """One row for each start and length, with the smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def _slice(texts: pa.Array, least: int) -> tuple[pa.Array, pa.Array]:
    """Runs of each text, and the text without repeats, words joined by a blank."""
    split = pc.ascii_split_whitespace(filled(texts))
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    tokens = split.flatten()
    real = pc.greater(pc.binary_length(tokens), 0).to_numpy(zero_copy_only=False)
    if not real.all():
        bounds = np.concatenate(([0], np.cumsum(real)))[bounds]
        tokens = tokens.filter(pa.array(real))
    counts = np.diff(bounds)
    rows = len(counts)
    coded = tokens.dictionary_encode()
    # A number of its own after each text keeps runs from going on in the next one.
    words = np.empty(len(tokens) + rows, np.int64)
    shifted = np.arange(len(tokens)) + np.repeat(np.arange(rows), counts)
    words[shifted] = coded.indices.to_numpy(zero_copy_only=False)
    words[bounds[1:] + np.arange(rows)] = len(coded.dictionary) + np.arange(rows)
    runs = find_runs(words, least, int(counts.max(initial=0)))
    begins = bounds[:-1] + np.arange(rows)
    text = np.searchsorted(begins, runs[:, 0], side="right") - 1
    # Words after a run's first period go; a difference of 1 begins such a stretch, of -1 ends it.
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = (np.cumsum(change[:-1]) == 0)[shifted]
    kept_bounds = np.concatenate(([0], np.cumsum(kept)))[bounds]
    lists = pa.ListArray.from_arrays(pa.array(kept_bounds.astype(np.int32)), tokens if kept.all() else tokens.filter(pa.array(kept)))
    collapsed = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
    fields = [pa.array(runs[:, 0] - begins[text]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
    run_bounds = np.searchsorted(text, np.arange(rows + 1)).astype(np.int32)
    found = pa.ListArray.from_arrays(pa.array(run_bounds), pa.StructArray.from_arrays(fields, fields=list(_RUN)))
    return found, collapsed


def with_runs(
    docs: DataFrame, least: int = 12, text: str = "text", runs: str = "runs", collapsed: str = "collapsed"
) -> DataFrame:
    """The columns of ``docs``, its ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` is the text's words joined by single blanks, without those that any run
    has after its first period. Words are ``[^\\x20\\x09-\\x0D]+``; starts are counted in words from 0.
    """
    if least < 2:
        raise ValueError("a run has at least two words")
    others = [name for name in docs.columns if name not in (runs, collapsed)]
    rows = docs.select(F.struct(*others).alias("row"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES):
                found, words = _slice(piece.column("text"), least)
                yield pa.RecordBatch.from_arrays([piece.column("row"), found, words], ["row", "runs", "collapsed"])

    schema = T.StructType(
        [rows.schema["row"], T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    )
    worked = rows.mapInArrow(work, schema)
    return worked.select("row.*", F.col("runs").alias(runs), F.col("collapsed").alias(collapsed))


def longest_run(runs: Column) -> Column:
    """The run with the greatest length, ties to the smallest start, then period; null if there is none."""
    order = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                 (-r["period"]).alias("period")))
    best = F.array_max(order)
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"),
                                             (-best["period"]).alias("period")))


def written(runs: Column) -> Column:
    """Every run as a line ``start,length,period`` with its end."""
    line = lambda r: F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")])
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
