"""A minimal perfect hash over line hashes, with arrays that it indexes."""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

from .words import mixed

#: Places for each key of a level; keys that share a place go to the next level.
_SPARE = 2
_LEVELS = 40
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    shift = np.uint64((int(_STEP) * (level + 1)) % (1 << 64))
    return (mixed(keys + shift) % np.uint64(size)).astype(np.int64)


def _joint(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mixed(high.astype(np.uint64)) + low.astype(np.uint64) * _STEP


@dataclass
class LineIndex:
    """Fingerprint, document count and last document of each line of a shard.

    Each level is a bit array; a key's number is the rank of its bit in the first level
    where it has one of its own. Keys that no level tells apart, which takes equal
    64-bit mixtures, are numbered last, in the order of ``rest``.
    """

    levels: list[np.ndarray]
    ranks: list[np.ndarray]
    rest: np.ndarray
    prints: np.ndarray
    counts: np.ndarray
    last: np.ndarray

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray, last: np.ndarray) -> LineIndex:
        """Of distinct pairs (high, low), 128 bits of a line's hash."""
        left, number, first = _joint(high, low), np.full(len(high), -1, np.int64), 0
        at = np.arange(len(high))
        levels, ranks = [], []
        for level in range(_LEVELS):
            if not len(at):
                break
            size = -(-_SPARE * len(at) // 64) * 64
            places = _places(left[at], level, size)
            alone = np.bincount(places, minlength=size) == 1
            bits = np.packbits(alone.reshape(-1, 64), axis=1, bitorder="little").view("<u8").ravel()
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(bits).astype(np.int64))))
            levels.append(bits)
            ranks.append(before[:-1] + first)
            won = alone[places]
            number[at[won]] = _ranked(bits, ranks[-1], places[won])
            first += int(before[-1])
            at = at[~won]
        rest = at[np.lexsort((low[at], high[at]))]
        number[rest] = first + np.arange(len(rest))
        order = np.empty(len(high), np.int64)
        order[number] = np.arange(len(high))
        pairs = np.stack([high, low], axis=1).astype(np.int64)
        return cls(levels, ranks, pairs[rest], low[order].astype(np.int64), counts[order], last[order])

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The number of each line, or -1 where its fingerprint isn't there."""
        keys, found = _joint(high, low), np.full(len(high), -1, np.int64)
        at = np.arange(len(high))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            if not len(at):
                break
            places = _places(keys[at], level, len(bits) * 64)
            hit = (bits[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1
            found[at[hit]] = _ranked(bits, rank, places[hit])
            at = at[~hit]
        known = found >= 0
        wrong = known.copy()
        wrong[known] = self.prints[found[known]] != low[known]
        found[wrong] = -1
        for i, pair in enumerate(self.rest):
            same = (high == pair[0]) & (low == pair[1])
            found[same] = len(self.prints) - len(self.rest) + i
        return found

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        parts = {f"level{i}": x for i, x in enumerate(self.levels)} | {f"rank{i}": x for i, x in enumerate(self.ranks)}
        np.savez(out, rest=self.rest, prints=self.prints, counts=self.counts, last=self.last, **parts)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> LineIndex:
        with np.load(io.BytesIO(data)) as x:
            n = sum(k.startswith("level") for k in x.files)
            return cls(
                [x[f"level{i}"] for i in range(n)],
                [x[f"rank{i}"] for i in range(n)],
                x["rest"],
                x["prints"],
                x["counts"],
                x["last"],
            )


def _ranked(bits: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The number of the bit at each place."""
    below = bits[places >> 6] & ((np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1))
    return ranks[places >> 6] + np.bitwise_count(below).astype(np.int64)
