"""Words of texts as 64-bit hashes, a slice of an Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are split at once; a longer text makes a slice of its own.
SLICE_BYTES = 2 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` bytes, or members of lists, of ``column``."""
    values = batch.column(column)
    length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    lengths = pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False).tolist()
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > size:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield batch.slice(start)


def filled(texts: pa.Array) -> pa.Array:
    """The texts, null as empty, in buffers of their own: some kernels misread a slice's."""
    return pc.fill_null(texts, "").take(pa.array(np.arange(len(texts)))).cast(pa.large_string())


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+`` and, for each text, where its words begin.

    The second array has one entry more than there are texts. Null texts have no words.
    """
    plain = filled(texts)
    split = pc.ascii_split_whitespace(pc.ascii_lower(plain) if lower else plain)
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    words = split.flatten()
    kept = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not kept.all():
        offsets = np.concatenate(([0], np.cumsum(kept)))[offsets]
        words = words.filter(pa.array(kept))
    if not len(words):
        return np.zeros(0, np.uint64), offsets
    coded = words.dictionary_encode()
    known = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary)
    )
    return known[coded.indices.to_numpy()], offsets


def mixed(x: np.ndarray) -> np.ndarray:
    """The numbers scattered over 64 bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` words from each position on; as many as there are full windows."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = mixed(hashes[:count])
    for k in range(1, n):
        total = mixed(total * _GOLDEN + hashes[k : k + count])
    return total


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """The sorted set of a text's shingles; a shorter text is one shingle, an empty one has none."""
    if len(hashes) == 0:
        return hashes
    return np.unique(grams(hashes, min(n, len(hashes))))
