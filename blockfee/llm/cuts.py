"""Ids of whole columns of text, from what is known of the words in them.

The pattern of byte-level BPE never has a piece that goes on from a character other than
white space into white space, nor from a letter into punctuation, and it looks back no
further. So a text may be cut before a space or line break that follows such a
character and precedes a word, and between a word and the punctuation behind it,
without changing its ids.

A slice of texts is cut and its distinct words are found by Arrow; only distinct words are
looked up, only new ones encoded. Texts with white space in any other place take the
scalar way, ``encoded_cuts``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import filled

#: Words of each generation that are kept, and characters of the longest of them: at most
#: half a kilobyte each, usually much less.
KEPT_WORDS = 400_000
LONGEST_KEPT = 32
_PUNCTUATION = ".,;:!?%&$#*|)(]['\"-"


class KnownCuts:
    """Encodes columns of text by ``encode_many``, which takes texts and gives 32-bit little-endian ids."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], kept: int | None = None) -> None:
        self.encode_many = encode_many
        #: How many words are kept, instead of ``KEPT_WORDS``.
        self.most = kept
        #: By the word after a space, or by the word with its line break. Words that went on
        #: being used in the older generation are taken over from it.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: Words that are too long to be kept beyond their slice.
        self.long: list[str] = []
        #: By the text itself: what begins a text, and punctuation.
        self.plain: dict[str, bytes] = {}
        #: Of the scalar way.
        self.scalar: dict[str, bytes | None] = {}

    def _forget(self) -> None:
        for word in self.long:
            self.words.pop(word, None)
        self.long = []
        most = self.most or KEPT_WORDS
        if len(self.words) > most:
            self.older, self.words = self.words, {}
        # Texts' first words are rarely met again.
        for known in (self.plain, self.scalar):
            if len(known) > most // 4:
                known.clear()

    def _learn(self, words: list[str], plain: list[str]) -> None:
        """Makes sure that all of them are known."""
        new, new_plain, joined = [], {x for x in plain if x not in self.plain}, []
        for word in words:
            if word in self.words:
                continue
            if (known := self.older.get(word)) is not None:
                self.words[word] = known
                continue
            base = word.rstrip(_PUNCTUATION)
            if base != word and base and base[-1].isalpha():
                joined.append((word, base, word[len(base) :]))
                if joined[-1][2] not in self.plain:
                    new_plain.add(joined[-1][2])
                if base not in self.words:
                    if (known := self.older.get(base)) is not None:
                        self.words[base] = known
                    else:
                        new.append(base)
            else:
                new.append(word)
        new = list(dict.fromkeys(new))
        starts = [*(x if x[0] == "\n" else f" {x}" for x in new), *new_plain]
        ids = self.encode_many(starts) if starts else []
        self.words.update(zip(new, ids, strict=False))
        self.plain.update(zip(new_plain, ids[len(new) :], strict=True))
        for word, base, end in joined:
            self.words[word] = self.words[base] + self.plain[end]
            if len(word) > LONGEST_KEPT:
                self.long.append(word)
        self.long += [x for x in new if len(x) > LONGEST_KEPT]

    def encode_one(self, text: str) -> bytes:
        return b"".join(encoded_cuts(text, self.scalar, lambda cut: self.encode_many([cut])[0]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and how many each text has; null is an empty text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._forget()
        plain = filled(texts)
        # A word at the start of a line carries its line break.
        split = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        first = (split.offsets.to_numpy() - split.offsets[0].as_py())[:-1]
        coded = split.flatten().dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        words = coded.dictionary.to_pylist()
        # An empty word, or one that ends in white space, stands where no cut may be.
        unsafe = np.fromiter((not w or w[-1].isspace() for w in words), bool, len(words))
        scalar = np.logical_or.reduceat(unsafe[index], first)
        by_hand = [self.encode_one(plain[int(i)].as_py()) for i in np.flatnonzero(scalar)]

        counts = np.diff(np.append(first, len(index)))
        whole = np.repeat(~scalar, counts)
        whole[first] = False
        used = np.zeros(len(words), bool)
        used[index[whole]] = True
        begins = [words[i] for i in index[first[~scalar]]]
        self._learn([w for w, u in zip(words, used, strict=True) if u], begins)
        values = [self.words[w] if u else b"" for w, u in zip(words, used, strict=True)]
        values += [self.plain[x] for x in begins] + by_hand + [b""]

        # A text of the scalar way is one value at its first word and empty at the others.
        index[np.repeat(scalar, counts)] = len(values) - 1
        index[first[~scalar]] = len(words) + np.arange(len(begins))
        index[first[scalar]] = len(words) + len(begins) + np.arange(len(by_hand))
        sizes = np.fromiter((len(v) // 4 for v in values), np.int64, len(values))
        starts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(values), "<u4")
        each = sizes[index]
        ends = np.cumsum(each)
        places = np.repeat(starts[index] - (ends - each), each) + np.arange(int(ends[-1]))
        return ids[places], np.add.reduceat(each, first)


def encoded_cuts(text: str, known: dict[str, bytes | None], encode: Callable[[str], bytes]) -> Iterator[bytes]:
    """``encode`` of a text, cut before single spaces that follow a character other than white space.

    What a cut gives is kept in ``known`` by the word after the space; a word that is empty
    or ends in white space is kept as None, as it can't be cut from what follows.
    """
    words = text.split(" ")
    n = len(words)

    def joined(i: int) -> int:
        """Where the cut that begins with word i ends."""
        while i + 1 < n and (not words[i] or words[i][-1].isspace()):
            i += 1
        return i + 1

    i = joined(0)
    yield encode(" ".join(words[:i]))
    get = known.get
    while i < n:
        word = words[i]
        found = get(word, known)
        if found is known:  # not seen before
            if len(known) > KEPT_WORDS // 4:
                known.clear()
            found = None if not word or word[-1].isspace() else encode(" " + word)
            if len(word) <= LONGEST_KEPT:
                known[word] = found
        if found is None:
            end = joined(i)
            yield encode(" " + " ".join(words[i:end]))
            i = end
        else:
            yield found
            i += 1
