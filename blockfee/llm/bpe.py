"""Byte-level BPE: merges as a lazily determinised transducer, and streaming decoding.

Tokens of a piece are valid exactly if each token merges to itself and each pair of
neighbours stays two tokens when merged on its own: merging always takes the lowest
rank, then the leftmost place, and that choice is the same within a window as in the
whole piece as long as nothing crosses the window's edge. So encoding is a path through
a nondeterministic transducer whose states are (last token, bytes since) and which
emits a token wherever a valid pair ends.

``Encoder`` determinises it while it reads: a state is the set of paths still open, each
with the tokens that it alone would emit. What all open paths share is emitted at once;
the rest waits. Every path ends within the length of the longest token, which bounds how
far emission looks ahead. States and steps are made when first needed and kept; beyond a
limit they are dropped and made anew, also within a piece.

``Decoder`` turns token ids back into text piece by piece with a state machine over
incomplete UTF-8 sequences. For whole columns of ids, tokens that begin and end between
characters are read off a table, as they keep the machine at its start; it runs
over what is between them.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .cuts import KnownCuts
from .words import slices

#: Steps of the encoder and decoder, and pairs of tokens, that are kept.
KEPT_STEPS = 300_000
KEPT_PAIRS = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


#: Above any rank.
_NONE = 1 << 62


class Encoder:
    """Encodes pieces of bytes by the ranks of their merges."""

    def __init__(self, ranks: dict[bytes, int], kept: int | None = None) -> None:
        #: How many steps and pairs are kept, instead of ``KEPT_STEPS`` and ``KEPT_PAIRS``.
        self.most = kept
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte needs a token")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        # All beginnings of tokens as numbered nodes; node 0 is the empty one.
        self.children: dict[int, int] = {}
        self.token_at = [-1]
        self.inner = [True]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = True
                key = node << 8 | byte
                if (child := self.children.get(key)) is None:
                    child = self.children[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = child
            self.token_at[node] = rank
        self.edges: dict[int, tuple[bool, int, int, list[bytes], list[bytes]]] = {}
        self.pairs: dict[int, bool] = {}
        self._forget()

    def merge(self, piece: bytes, seen: list | None = None) -> tuple[int, ...]:
        """The plain rule, for short strings: join the pair of lowest rank, leftmost first.

        ``seen`` gets, for each join, its rank and the outermost parts after it.
        """
        get = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        joins = [get(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while joins and (least := min(joins)) < _NONE:
            at = joins.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joins[at]
            if at:
                joins[at - 1] = get(parts[at - 1] + parts[at], _NONE)
            if at < len(joins):
                joins[at] = get(parts[at] + parts[at + 1], _NONE)
            if seen is not None:
                seen.append((least, parts[0], parts[-1]))
        return tuple([self.ranks[p] for p in parts])

    def _forget(self) -> None:
        # A state: under -1 its paths, (tokens to come, last token or -1, node since) for each open one, oldest
        # first, and under each byte met so far where that leads and what is certain by then.
        paths = (((), -1, 0),)
        self.start: dict = {-1: paths}
        self.states = {paths: self.start}
        self.kept = 0

    def _edge(self, token: int) -> tuple[bool, int, int, list[bytes], list[bytes]]:
        """How a token's bytes merge: whether to it alone, the ranks that first join its first and its last byte,
        and all parts that stand at its beginning and end meanwhile."""
        if (known := self.edges.get(token)) is None:
            text, seen = self.bytes_of[token], []
            whole = self.merge(text, seen) == (token,)
            first, last = text[:1], text[-1:]
            left = next((rank for rank, a, _ in seen if a != first), _NONE)
            right = next((rank for rank, _, b in seen if b != last), _NONE)
            lefts = list(dict.fromkeys([first, *(a for _, a, _ in seen)]))
            rights = list(dict.fromkeys([last, *(b for _, _, b in seen)]))
            known = self.edges[token] = (whole, left, right, lefts, rights)
        return known

    def _follows(self, last: int, token: int) -> bool:
        """Whether a token may stand behind another one."""
        key = (last + 1) << 32 | token
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) >= (self.most or KEPT_PAIRS):
                self.pairs.clear()
            known = self.pairs[key] = self._stay_apart(last, token)
        return known

    def _stay_apart(self, last: int, token: int) -> bool:
        whole, left, _, lefts, _ = self._edge(token)
        # A token that its own bytes don't merge to can only stand for a whole piece.
        if not whole or last < 0:
            return whole
        _, _, right, _, rights = self._edge(last)
        ranks = self.ranks
        # The bytes at the seam join before either joins inwards.
        if ranks.get(rights[0] + lefts[0], _NONE) < min(left, right):
            return False
        # Nothing that ever meets at the seam can join.
        if not any(a + b in ranks for a in rights for b in lefts):
            return True
        return self.merge(self.bytes_of[last] + self.bytes_of[token]) == (last, token)

    def _step(self, state: dict, byte: int) -> tuple[dict, tuple[int, ...]]:
        """Where a byte leads, and what is certain by then."""
        ahead, ended = [], None
        children, token_at, inner = self.children, self.token_at, self.inner
        for waiting, last, node in state[-1]:
            child = children.get(node << 8 | byte)
            if child is None:
                continue
            token = token_at[child]
            # One path ends here at most: the bytes so far have one encoding.
            if token >= 0 and ended is None and self._follows(last, token):
                ended = ((*waiting, token), token, 0)
            if inner[child]:
                ahead.append((waiting, last, child))
        if ended is not None:
            ahead.append(ended)
        certain = ahead[0][0]
        n = len(certain)
        for waiting, _, _ in ahead:
            while waiting[:n] != certain[:n]:
                n -= 1
        if n:
            certain = certain[:n]
            ahead = [(waiting[n:], last, node) for waiting, last, node in ahead]
        else:
            certain = ()
        key = tuple(ahead)
        if self.kept >= (self.most or KEPT_STEPS):
            # Goes on from a state made anew, so that nothing holds on to the old ones.
            self._forget()
            state = {}
        if (following := self.states.get(key)) is None:
            following = self.states[key] = {-1: key}
        found = state[byte] = (following, certain)
        self.kept += 1
        return found

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """The ids of a piece; a piece that is a token is that token."""
        if (whole := self.ranks.get(piece)) is not None:
            return (whole,)
        if not piece:
            return ()
        out: list[int] = []
        state = self.start
        for byte in piece:
            state, emitted = state.get(byte) or self._step(state, byte)
            if emitted:
                out += emitted
        # At the end the path that stands at the edge of a token is the encoding.
        waiting, _, node = state[-1][-1]
        if node:
            raise AssertionError("every piece has an encoding")
        out += waiting
        return tuple(out)


class TextEncoder(KnownCuts):
    """Texts to ids: pieces by a pattern, each encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, kept: int | None = None) -> None:
        super().__init__(self._encode_many, kept)
        self.encoder = Encoder(ranks, kept)
        self.pattern = regex.compile(pattern)
        #: Whether the pattern keeps a space and letters of any script together.
        letters = " aZßéжλ漢あ"
        self.one_piece = self.pattern.findall(letters) == [letters]

    def _encode_many(self, texts: list[str]) -> list[bytes]:
        encode, pieces, one = self.encoder.encode, self.pattern.findall, self.one_piece
        return [
            array(
                "I",
                encode(text.encode())
                if one and text[:1] == " " and text[1:].isalpha()
                else [i for p in pieces(text) for i in encode(p.encode())],
            ).tobytes()
            for text in texts
        ]


#: Lowest and highest value of the byte after a leading byte, where not 80 to BF.
_SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


def _whole_text(data: bytes) -> str | None:
    try:
        return data.decode()
    except UnicodeDecodeError:
        return None


class Decoder:
    """Token ids to text, a token at a time; the state is an incomplete UTF-8 sequence.

    A sequence that can't become valid gives U+FFFD once, as soon as that is certain.
    """

    def __init__(self, tokens: dict[int, bytes]) -> None:
        self.tokens = tokens
        self.steps: dict[tuple[bytes, int], tuple[bytes, str]] = {}
        #: Texts of tokens that begin and end between characters: they keep the machine at its start.
        self.plain = {token: text for token, data in tokens.items() if (text := _whole_text(data)) is not None}
        self.state = b""
        size = max(tokens, default=-1) + 1
        #: The same for columns of ids: which ids those are, and the texts of all ids, empty for others.
        self.is_plain = np.zeros(size, bool)
        self.is_plain[list(self.plain)] = True
        self.texts = [self.plain.get(i, "") for i in range(size)]

    def finish(self) -> str:
        text, self.state = "�" if self.state else "", b""
        return text

    @staticmethod
    def _read(state: bytes, more: bytes) -> tuple[bytes, str]:
        out: list[str] = []
        for byte in more:
            if state:
                low, high = _SECOND.get(state[0], (0x80, 0xBF)) if len(state) == 1 else (0x80, 0xBF)
                if low <= byte <= high:
                    state += bytes([byte])
                    needed = 2 if state[0] < 0xE0 else 3 if state[0] < 0xF0 else 4
                    if len(state) == needed:
                        out.append(state.decode())
                        state = b""
                    continue
                out.append("�")
                state = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                state = bytes([byte])
            else:
                out.append("�")
        return state, "".join(out)

    def text(self, ids: list[int]) -> str:
        """The text of all ids, from the machine's start."""
        return self.columns(np.array(ids, np.int64), np.array([0, len(ids)]))[0].as_py()

    def columns(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The texts of rows of ids, one after the other; ``starts`` has one entry more than there are rows."""
        at = ids.astype(np.int64)
        others = ~self.is_plain[at]
        if others.any():
            # The machine runs over stretches of other tokens; a row's end ends a stretch.
            begins = others.copy()
            begins[1:] &= ~others[:-1]
            inner = starts[:-1][starts[:-1] < len(at)]
            begins[inner] |= others[inner]
            first = np.flatnonzero(begins)
            number = np.cumsum(begins)
            last = np.searchsorted(number[others], np.arange(1, len(first) + 1), side="right")
            tokens = ids[others].tolist()
            more, known, low = [], {}, 0
            for high in last.tolist():
                stretch = tuple(tokens[low:high])
                if (text := known.get(stretch)) is None:
                    text = known[stretch] = "".join(self.decode(stretch))
                more.append(text)
                low = high
            at[others] = len(self.texts)  # an empty text, but at the beginning of a stretch
            at[first] = len(self.texts) + 1 + np.arange(len(first))
            table = pa.array([*self.texts, "", *more], pa.large_string())
        else:
            table = pa.array(self.texts, pa.large_string())
        joined = table.take(pa.array(at))
        _, offsets, data = joined.buffers()
        offsets = np.frombuffer(offsets, np.int64)[: len(at) + 1]
        bounds = pa.py_buffer(np.ascontiguousarray(offsets[starts]))
        return pa.LargeStringArray.from_buffers(len(starts) - 1, bounds, data if data is not None else pa.py_buffer(b""))

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """The texts of a stream of ids, one for each id and one for its end."""
        get, tokens = self.steps.get, self.tokens
        for token in ids:
            step = get((self.state, token))
            if step is None:
                if len(self.steps) >= KEPT_STEPS:
                    self.steps.clear()
                step = self.steps[self.state, token] = self._read(self.state, tokens[token])
            self.state, text = step
            yield text
        yield self.finish()


#: Bytes of text, and of ids, that a task works on at once.
TEXT_SLICE, ID_SLICE = 8 << 20, 2 << 20


_TOKENS = "doc_id long, n_tokens long, ids array<int>"


def _encoded(part: pa.RecordBatch, encoder: TextEncoder) -> pa.RecordBatch:
    ids, counts = encoder.encode(part.column("text"))
    offsets = np.concatenate(([0], np.cumsum(counts)))
    return pa.record_batch(
        {
            "doc_id": part.column("doc_id"),
            "n_tokens": pa.array(counts, pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32))),
        }
    )


def _with_text(part: pa.RecordBatch, decoder: Decoder) -> pa.RecordBatch:
    lists = part.column("ids")
    starts = lists.offsets.to_numpy().astype(np.int64)
    ids = lists.values.to_numpy(zero_copy_only=False)[starts[0] : starts[-1]]
    return part.append_column("text", decoder.columns(ids, starts - starts[0]).cast(pa.string()))


def encoded(docs: DataFrame, ranks_path: str, pattern: str, kept: int | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` of every row's whole text.

    ``kept`` bounds how many words, steps and pairs each a worker keeps, where it should
    take less memory than by default and may take longer; the ids are the same.

    ``ranks_path`` is read where the tasks run. A null or empty text has no ids; equal
    rows give equal rows; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # With bounds of its own it goes with its task, and leaves its memory to other stages.
        encoder = text_encoder(ranks_path, pattern) if kept is None else TextEncoder(read_ranks(ranks_path), pattern, kept)
        pa.default_memory_pool().release_unused()  # of stages before, in the same worker
        for batch in batches:
            for part in slices(batch, size=TEXT_SLICE):
                yield _encoded(part, encoder)

    return docs.select("doc_id", "text").mapInArrow(run, _TOKENS)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` and ``decoded`` in one pass: a task's ids go through the decoder where they are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = text_encoder(ranks_path, pattern), text_decoder(ranks_path)
        for batch in batches:
            for part in slices(batch, size=TEXT_SLICE):
                for tokens in slices(_encoded(part, encoder), "ids", size=ID_SLICE):
                    yield _with_text(tokens, decoder)

    return docs.select("doc_id", "text").mapInArrow(run, f"{_TOKENS}, text string")


def decoded(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """The columns of ``tokens`` (as ``encoded`` gives them) and the ``text`` that their ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = text_decoder(ranks_path)
        for batch in batches:
            for part in slices(batch, "ids", size=ID_SLICE):
                yield _with_text(part, decoder)

    return tokens.mapInArrow(run, f"{_TOKENS}, text string")


@cache
def text_encoder(ranks_path: str, pattern: str) -> TextEncoder:
    """One for each Python worker, so that steps and pieces stay from task to task."""
    return TextEncoder(read_ranks(ranks_path), pattern)


@cache
def text_decoder(ranks_path: str) -> Decoder:
    return Decoder({rank: token for token, rank in read_ranks(ranks_path).items()})
