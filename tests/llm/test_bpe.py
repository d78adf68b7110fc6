import base64
import hashlib
import random
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from blockfee.llm import bpe, cuts
from blockfee.llm.queries import op2_byte_bpe

from .data import SF_DIR, TEXTS, documents, table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
THEIRS = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OURS = bpe.TextEncoder(RANKS, public_tokenizers.PATTERN)


def ids(text: str) -> list[int]:
    """By both ways, which must agree."""
    one = list(array("I", OURS.encode_one(text)))
    many, counts = OURS.encode(pa.array(["first", text, None, text]))
    assert counts.tolist()[1:] == [len(one), 0, len(one)]
    assert many.tolist() == THEIRS.encode_ordinary("first") + one + one
    return one


def test_ranks_are_read_as_written():
    with open(PATH, "rb") as lines:
        token, rank = next(lines).split()
    assert RANKS[base64.b64decode(token)] == int(rank)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_as_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids(text) == THEIRS.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeinrst'\n \t é1!漢", max_size=80))
def test_same_ids_where_pieces_are_hard_to_cut(text):
    assert ids(text) == THEIRS.encode_ordinary(text)


def test_long_pieces_and_dropped_states(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_STEPS", 50)
    monkeypatch.setattr(cuts, "KEPT_WORDS", 5)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 20)
    chance = random.Random(5)
    for size in (1, 33, 700, 5000):
        text = "".join(chance.choice("etaoinshrdlu") for _ in range(size))
        assert ids(text) == THEIRS.encode_ordinary(text)
        assert ids(f"a {text} b {text}") == THEIRS.encode_ordinary(f"a {text} b {text}")


def test_waiting_tokens_are_bounded():
    encoder = bpe.Encoder(RANKS)
    longest = max(map(len, RANKS))
    for word in (b"internationalisation" * 20, b"a" * 500, bytes(range(256))):
        encoder.encode(word)
    assert max(map(len, encoder.states)) <= longest
    assert max(len(waiting) for state in encoder.states for waiting, _, _ in state) <= longest


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 50255), max_size=12))
def test_streaming_decode_of_any_ids(tokens):
    data = b"".join(THEIRS.decode_single_token_bytes(t) for t in tokens)
    decoder = bpe.Decoder({rank: token for token, rank in RANKS.items()})
    assert "".join(decoder.decode(tokens)) == decoder.text(tokens) == data.decode("utf-8", "replace")


def test_a_character_comes_out_with_its_last_byte():
    decoder = bpe.Decoder({0: b"\xf0\x9f", 1: b"\x98\x80x", 2: b"\x98"})
    assert list(decoder.decode([0, 1])) == ["", "\U0001f600x", ""]
    assert list(decoder.decode([0, 2])) == ["", "", "�"]


def test_odd_rows(spark):
    got = bpe.decoded(bpe.encoded(documents(spark), PATH, public_tokenizers.PATTERN), PATH).collect()
    assert len(got) == len(TEXTS)
    want = [(i, t or "", THEIRS.encode_ordinary(t or "")) for i, t in TEXTS]
    key = repr
    assert sorted([(r.doc_id, r.text, list(r.ids)) for r in got], key=key) == sorted(want, key=key)
    assert bpe.encoded(documents(spark, []), PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    rows = op2_byte_bpe(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        tokens = THEIRS.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(tokens)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, tokens)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_every_byte_needs_a_token():
    with pytest.raises(ValueError):
        bpe.Encoder({b"a": 0})


def test_decoding_columns_of_any_ids():
    """Rows that begin and end within characters, among whole ones; a row's bytes never meet the next row's."""
    chance = np.random.default_rng(2)
    decoder = bpe.Decoder({rank: token for token, rank in RANKS.items()})
    broken = [r for t, r in RANKS.items() if bpe._whole_text(t) is None]
    for _ in range(50):
        sizes = chance.integers(0, 6, 40)
        ids = np.where(chance.random(sizes.sum()) < 0.5, chance.choice(broken, sizes.sum()), chance.integers(0, len(RANKS), sizes.sum()))
        starts = np.concatenate(([0], np.cumsum(sizes)))
        want = [
            b"".join(THEIRS.decode_single_token_bytes(int(t)) for t in ids[a:b]).decode("utf-8", "replace")
            for a, b in zip(starts, starts[1:])
        ]
        assert decoder.columns(ids, starts).to_pylist() == want
    assert decoder.columns(np.zeros(0, np.int64), np.array([0])).to_pylist() == []


def test_one_long_piece_is_kept_within_bounds(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_STEPS", 1000)
    encoder = bpe.Encoder(RANKS)
    chance = np.random.default_rng(4)
    text = "".join(map(chr, chance.integers(0x4E00, 0x9FA5, 4000)))
    assert list(encoder.encode(text.encode())) == THEIRS.encode_ordinary(text)
    assert encoder.kept <= 1000 and len(encoder.states) <= 1002


def test_long_words_are_not_kept():
    encoder = bpe.TextEncoder(RANKS, public_tokenizers.PATTERN)
    texts = [f"a {chr(0x4E00 + k) * 500} b {chr(0x4E00 + k) * 500}." for k in range(50)]
    for text in texts:
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == THEIRS.encode_ordinary(text)
    assert sum(len(w) > cuts.LONGEST_KEPT for w in encoder.words) <= 2


def test_how_much_is_kept_changes_no_ids(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, "documents").limit(300)
    few, usual = (bpe.encoded(docs, path, public_tokenizers.PATTERN, kept=k).orderBy("doc_id").collect() for k in (20, None))
    assert few == usual
