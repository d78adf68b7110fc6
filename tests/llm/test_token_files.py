import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from blockfee.llm import token_files
from blockfee.llm.queries import op1_token_files

from .data import SF_DIR, TEXTS, documents, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
THEIRS = Tokenizer.from_file(PATH)


def ids(text):
    return [*THEIRS.encode(text or "", add_special_tokens=False).ids, 2]


def checksum(tokens):
    return zlib.crc32(np.array(tokens, "<u4").tobytes())


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, "documents").collect())
    start, want = 0, []
    for doc_id, text in docs:
        tokens = ids(text)
        want.append((doc_id, start, len(tokens), checksum(tokens)))
        start += len(tokens)
    assert sorted(tuple(r) for r in op1_token_files(spark, SF_DIR).collect()) == want


def test_sequences_and_masks(spark):
    manifest = token_files.write_token_files(documents(spark), PATH, end_id=2, length=16)
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    stream = [t for _, text in order for t in ids(text)]
    shards = sorted(manifest.collect())
    assert sum(s.n_docs for s in shards) == len(TEXTS) and sum(s.n_tokens for s in shards) == len(stream)
    read = []
    for s in shards:
        file = token_files.TokenFile(s.folder, s.name)
        masked = []
        for i in reversed(range(s.n_sequences)):
            tokens, mask = file.sequence(i)
            assert len(tokens) == len(mask) == 16
            masked.append(tokens[np.array(mask.to_pylist())].tolist())
        whole = [t for part in reversed(masked) for t in part]
        assert len(whole) == s.n_tokens
        read += whole
    assert read == stream


def test_sequences_are_views_of_the_file(spark):
    manifest = token_files.write_token_files(documents(spark), PATH, end_id=2, length=8)
    s = manifest.orderBy("n_tokens").collect()[-1]
    file = token_files.TokenFile(s.folder, s.name)
    tokens, _ = file.sequence(0)
    assert not tokens.flags.owndata and tokens.dtype == np.uint16
    assert sum(len(x) for x in file.ids(3, s.n_tokens - 3)) == s.n_tokens - 3


def test_odd_rows(spark):
    manifest = token_files.write_token_files(documents(spark), PATH, end_id=2)
    got = token_files.read_documents(manifest).collect()
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for doc_id, text in order:
        tokens = ids(text)
        want.append((doc_id, start, len(tokens), checksum(tokens)))
        start += len(tokens)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_no_rows(spark):
    manifest = token_files.write_token_files(documents(spark, []), PATH, end_id=2)
    assert manifest.count() == 0
    assert token_files.read_documents(manifest).count() == 0
