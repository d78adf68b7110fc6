from collections import defaultdict

import numpy as np
import pytest

from blockfee.llm import line_dedup, line_index
from blockfee.llm.line_index import LineIndex

from .data import TEXTS, documents

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=20, min_docs=3):
    """Rows of an id are one document; each row without one is its own, smaller than any."""

    def key(line):
        k = line.strip(WHITE).translate(LOWER)
        return k if len(k) >= min_chars else None

    def rank(doc_id):
        return -(2**63) if doc_id is None else doc_id

    held = defaultdict(list)
    for i, text in rows:
        for k in {key(line) for line in (text or "").split("\n")} - {None}:
            if i is None or i not in held[k]:
                held[k].append(rank(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stays = [x for x in lines if (k := key(x)) is None or len(held[k]) < min_docs or max(held[k]) == rank(i)]
        out.append((i, "\n".join(stays), len(lines), len(lines) - len(stays)))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    docs = documents(spark, rows)
    got = line_dedup.without_repeated_lines(docs, counts=("before", "lost"), **more)
    assert got.columns == [*docs.columns, "before", "lost"]
    return sorted([(r.doc_id, r.text, r.before, r.lost) for r in got.collect()], key=repr)


def test_odd_rows(spark):
    want = brute(TEXTS)
    assert sum(r[3] for r in want) > 0
    assert run(spark, TEXTS) == want


def test_repeated_and_missing_ids(spark):
    line = "one line that is long enough to count"
    rows = [(1, line), (1, line), (2, line), (2, line + "\nown"), (3, "x")]
    assert run(spark, rows) == brute(rows) and not any(r[3] for r in run(spark, rows))
    rows += [(9, line), (9, "another line that is long enough"), (None, line)]
    assert run(spark, rows) == brute(rows)
    shared = "\n".join(f"shared line {k} of them, quite long" for k in range(5))
    rows = [(None, f"{shared}\nnumber {i} of the rows without an id") for i in range(200)] + [(None, shared)] * 50
    assert run(spark, rows) == brute(rows)
    rows += [(7, shared), (-5, line), (-5, shared)]
    got = run(spark, rows)
    assert got == brute(rows) and sum(r[3] for r in got) == 5 * 251


def test_counts_replace_columns_of_their_names(spark):
    docs = documents(spark)
    got = line_dedup.without_repeated_lines(docs, counts=("n", "row"))
    assert sorted(got.columns) == sorted(docs.columns)


def test_no_rows_and_nothing_shared(spark):
    assert run(spark, []) == []
    rows = [(1, "a line of its own, quite long"), (2, None)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("shard_lines", [1 << 18, 7])
def test_many_shards_and_a_hot_line(spark, monkeypatch, shard_lines):
    monkeypatch.setattr(line_dedup, "SHARD_LINES", shard_lines)
    chance = np.random.default_rng(3)
    lines = [f"a shared line with number {i}, long enough" for i in range(60)]
    rows = [
        (i, "\n".join(["The line in every document, of all"] + [lines[k] for k in chance.integers(0, 60, 6)] + [f"own {i} " * 4]))
        for i in range(300)
    ]
    assert run(spark, rows) == brute(rows)


def test_code_points_count(spark):
    rows = [(i, "é" * 19 + "\n" + "é" * 20 + "\n" + " " + "x" * 19 + " ") for i in range(4)]
    assert run(spark, rows) == brute(rows)


def test_perfect_hash():
    chance = np.random.default_rng(1)
    high, low = (chance.integers(0, 2**63, 50_000).astype(np.uint64) for _ in range(2))
    index = LineIndex.build(high, low, np.arange(50_000), -np.arange(50_000))
    copy = LineIndex.from_bytes(index.to_bytes())
    number = copy.find(high.view(np.int64), low.view(np.int64))
    assert sorted(number) == list(range(50_000))
    assert (copy.counts[number] == np.arange(50_000)).all() and (copy.last[number] == -np.arange(50_000)).all()
    others = chance.integers(0, 2**63, (2, 50_000)).astype(np.int64)
    assert (copy.find(*others) == -1).all()


def test_keys_that_no_level_tells_apart(monkeypatch):
    monkeypatch.setattr(line_index, "_LEVELS", 0)
    high, low = np.array([5, 5, 4], np.uint64), np.array([1, 2, 1], np.uint64)
    index = line_index.LineIndex.build(high, low, np.array([10, 20, 30]), np.array([0, 0, 0]))
    found = index.find(np.array([5, 5, 4, 6], np.int64), np.array([1, 2, 1, 1], np.int64))
    assert index.counts[found[:3]].tolist() == [10, 20, 30] and found[3] == -1
