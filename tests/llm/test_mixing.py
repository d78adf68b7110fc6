import re

import pytest

from blockfee.llm import mixing

from .data import TEXTS, documents


def brute_targets(sizes: dict, rounds=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full: set = set()
    budget = sum(sizes.values())
    while True:
        left = budget - sum(rounds * sizes[s] for s in full)
        weights = sum(weight[s] for s in order if s not in full)
        target = {s: rounds * sizes[s] if s in full else weight[s] * left / weights for s in order}
        above = {s for s in order if s not in full and target[s] > rounds * sizes[s]}
        if not above:
            return target
        full |= above


def mixture(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return mixing.mixed(docs).collect()


@pytest.mark.parametrize(
    "words",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1000, "b": 10, "c": 10, None: 5},
        {"é": 40, "Z": 900, "z": 3, "0": 70, "": 50},
        {"a": 50, "b": 0},
    ],
)
def test_targets_and_what_is_taken(spark, words):
    rows, n = [], 0
    for source, total in words.items():
        for k in range(total):
            rows.append((n, source, " ".join(["w"] * (1 + k % 2))))
            n += 1
        if not total:
            rows.append((n, source, "  "))
            n += 1
    got = mixture(spark, rows)
    text = {r[0]: r for r in rows}
    sizes: dict = {}
    for _, source, t in rows:
        sizes[source] = sizes.get(source, 0) + len(t.split())
    target, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    assert len(got) == len(rows)
    for r in got:
        source = text[r.doc_id][1]
        assert r.size == len(text[r.doc_id][2].split()) and r.source_size == sizes[source]
        assert r.target == pytest.approx(target[source], abs=1e-6)
        assert r.taken in {k * r.size for k in range(4)}
        taken[source] += r.taken
    assert sum(taken.values()) <= sum(sizes.values())
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 6


def test_reruns_agree_and_no_document_is_far_ahead(spark):
    rows = [(i, f"s{i % 5}", "w " * (1 + i % 7)) for i in range(500)]
    a, b = (sorted(map(tuple, mixture(spark, rows))) for _ in range(2))
    assert a == b
    # Rounds follow each other: documents of one source differ by one at most.
    for source in range(5):
        times = {r[4] // r[1] for r in a if r[0] % 5 == source}
        assert max(times) - min(times) <= 1


def test_odd_rows(spark):
    got = mixing.mixed(documents(spark)).collect()
    assert len(got) == len(TEXTS)
    sizes = sorted(len(re.findall(mixing.WORD, t or "")) for _, t in TEXTS)
    assert sorted(r.size for r in got) == sizes
    assert all(0 <= r.taken <= 3 * r.size for r in got)


def test_no_rows_and_no_words(spark):
    assert mixture(spark, []) == []
    assert [tuple(r) for r in mixture(spark, [(1, "a", None)])] == [(1, 0, 0, 0.0, 0)]
