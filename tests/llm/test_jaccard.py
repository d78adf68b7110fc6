import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from blockfee.llm import jaccard
from blockfee.llm.graph import connected
from blockfee.llm.jaccard import Rule

from .data import TEXTS, documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            old, new = group[a], group[b]
            group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for (i, _), g in zip(rows, group, strict=True):
        least[g].append(i)
    named = {g: min((i for i in ids if i is not None), default=None) for g, ids in least.items()}
    return sorted([(i, len(s), named[g]) for (i, _), s, g in zip(rows, sets, group, strict=True)], key=repr)


def run(spark, rows, **more):
    return sorted([tuple(r) for r in jaccard.components(documents(spark, rows), **more).collect()], key=repr)


def near_copies(seed, sizes, copies, words=40):
    """Documents of several sizes, each with changed copies, some of them copies of copies."""
    chance = random.Random(seed)
    rows = []
    for size in sizes:
        base = [f"w{chance.randrange(words)}" for _ in range(size)]
        for _ in range(copies):
            text = list(base)
            for _ in range(chance.randrange(1 + size // 25)):
                text[chance.randrange(len(text))] = f"x{chance.randrange(9)}"
            if chance.random() < 0.3:
                text = text[: max(1, len(text) - chance.randrange(1 + size // 10))]
            if chance.random() < 0.2:
                base = text
            rows.append((len(rows), " ".join(text)))
    chance.shuffle(rows)
    return rows


def test_odd_rows(spark):
    assert run(spark, TEXTS) == brute(TEXTS)


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize(("list_rows", "bound"), [(jaccard.LIST_ROWS, None), (1, 0), (jaccard.LIST_ROWS, 24)])
def test_like_brute_force(spark, monkeypatch, list_rows, bound):
    """By lists that a task holds, by split lists, and by subsets as far as they go."""
    if bound is not None:
        monkeypatch.setattr(jaccard, "light_bound", lambda *_: bound)
    sizes = [3, 4, 5, 6, 8, 9, 9, 10, 11, 12, 13, 14, 15, 16, 18, 22, 24, 26, 30, 50, 90, 200]
    rows = near_copies(4, sizes, 9)
    assert run(spark, rows, list_rows=list_rows) == brute(rows)


def test_without_leaders_no_link_is_lost(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_leaders", lambda classes: classes.limit(0).selectExpr("class a", "class b"))
    rows = near_copies(8, [12, 30, 60, 90], 12)
    assert run(spark, rows) == brute(rows)


def test_lists_of_near_copies_make_pairs_in_proportion(spark, monkeypatch):
    """Of lists alone, without leaders: a group's members aren't all compared with each other."""
    compared = []

    def possible(pairs, classes, rule, whole=jaccard._possible):
        compared.append(pairs.count())
        return whole(pairs, classes, rule)

    monkeypatch.setattr(jaccard, "_leaders", lambda classes: classes.limit(0).selectExpr("class a", "class b"))
    monkeypatch.setattr(jaccard, "_possible", possible)
    chance, made = random.Random(6), []
    for copies in (150, 600):
        rows = [(i, [f"w{k}" for k in range(60)]) for i in range(copies)]
        for i, words in rows:
            words[chance.randrange(60)] = f"x{i}"
        rows = [(i, " ".join(words)) for i, words in rows]
        compared.clear()
        assert run(spark, rows) == brute(rows)
        made.append(sum(compared))
    assert made[1] < 8 * made[0] and made[1] < copies * (copies - 1) / 4


def test_links_at_the_limit(spark):
    words = [f"w{i}" for i in range(13)]
    # 9 and 8 of 9 and 10 shingles: exactly 0.8 of the union, then just below.
    rows = [(1, " ".join(words)), (2, " ".join([*words[:12], "x", "y"])), (3, " ".join([*words[:11], "u", "v", "z"]))]
    assert run(spark, rows) == brute(rows)


def test_rule():
    rule = Rule(80)
    for n in range(1, 60):
        for m in rule.partners(n):
            o = rule.overlap(n, m)
            assert 100 * o >= 80 * (n + m - o) and 100 * (o - 1) < 80 * (n + m - o + 1)
        assert n in rule.partners(n) and 1 <= rule.index(n) <= rule.probe(n)


def test_bitmaps_never_bound_too_low():
    chance = np.random.default_rng(2)
    for n, m in ((5, 7), (60, 80), (64, 65), (300, 1200), (1000, 1000)):
        shared = chance.integers(0, 2**63, min(n, m) // 2).astype(np.uint64)
        a, b = (np.unique(np.concatenate([shared, chance.integers(0, 2**63, k).astype(np.uint64)])) for k in (n, m))
        apart = len(np.setxor1d(a, b))
        assert jaccard._apart(jaccard._bitmap(a), jaccard._bitmap(b)) <= apart


def test_boundary_follows_cost():
    rule = Rule(80)
    sizes = dict.fromkeys(range(1, 25), 100)
    cheap, dear = jaccard.light_bound(sizes, 0.0, rule), jaccard.light_bound(sizes, 3.0, rule)
    assert 0 <= cheap < dear <= jaccard.LIGHT_MOST


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 400)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (900, 900)], "a long, b long")
    got = {r.node: r.root for r in connected(links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(200, 400)}, 900: 900}
