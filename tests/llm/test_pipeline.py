import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from blockfee.llm import bpe, mixing
from blockfee.llm.shared import stored

from .data import SF_DIR, documents, table
from .test_jaccard import brute as brute_groups
from .test_line_dedup import brute as brute_lines
from .test_mixing import brute_targets


def test_stages():
    assert [f for _, f in corpus_pipeline.STAGES] == [
        corpus_pipeline.good_quality,
        corpus_pipeline.no_shared_lines,
        corpus_pipeline.one_of_each_group,
        corpus_pipeline.mixed_sources,
        corpus_pipeline.token_ids,
    ]


def test_each_stage_on_what_the_one_before_kept(spark):
    docs = stored(table(spark, "documents"), "documents")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stored(stage(spark, steps[-1], SF_DIR), name.replace(" ", "-")))
    for step in steps[:-1]:
        assert step.columns == docs.columns
    raw, good, lines, first, mixed, tokens = ([r.asDict() for r in s.collect()] for s in steps)

    labels = {r.doc_id: r.quality for r in table(spark, "labels").collect()}
    kept = {r["doc_id"] for r in good}
    assert all(r in raw for r in good)
    known = [r["doc_id"] for r in raw if r["doc_id"] in labels]
    assert sum((i in kept) == (labels[i] == 1) for i in known) > 0.97 * len(known)

    want = brute_lines([(r["doc_id"], r["text"]) for r in good])
    assert sorted([(r["doc_id"], r["text"]) for r in lines], key=repr) == [x[:2] for x in want]

    rows = [r for r in lines if len(r["text"]) < 3000]
    groups = {i: g for i, _, g in brute_groups([(r["doc_id"], r["text"]) for r in rows])}
    stays = {r["doc_id"] for r in first}
    assert all(r in lines for r in first)
    # Documents of other lengths can link with these only near the limit; most are judged here.
    assert {i for i in groups if i in stays} == {i for i, g in groups.items() if i == g}

    by_id = {r["doc_id"]: r for r in first}
    assert all(by_id[r["doc_id"]] == r for r in mixed)
    words = sum(len(r["text"].split()) for r in first)
    assert 0.95 * words <= sum(len(r["text"].split()) for r in mixed) <= 1.01 * words

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    theirs = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r["doc_id"], theirs.encode_ordinary(r["text"])) for r in mixed)
    assert sorted((r["doc_id"], list(r["ids"])) for r in tokens) == want


@pytest.mark.parametrize("rows", [[], None])
def test_odd_rows(spark, rows):
    docs = documents(spark) if rows is None else documents(spark, rows)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "odd")
    assert docs.columns == ["doc_id", "n_tokens", "ids"]


def kept_of(spark, stage, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _id long")
    got = stage(spark, stored(docs, "rows-given"), SF_DIR)
    assert got.columns == docs.columns
    return sorted((tuple(r) for r in got.collect()), key=repr)


def words(name, n=40):
    return " ".join(f"{name}{i}" for i in range(n))


def test_rows_without_an_id_stay_unless_linked_with_another(spark):
    rows = [
        (None, words("a"), "s", 1),
        (None, words("b"), "s", 2),
        (None, None, "s", 3),
        (None, "", "s", 4),
        (5, words("c"), "s", 5),
        (None, words("c"), "s", 6),
        (None, words("d"), "s", 7),
        (None, words("d"), "s", 7),
    ]
    assert kept_of(spark, corpus_pipeline.one_of_each_group, rows) == sorted(rows[:5] + rows[6:7], key=repr)


def test_one_row_of_a_group_whatever_ids_rows_share(spark):
    rows = [
        (1, words("a"), "s", 1),
        (1, words("a"), "s", 1),
        (1, words("a") + " more", "s", 2),
        (2, words("a"), "s", 3),
        # Its id is the smallest of another group, its own text is linked with that of 0.
        (1, words("b"), "s", 4),
        (0, words("b"), "s", 5),
        # No link: both rows of the id stay.
        (3, words("c"), "s", 6),
        (3, words("d"), "s", 7),
    ]
    kept = kept_of(spark, corpus_pipeline.one_of_each_group, rows)
    assert len(kept) == 4 and set(kept) <= set(rows)
    assert [r for r in kept if r[0] != 1] == [rows[5], rows[6], rows[7]]
    assert [r[1].startswith("a0 ") for r in kept if r[0] == 1] == [True]


def test_the_mix_takes_rows_that_share_an_id_on_their_own(spark):
    rows = [(1, words("a", 10), "s", i) for i in range(30)]
    rows += [(1, words("b", 3), "t", 100), (None, words("c", 5), "t", 101), (None, words("c", 5), "t", 102)]
    rows += [(i, words("d", 4), "u", 200 + i) for i in range(2, 40)]
    rows += [(1, None, "u", 300), (50, "", None, 301)]
    mix = kept_of(spark, corpus_pipeline.mixed_sources, rows)
    assert set(mix) <= set(rows)
    assert max(mix.count(r) for r in rows) <= mixing.ROUNDS
    size = {s: sum(len((r[1] or "").split()) for r in rows if r[2] == s) for s in ("s", "t", "u", None)}
    given = {s: sum(len(r[1].split()) for r in mix if r[2] == s) for s in size}
    assert 0.95 * sum(size.values()) <= sum(given.values()) <= sum(size.values())
    for source, target in brute_targets(size).items():
        assert abs(given[source] - target) <= 20
