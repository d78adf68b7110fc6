import numpy as np
import pyarrow as pa

from blockfee.llm import quality
from blockfee.llm.queries import op5_quality

from .data import SF_DIR, TEXTS, documents, table


def test_query_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in table(spark, "labels", sf_dir).collect()}
    rows = op5_quality(spark, sf_dir).collect()
    assert len(rows) == 10_000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 400
    good = np.array([s for q, s, _ in held if q == 1])
    bad = np.array([s for q, s, _ in held if q == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert np.mean([q == p for q, _, p in held]) > 0.97


def test_reruns_agree(spark):
    a, b = ({r.doc_id: r.score for r in op5_quality(spark, SF_DIR).collect()} for _ in range(2))
    assert a == b


def test_learning_reads_no_held_out_label(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    from blockfee.llm.queries import held_out

    a = quality.train(docs, labels.where(~held_out()))
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end quality")
    b = quality.train(docs, turned.where(~held_out()))
    assert (a == b).all()


def test_shapes_and_repeats():
    assert quality._shape("Hello,") == "Aa," and quality._shape("ABC!!") == "A!!" and quality._shape("x12") == "a0"
    places, offsets = quality.features(pa.array(["a b a", "", None, "a"]))
    assert offsets.tolist() == [0, 3, 3, 3, 4]
    assert places[2, 3 + 2] >= 0 and places[2, 3 + 1] == -1
    # Nothing is carried over from the text before.
    assert (places[3, 2:] == -1).all()
    assert (places[3, :2] == places[0, :2]).all()


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (3, 1), (3, 1)], "doc_id long, quality int")
    weights = quality.train(documents(spark), labels)
    rows = quality.scored(documents(spark), weights).collect()
    assert len(rows) == len(TEXTS)
    scores = [r.score for r in rows]
    assert all(0 <= s <= 1 for s in scores)
    assert len({r.score for r in rows if r.doc_id in (4, 5, 6)}) == 1
    assert len({r.score for r in rows if r.doc_id in (7, 8)}) == 1
    kept = quality.kept(documents(spark), weights, threshold=0.0)
    assert kept.schema == documents(spark).schema and kept.count() == len(TEXTS)


def test_no_rows(spark):
    none = documents(spark, [])
    weights = quality.train(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.scored(none, weights).count() == 0
    assert {r.score for r in quality.scored(documents(spark), weights).collect()} == {0.5}
