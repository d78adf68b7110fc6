import hashlib
import re

import pytest
from pyspark.sql import functions as F

from blockfee.llm import fim
from blockfee.llm.oracles import ORACLES
from blockfee.llm.queries import op12_fill_middle
from tests.oracle import expected

from .data import TEXTS, documents


def brute(doc_id, text, fim_percent=100, marks=fim.SENTINELS):
    text = text or ""
    digits = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in marks) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), marks[1] + s + marks[0] + p + marks[2] + m
    return n, "psm", len(p), len(m), marks[0] + p + marks[1] + s + marks[2] + m


def check(docs, rows, **options):
    found = fim.transformed(docs, **options)
    marks = options.get("sentinels", fim.SENTINELS)
    back = fim.restored(F.col("fim.output"), F.col("fim.form"), marks)
    got = found.select("doc_id", "text", "fim.*", back.alias("back")).collect()
    want = [
        (i, t, *brute(i, t, options.get("fim_percent", 100), marks), t or "") for i, t in rows
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_odd_rows(spark):
    rows = [*TEXTS, (20, "a <P> b\nc"), (21, "x<M>"), (22, "\n\n\n"), (23, "$1\\1<\n<\n P>S>"), (24, "a\r\nb\rc\n"),
            (25, "\U0001f600\n漢\n\n字"), (26, "<\nP>\n<S"), (27, "{2}+\n(\n[^")]
    check(documents(spark, rows), rows)
    check(documents(spark, rows), rows, fim_percent=40)


def test_long_texts_cost_no_stack(spark):
    rows = [(i, t) for i in range(6) for t in ("a\n" * 300_000, "x" * 1_500_000, ("y" * 400_000 + "\n") * 3 + "z")]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_sentinels(spark):
    rows = [(i, "one\n$two\nthree\\\nfour |.\n") for i in range(20)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, sentinels=("[$pre|]", "[\\suf.]", "[mid+]"))
    for bad in (("<P>", "", "<M>"), ("aba", "c", "d"), ("<a", "b<", "c"), ("<P>", "<P><S>", "<M>"), ("x\n", "y", "z")):
        with pytest.raises(ValueError):
            fim.transformed(documents(spark), sentinels=bad)


def test_columns_and_empty_tables(spark):
    docs = documents(spark).withColumn("fim", F.lit(1)).withColumn("row", F.lit(2)).withColumn("h1", F.lit(3))
    found = fim.transformed(docs)
    assert sorted(found.columns) == sorted(docs.columns) and found.count() == len(TEXTS)
    assert {r.h1 for r in found.collect()} == {3}
    assert fim.transformed(docs.limit(0)).count() == 0


def test_one_stage_without_python(spark):
    plan = op12_fill_middle(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_production_query_on_a_larger_table(spark):
    rows = sorted(map(tuple, op12_fill_middle(spark, "/root/testdata/sf0.1").select(
        "doc_id", "form", "middle_chars", "n", "output_sha256", "prefix_chars", "restored_sha256").collect()), key=repr)
    assert rows == expected(ORACLES["op12_fill_middle"], "/root/testdata/sf0.1")[1]
