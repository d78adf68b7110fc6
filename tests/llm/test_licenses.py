from blockfee.llm import licenses
from blockfee.llm.queries import KNOWN_LICENSES, op6_licenses

from .data import SF_DIR, TEXTS, documents, table

KNOWN = "license string, text string"


def test_canonical_form():
    a = "  Copyright (c) 2019 Someone\n\nPermission is hereby granted, under this LICENCE; the copyright-holder's organisation"
    b = "permission is hereby granted under this license\nthe copyright owner s organization"
    assert licenses.canonical(a) == licenses.canonical(b)
    assert licenses.digest(a) == licenses.digest(b) != licenses.digest("permission")
    assert licenses.digest(None) is licenses.digest("") is licenses.digest(" .,\n(c) 2020 x") is None


def test_a_sentence_on_copyright_stays():
    assert "copyright" in licenses.canonical("Copyright notices must be kept.")


def test_entire_texts_and_lines(spark):
    known = spark.createDataFrame([*KNOWN_LICENSES, ("also-MIT", "released under the MIT Licence"), ("none", None)], KNOWN)
    rows = [
        (1, "RELEASED under the MIT licence!"),
        (2, "Text.\nReleased under the MIT License.\nLicensed under the Apache License, Version 2.0."),
        (3, "This text is released under the MIT License."),
        (4, "© 2020 A\n" + KNOWN_LICENSES[-1][1].replace(". ", ".\n")),
        (5, None),
    ]
    got = {r.doc_id: (r.licenses, r.notices) for r in licenses.scanned(documents(spark, rows), known).collect()}
    assert got[1] == (["MIT", "also-MIT"], ["MIT", "also-MIT"])
    assert got[2] == ([], ["Apache-2.0", "MIT", "also-MIT"])
    assert got[3] == got[5] == ([], [])
    assert got[4][0] == ["0BSD"]


def test_odd_rows(spark):
    known = spark.createDataFrame([("short", "Short"), ("short", "short")], KNOWN)
    got = licenses.scanned(documents(spark), known).collect()
    assert len(got) == len({i for i, _ in TEXTS})
    assert {r.doc_id for r in got if r.licenses} == {7, 8}
    assert licenses.scanned(documents(spark, []), known).count() == 0
    assert not any(r.licenses for r in licenses.scanned(documents(spark), known.limit(0)).collect())


def test_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    names = {text: name for name, text in KNOWN_LICENSES}
    rows = op6_licenses(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.notices == sorted({names[x] for x in texts[r.doc_id].split("\n") if x in names})
    assert sum(map(bool, (r.notices for r in rows))) > 20


def test_query_knows_whole_texts_and_notices(spark, tmp_path):
    mit = (
        "MIT License\n\nCopyright (c) 2021 Someone\n\n"
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n"
    )
    texts = [("MIT", mit), ("MIT", mit.split("\n", 2)[2])]
    whole = [r for r in licenses.read_known() if len(r[1]) > 400]
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-3.0-only", "ISC", "LGPL-2.1-only",
            "MIT", "MPL-2.0", "CC0-1.0", "Unlicense", "Zlib"} <= {name for name, _ in whole}
    texts += whole
    notices = ["// SPDX-License-Identifier: BSD-3-Clause", "This project is licensed under the MIT License."]
    rows = [*texts, ("none", "\n".join(["x = 1", *notices, "y = 2"]))]
    path = str(tmp_path / "documents.parquet")
    documents(spark, [(i, t) for i, (_, t) in enumerate(rows)]).write.parquet(path)
    got = {r.doc_id: r for r in op6_licenses(spark, str(tmp_path)).collect()}
    assert [name in got[i].licenses for i, (name, _) in enumerate(texts)] == [True] * len(texts)
    assert got[len(texts)].licenses == [] and got[len(texts)].notices == ["BSD-3-Clause", "MIT"]
