"""License scans by canonical digest.

A text is brought into a canonical form: lower case, copyright lines dropped,
punctuation and line breaks as single spaces, equivalent spellings replaced by one.
Its digest is looked up, by a hash join, among the digests of known licences. What is
looked up is the entire text of a document, and as notices each of its entire lines,
so a licence named at the end of a longer document is found too.

Known licences are a table (license, text), digested in the same way; it is small, its size
is that of a list of licences.

Defined cases: a null or empty text, or one without a word, matches nothing; a text of
any length is digested whole; rows that share a ``doc_id``, null included, give one row with
what any of them has; several names for one digest are all given; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import slices

#: Public licence texts, with and without their titles, and standard notices: a JSON object (license, text) a line.
KNOWN = Path(__file__).with_name("known_licenses.jsonl")

# Spellings that licence matching treats as equal, from public guidelines.
EQUIVALENT = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "copyright holder": "copyright owner",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "noncommercial": "non commercial",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "per cent": "percent",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sub license": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}
_SINGLE = {a: b for a, b in EQUIVALENT.items() if " " not in a}
_PAIRS = {tuple(a.split()): b for a, b in EQUIVALENT.items() if " " in a}
_COPYRIGHT = re.compile(r"(?im)^[^\w\n©]*(?:copyright\b(?=.*\d|\s*(?:\(c\)|©))|\(c\)|©|all rights reserved).*$")
_WORD = re.compile(r"[^\W_]+")


def canonical(text: str) -> str:
    """The words of a text as they are compared."""
    out: list[str] = []
    for word in _WORD.findall(_COPYRIGHT.sub(" ", text).lower()):
        word = _SINGLE.get(word, word)
        if out and (pair := _PAIRS.get((out[-1], word))) is not None:
            out[-1] = pair
        else:
            out.append(word)
    return " ".join(out)


def digest(text: str | None) -> bytes | None:
    """The digest of the canonical text; None if it has no word."""
    words = canonical(text or "")
    return hashlib.sha256(words.encode()).digest() if words else None


def read_known(path: str | Path = KNOWN) -> list[tuple[str, str]]:
    """Licence and text of each line of a list of licences, read by the driver."""
    with open(path, encoding="utf-8") as lines:
        return [(row["license"], row["text"]) for row in map(json.loads, lines)]


def _units(rows: DataFrame, name: str, kind: str, lines: bool) -> DataFrame:
    """``name`` (of type ``kind``), ``line`` and ``digest`` of every text and, if asked for, every line.

    ``line`` says whether it is a line's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                at, of_line, found = [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    whole = digest(text)
                    if whole is None:
                        continue
                    parts = {digest(line) for line in text.split("\n")} - {None} if lines else ()
                    for line, value in [(False, whole), *((True, x) for x in parts)]:
                        at.append(i)
                        of_line.append(line)
                        found.append(value)
                yield pa.record_batch(
                    {
                        name: part.column(name).take(pa.array(at, pa.int64())),
                        "line": pa.array(of_line, pa.bool_()),
                        "digest": pa.array(found, pa.binary()),
                    }
                )

    return rows.select(name, "text").mapInArrow(run, f"{name} {kind}, line boolean, digest binary")


def scanned(docs: DataFrame, known: DataFrame, lines: bool = True) -> DataFrame:
    """``doc_id``, ``licenses`` that the entire text is, and ``notices`` that entire lines are, for each ``doc_id``.

    Both are sorted lists of names, empty where nothing is known.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = _units(known, "license", "string", lines=False).select("license", "digest").distinct()
    hits = _units(ids, "doc_id", "long", lines).join(names, "digest")
    found = hits.groupBy("doc_id").agg(
        F.array_sort(F.collect_set(F.when(~F.col("line"), F.col("license")))).alias("licenses"),
        F.array_sort(F.collect_set(F.when(F.col("line"), F.col("license")))).alias("notices"),
    )
    every = ids.select("doc_id").distinct()
    none = F.array().cast("array<string>")
    return every.join(found, every["doc_id"].eqNullSafe(found["doc_id"]), "left").select(
        every["doc_id"], F.coalesce("licenses", none).alias("licenses"), F.coalesce("notices", none).alias("notices")
    )
