"""Queries of the dealt operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fim, jaccard, licenses, line_dedup, mixing, nearest, periodic_runs, pii, quality, rp_forest
from . import token_files, vafile
from .shared import send_package

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_documents(manifest)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return tokens.select(
        "doc_id",
        "n_tokens",
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # A key for these tables; users pass their own secret.
    return pii.pseudonymised(docs, key="a key for the given tables", found="n_found")


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(_table(spark, sf_dir, "documents"), n=5, percent=80)


def held_out(doc_id: str = "doc_id"):
    """Whether a document's labels are kept from learning."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def quality_weights(spark: SparkSession, docs: DataFrame, sf_dir: str):
    labels = _table(spark, sf_dir, "labels").where(~held_out())
    return quality.train(docs, labels)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.scored(docs, quality_weights(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


#: Notices, and a short text, besides the list of licences that the package has.
KNOWN_LICENSES = [
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        'hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
]


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    known = spark.createDataFrame([*KNOWN_LICENSES, *licenses.read_known()], "license string, text string")
    return licenses.scanned(docs, known)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_dedup.without_repeated_lines(docs, counts=("n_lines", "n_dropped"))
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fim.transformed(_table(spark, sf_dir, "documents").select("doc_id", "text"), seed=7)
    back = fim.restored(F.col("fim.output"), F.col("fim.form"))
    return docs.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; of each tenth id, by its hash, the end of the text repeats a few of its words.

    From word a on, word i is word a + (i - a) % p. A null id has no hash, and its text stays.
    """
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(hashed / 10)

    def repeated(given):
        n = F.size(given).cast("long")
        first = g % n
        period = (1 + F.floor((n - first) / (3 + g % 8))).cast("long")
        place = lambda i: F.when(i < first, i).otherwise(first + (i - first) % period).cast("int")
        changed = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(given, place(i)))
        return F.when(n > 0, F.array_join(changed, " "))

    # A list of one binds the words, so that they are found once.
    tail = F.get(F.transform(F.array(words), repeated), 0)
    return docs.select("doc_id", F.when(hashed % 10 == 0, F.coalesce(tail, "text")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_repeated_tails(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.with_runs(docs, least=12).withColumn("best", periodic_runs.longest_run(F.col("runs")))
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        exponent.alias("exponent_milli"),
        F.sha2(periodic_runs.written(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_token_files": op1_token_files,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_pseudonyms": op3_pseudonyms,
    "op4_jaccard": op4_jaccard,
    "op5_quality": op5_quality,
    "op6_licenses": op6_licenses,
    "op7_line_dedup": op7_line_dedup,
    "op8_nearest": op8_nearest,
    "op9_mixture": op9_mixture,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_near_vectors": op11_near_vectors,
    "op12_fill_middle": op12_fill_middle,
    "op13_periodic_runs": op13_periodic_runs,
}
