"""Small tables with every odd case: nulls, empty and long texts, ties, repeats, clashing columns."""

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.01"
LINE = "a line that many documents share, word for word"
LONG = " ".join(f"word{i % 7919}" for i in range(60_000))

TEXTS = [
    (1, f"one two three four five six seven\n{LINE}\nend"),
    (2, f"  {LINE.upper()}  \nother text here"),
    (3, f"{LINE}\n\nlast one"),
    (4, None),
    (5, ""),
    (6, "   \n\t "),
    (7, "short"),
    (8, "short"),
    (8, "short"),
    (9, LONG),
    (10, LONG + " one more"),
    (None, "a row without an id and a few more words"),
    (None, None),
    (11, "naïve café — “quotes” 漢字 \U0001f600\U0001f600  two  spaces\n \nnew line x"),
    (-12, "one two three four five six seven\nend"),
]


def documents(spark: SparkSession, rows=TEXTS) -> DataFrame:
    """``rows`` with the columns of documents and some whose names operators use themselves."""
    clashing = "score double, n long, doc long, high long, row string, _id long, finish string"
    return spark.createDataFrame(
        [(i, t, "en", f"src{(i or 0) % 3}" if i != 7 else None, len(t or ""), 0.5, 1, 2, 3, "r", 4, "f") for i, t in rows],
        f"doc_id long, text string, lang string, source string, n_chars long, {clashing}",
    )


def table(spark: SparkSession, name: str, sf_dir: str = SF_DIR) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
