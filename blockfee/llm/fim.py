"""Fill-in-the-middle transformation: a text's lines cut in three and put in another order.

A text is cut into n lines by the unit ``[^\\n]*\\n|[^\\n]+``. A hash of the document's id
chooses two cuts among the n + 1 places between lines, and the form: ``psm`` (prefix,
suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain`` (left as it is).

``regexp_count`` gives n. A pattern of the row's own, with possessive counted groups
``unit{a}+`` and ``unit{b-a}+``, then captures prefix, middle and suffix in one match, and
its replacement puts them together with the sentinels. Possessive groups run in a loop and
keep no places to come back to, so neither long texts nor many lines cost stack. All of it
is column expressions: a narrow plan without shuffles.

Cases: a null text counts as empty, and an empty text is plain with n = 0. A null id hashes
like an empty one. A text that contains a sentinel is plain, as it couldn't be restored.
Repeated rows and ids are rows of their own, with the same cuts where id and n are the same.
Very long texts and lines are cut whole. An empty table gives an empty result. Extra columns
are kept whatever their names; only a column with the name of ``into`` is replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The same lines as of ``[^\n]*\n|[^\n]+``, matched without coming back.
UNIT = r"(?:[^\n]*+\n|[^\n]++)"
#: Begins of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string"


def _check(sentinels: tuple[str, str, str]) -> None:
    """Sentinels must be found again where they were put, whatever text stands beside them."""
    for one in sentinels:
        if not one or "\n" in one:
            raise ValueError(f"no sentinel: {one!r}")
        for other in sentinels:
            ends = {other[i:] for i in range(1, len(other))}
            if any(one[:i] in ends for i in range(1, len(one))) or (one is not other and one in other):
                raise ValueError(f"sentinels overlap: {one!r}, {other!r}")


def _hashes(doc_id: Column, seed: int) -> list[Column]:
    """The first four groups of eight hexadecimal digits of the id's sha256, as numbers."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _counted(times: Column) -> Column:
    return F.concat(F.lit(f"({UNIT}{{"), times.cast("string"), F.lit("}+)"))


def _replacement(order: str, sentinels: tuple[str, str, str]) -> str:
    """A replacement that puts the pattern's groups 1 to 3 after their sentinels."""
    begins = dict(zip("psm", sentinels, strict=True))
    group = {"p": "$1", "m": "$2", "s": "$3"}
    return "".join(re.sub(r"([\\$])", r"\\\1", begins[x]) + group[x] for x in order)


def _quoted(sentinel: str) -> str:
    return re.sub(r"([^0-9A-Za-z])", r"\\\1", sentinel)


def _pieces(output: Column, form: Column, sentinels: tuple[str, str, str]) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of an output that isn't plain: what stands between its sentinels."""
    parts = F.split(output, "|".join(map(_quoted, sentinels)))
    at = {"psm": {"p": 1, "s": 2, "m": 3}, "spm": {"s": 1, "p": 2, "m": 3}}

    def piece(x: str) -> Column:
        return F.when(form == "psm", F.get(parts, at["psm"][x])).when(form == "spm", F.get(parts, at["spm"][x]))

    return piece("p"), piece("m"), piece("s")


def transformed(
    docs: DataFrame,
    seed: int = 7,
    fim_percent: int = 100,
    spm_percent: int = 50,
    sentinels: tuple[str, str, str] = SENTINELS,
    into: str = "fim",
) -> DataFrame:
    """The columns of ``docs`` (doc_id, text, ...) and ``into``, a struct of n, form, prefix_chars, middle_chars, output.

    ``fim_percent`` of the documents are transformed, ``spm_percent`` of those to ``spm``.
    Lengths are code points, null if plain.
    """
    _check(sentinels)
    others = [name for name in docs.columns if name != into]
    h1, h2, h3, h4 = _hashes(F.col("doc_id"), seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.regexp_count(text, F.lit(UNIT)).cast("long")
    rows = docs.select(F.struct(*others).alias("row"), text.alias("text"), n.alias("n"), h1.alias("h1"), h2.alias("h2"),
                       h3.alias("h3"), h4.alias("h4"))
    marked = F.lit(False)
    for x in sentinels:
        marked = marked | F.contains("text", F.lit(x))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= fim_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    rows = rows.select("row", "text", "n", form.alias("form"), F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
    pattern = F.concat(F.lit("(?s)^"), _counted(F.col("a")), _counted(F.col("b") - F.col("a")), F.lit("(.*+)"))
    order = F.when(F.col("form") == "spm", _replacement("spm", sentinels)).otherwise(_replacement("psm", sentinels))
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    rows = rows.select("row", "n", "form", output.alias("output"))
    prefix, middle, _ = _pieces(F.col("output"), F.col("form"), sentinels)
    fim = F.struct(
        "n", "form", F.char_length(prefix).cast("long").alias("prefix_chars"),
        F.char_length(middle).cast("long").alias("middle_chars"), "output",
    )
    return rows.select("row.*", fim.alias(into))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``output`` was made of; null where output or form is."""
    _check(sentinels)
    prefix, middle, suffix = _pieces(output, form, sentinels)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))
