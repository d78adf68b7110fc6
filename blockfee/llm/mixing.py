"""Mixing sources to target weights: weighted fair queueing over shuffled documents.

Each source's documents stand in a shuffled order, one round after the other. A
document's virtual finish time is the words of its source up to and including it,
divided by the source's target. All documents in order of finish time are the mix; it
ends where the budget, the words of all documents, is spent. At time 1 each source has
given its target.

Targets share the budget by weight. A source gives at most ``ROUNDS`` times its size;
what it can't give is shared out again by weight among the others.

Sums run over ranges of rows, so a source with a third of all documents is dealt over
as many tasks as any other third.

Defined cases: a null or empty text has size 0 and takes 0; a null source is a source of
its own, the last; rows with equal ``doc_id`` stand side by side in the order and are
taken on their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import running_totals, stored

ROUNDS = 3
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: int = 3) -> DataFrame:
    """``source``, its ``rank`` (from 1), ``source_size``, ``before`` (words of lower ranks) and ``target``.

    Weights are 1 to ``weights``, repeating, in the order of the sources' code points.
    A row for each source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = sources.select(
        "source", "source_size", F.col("source").isNull().alias("none"), F.lit(1).cast("long").alias("one")
    )
    ranked = running_totals(ordered, ["none", "source"], {"rank": "one", "upto": "source_size"}).select(
        "source",
        "source_size",
        "rank",
        (F.col("upto") - F.col("source_size")).alias("before"),
        ((F.col("rank") - 1) % weights + 1).alias("weight"),
        (F.col("source_size") * ROUNDS).alias("most"),
    )
    # Sources fill up in the order of what they can give for each unit of weight.
    filled = running_totals(
        ranked.withColumn("fills_at", F.col("most") / F.col("weight")),
        ["fills_at", "rank"],
        {"most_upto": "most", "weight_upto": "weight"},
    )
    filled = stored(filled, "sources")
    whole = filled.agg(F.sum("source_size").alias("budget"), F.sum("weight").alias("all_weights"))
    left = (F.col("budget") - (F.col("most_upto") - F.col("most"))).cast("double")
    weight_left = F.col("all_weights") - (F.col("weight_upto") - F.col("weight"))
    # One row: the first source that doesn't fill up sets the share of all later ones.
    level = (
        filled.crossJoin(F.broadcast(whole))
        .where(F.col("fills_at") * weight_left > left)
        .agg(F.min(F.struct("fills_at", "rank", left.alias("left"), weight_left.alias("weight_left"))).alias("level"))
    )
    return filled.crossJoin(F.broadcast(level)).select(
        "source",
        "rank",
        "source_size",
        "before",
        F.when(
            F.col("level").isNotNull() & (F.struct("fills_at", "rank") >= F.struct("level.fills_at", "level.rank")),
            F.col("weight") * F.col("level.left") / F.col("level.weight_left"),
        )
        .otherwise(F.col("most").cast("double"))
        .alias("target"),
    )


def finish_time(copy: Column) -> Column:
    """When the copy of a round (from 0) ends; null in a source without a target."""
    given = copy * F.col("source_size") + F.col("upto")
    return F.when(F.col("target") > 0, given.cast("double") / F.col("target"))


def mixed(docs: DataFrame, seed: str = "mix", row_key: str | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every row of ``docs``.

    ``taken`` is the document's words in the mix, repeats counted. ``seed`` sets the order.
    ``row_key`` names a column that tells rows with equal ``doc_id`` apart, to be given too.
    """
    own = [row_key] if row_key else []
    sizes = stored(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), *own), "sizes")
    by_source = stored(targets(sizes), "targets")
    # A row for each source.
    placed = sizes.join(by_source, sizes["source"].eqNullSafe(by_source["source"])).select(
        "doc_id",
        "size",
        "rank",
        "source_size",
        "before",
        "target",
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
        *own,
    )
    queued = stored(
        running_totals(placed, ["rank", "key", "doc_id", "size", *own], {"total": "size"})
        .withColumn("upto", F.col("total") - F.col("before"))
        .drop("total", "before", "key"),
        "queued",
    )
    copies = (
        queued.select("*", F.explode(F.array(*[F.lit(k) for k in range(ROUNDS)])).alias("copy"))
        .select("size", "rank", "copy", "upto", finish_time(F.col("copy")).alias("finish"))
        .where("finish is not null")
    )
    spent = running_totals(copies, ["finish", "rank", "copy", "upto"], {"spent": "size"})
    budget = queued.agg(F.sum("size").alias("budget"))
    # One row: the last copy that the budget pays for. All up to it are in the mix.
    last = (
        spent.crossJoin(F.broadcast(budget))
        .where("spent <= budget")
        .agg(F.max(F.struct("finish", "rank", "copy", "upto")).alias("last"))
    )
    times = sum(
        (
            F.coalesce(
                F.struct(
                    finish_time(F.lit(k)).alias("finish"), "rank", F.lit(k).alias("copy"), "upto"
                ) <= F.col("last"),
                F.lit(False),
            ).cast("long")
            for k in range(ROUNDS)
        ),
        F.lit(0).cast("long"),
    )
    taken = F.when(F.col("target") > 0, F.col("size") * times).otherwise(F.lit(0)).cast("long")
    return queued.crossJoin(F.broadcast(last)).select(
        *own, "doc_id", "size", "source_size", "target", taken.alias("taken")
    )
