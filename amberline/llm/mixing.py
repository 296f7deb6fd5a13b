"""Mixing sources to target weights by nested hash thresholds.

Each document has a fixed 60-bit hash.  Words are summed by (source, leading hash bits); the bucket in
which a source's budget ends is found in these sums, and only the rows of that bucket are summed again by
the next bits, until it holds one hash value.  What is below the threshold is taken: a comparison per row,
no sort and no shuffle of documents.  Larger budgets have larger thresholds, so mixes are nested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import checkpointed, small_side, word_count

HASH_BITS = 60
LEVEL_BITS = 12


def hash60(key: Column, seed: int = 0) -> Column:
    text = F.concat(F.lit(f"mix{seed}|"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) for one row per source.

    ``weights`` repeat over the sources in code point order, null last.  Targets share ``share`` times all
    words by weight; none is above ``most`` times its source, and what is cut there is shared again.
    Sources fill up in the order of cap / weight, so one running sum finds the level at which the rest stands.
    The windows below run over one row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at + 1).cast("int"))
    rows = (sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))))
    order = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = (rows.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
            .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
            .withColumn("full", F.col("level") * F.col("w") >= F.col("cap")))
    # the level at the first source that is not full is the level of all the rest
    first = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"),
                                                  F.col("level")))).over(everything)
    level = first["level"]
    return rows.select("source", "source_size",
                       F.when(F.col("full") | level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("w")))
                       .alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): documents of a source with a hash below it have nearly ``budget`` words.

    ``rows``: source, h, size; ``budgets``: source, budget.  A pass sums one level of hash bits and reads
    only the boundary bucket of each source.  The document on the boundary is taken if that comes nearer.
    """
    state = checkpointed(budgets.select("source", F.col("budget").cast("double").alias("left"), F.lit(0).cast("long").alias("prefix"),
                                        F.lit(None).cast("long").alias("threshold")))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        last = state.where(F.col("threshold").isNull()).select(F.col("source").alias("s"), "left", "prefix")
        inside = rows.join(small_side(last), F.col("source").eqNullSafe(F.col("s"))
                           & (F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix")))
        sums = (inside.groupBy("source", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high"), F.first("left").alias("left")))
        upto = F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
        edge = (sums.withColumn("upto", upto).where(F.col("upto") >= F.col("left"))
                .groupBy(F.col("source").alias("s"))
                .agg(F.min(F.struct("bucket", "words", "low", "high", (F.col("left") - F.col("upto") + F.col("words")).alias("left")))
                     .alias("e")))
        settled = (F.col("e.low") == F.col("e.high")) | F.lit(shift == 0)
        found = (F.when(F.col("e").isNull(), (F.col("prefix") + 1) * F.lit(1 << shift + LEVEL_BITS))  # rounding: the budget is all there is
                 .when(settled & (F.col("e.left") * 2 >= F.col("e.words")), F.col("e.high") + 1)
                 .when(settled, F.col("e.low")))
        state = checkpointed(state.join(small_side(edge), F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", F.coalesce("e.left", "left").alias("left"), F.coalesce("e.bucket", "prefix").alias("prefix"),
            F.coalesce(F.col("threshold"), found).alias("threshold")))
        if state.where(F.col("threshold").isNull()).isEmpty():
            break
    return state.select("source", "threshold")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0,
                key: str = "doc_id", source: str = "source", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, source, the columns ``keep``, size, source_size, target, copies, taken) for each row of ``docs``.

    Every document is taken floor(target / source_size) times, and once more if its hash is below the source's threshold.
    A null text has no words and is never taken; a null source is a source; a null key hashes like the text "null".  Rows with the
    same key share a hash, so they are taken together.  An empty table gives no rows.  Other columns do not matter.
    """
    base = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"), hash60(F.col(key), seed).alias("h"),
                       *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    rows = checkpointed(base.select("id", "source", "size", "h"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = checkpointed(targets(sizes, weights, share, most))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = goal.withColumn("whole", whole.cast("long"))
    cut = thresholds(rows, goal.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget")))
    goal = checkpointed(goal.select(F.col("source").alias("s"), "source_size", "target", "whole")
                        .join(cut.select(F.col("source").alias("s2"), "threshold"), F.col("s").eqNullSafe(F.col("s2"))))
    copies = F.col("whole") + F.when((F.col("h") < F.col("threshold")) & (F.col("whole") < F.lit(int(most))), 1).otherwise(0)
    return ((base if keep else rows).join(small_side(goal), F.col("source").eqNullSafe(F.col("s")))
            .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("long"))
            .select(F.col("id").alias(key), F.col("source").alias(source), *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "size",
                    "source_size", F.col("target").cast("double").alias("target"), "copies", (F.col("size") * F.col("copies")).alias("taken")))
