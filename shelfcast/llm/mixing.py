"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source is a queue of its documents in a shuffled order, passed through up to ``EPOCHS`` times. A copy of
a document gets a virtual finish time: the words its source has sent so far, itself included, divided by the
source's target. All copies are put into one global order of finish times, and the order is cut where the
words of all sources together reach the budget.

Running sums go over equal ranges of the shuffled order, and of the finish times: sums per range, running
sums over the ranges, and only then within each range. With about sqrt(rows) ranges no task sees a whole
source. Only the single range that holds the cut is ordered copy by copy.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import WORD, free_name
from shelfcast.session import written

WEIGHTS = (5, 2, 1)
EPOCHS = 3
#: Finish times beyond so many times the target share one range: they lie far behind the cut.
HORIZON = 4


def row_key(doc_id: Column, source: Column, text: Column) -> Column:
    """The shuffled order: a digest of a row's id, source and text, the same in every run."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))]
    return F.md5(F.concat_ws(":", *parts, F.coalesce(source, F.lit(""))).cast("binary"))


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, key`` of every row, stored once; size counts the words of the whole text."""
    doc_id, source, text = F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")
    return written(
        docs.select(
            doc_id.alias("doc_id"),
            source.alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            row_key(doc_id, source, text).alias("key"),
        ),
        "mix-sizes",
    )


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per source: place by code point (null last), weight, source_size, target.

    Targets share all words by weight, none above ``epochs`` times its source. In the order of cap over weight,
    the capped sources come first; the level of the others is what those leave, per unit of weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    place = F.row_number().over(by_name)
    found = (
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", place)
        .withColumn("weight", F.element_at(F.lit(list(weights)), (F.col("place") - 1) % len(weights) + 1).cast("long"))
        .withColumn("cap", epochs * F.col("source_size"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("shares", F.sum("weight").over(onwards))
        .withColumn("rank", F.row_number().over(by_ratio))
    )
    fits = F.col("cap") * F.col("shares") >= F.col("weight") * F.col("left")
    level = F.struct("rank", (F.col("left") / F.col("shares")).alias("level"))
    lowest = F.min(F.when(fits, level)).over(everything)["level"]
    return found.withColumn("level", lowest).select(
        "source",
        "place",
        "source_size",
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def queued(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> tuple[DataFrame, int, int]:
    """Rows with their source's place, size and target and the words ``sent`` when they have passed once."""
    rows = sizes(docs)
    number, budget = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(1, math.isqrt(number))
    goals = targets(rows, weights, epochs).withColumnRenamed("source", "name")
    part = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") * (ranges / 2**32)).cast("int")
    placed = rows.join(goals, F.col("source").eqNullSafe(F.col("name"))).withColumn("part", part).drop("name")
    sums = placed.groupBy("place", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("place", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("place", "part").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    sent = placed.withColumn("running", F.sum("size").over(within)).join(bases, ["place", "part"])
    sent = sent.withColumn("sent", F.col("base") + F.col("running")).drop("base", "running", "part")
    return written(sent, "mix-queue"), budget, ranges


def finish(epoch: Column) -> Column:
    """Virtual finish time of a row's copy in an epoch; null if its source has nothing to send."""
    return F.when(
        (F.col("size") > 0) & (F.col("target") > 0), (epoch * F.col("source_size") + F.col("sent")) / F.col("target")
    )


def decisions(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, key`` for every row of ``docs``.

    Null and empty texts have size 0 and are not taken; a null source is a source of its own, the last one. Repeated
    rows are queued like any others. An empty table gives no rows. Whole documents only: a source's words
    differ from its target by its documents at the cut. Extra columns are not read.
    """
    rows, budget, ranges = queued(docs, weights, epochs)
    copies = (
        rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("finish", finish(F.col("epoch")))
        .where("finish is not null")
        .withColumn("slot", F.floor(F.least(F.col("finish"), F.lit(float(HORIZON))) * ranges).cast("long"))
    )
    slots = copies.groupBy("slot").agg(F.sum("size").alias("words"))
    so_far = F.sum("words").over(Window.orderBy("slot"))
    cut = slots.withColumn("all", so_far).where(F.col("all") > budget).orderBy("slot").first()
    if cut is None:
        last = None
    else:
        order = Window.orderBy("finish", "place", "key", "sent")
        last = (
            copies.where(F.col("slot") == cut["slot"])
            .withColumn("all", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .where(F.col("all") <= budget - (cut["all"] - cut["words"]))
            .agg(F.max(F.struct("finish", "place", "key", "sent")).alias("last"))
            .first()["last"]
        )

    def passes(epoch: int) -> Column:
        time = finish(F.lit(epoch))
        if cut is None:
            inside = time.isNotNull()
        elif last is None:
            inside = F.floor(F.least(time, F.lit(float(HORIZON))) * ranges) < cut["slot"]
        else:
            kinds = {"finish": "double", "place": "int", "key": "string", "sent": "long"}
            at = F.struct(*(F.lit(last[c]).cast(kind).alias(c) for c, kind in kinds.items()))
            inside = F.struct(time.alias("finish"), "place", "key", "sent") <= at
        return F.when(time.isNotNull() & inside, 1).otherwise(0)

    taken = sum((passes(epoch) for epoch in range(1, epochs)), passes(0))
    return rows.withColumn("copies", taken).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "key"
    )


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it, with all their columns."""
    key, times, total = (free_name(docs, c) for c in ("key", "times", "total"))
    chosen = decisions(docs, weights, epochs).groupBy(F.col("key").alias(key)).agg(
        F.sum("copies").cast("int").alias(total)
    )
    keyed = docs.withColumn(
        key, row_key(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    )
    return (
        keyed.join(chosen.where(F.col(total) > 0), key)
        .dropDuplicates([key])
        .withColumn(times, F.explode(F.sequence(F.lit(1), F.col(total))))
        .select(*docs.columns)
    )
