"""Exact quantiles of large groups, without holding a group in one task.

``percentile`` keeps every distinct value of a group in one hash map, so one group must fit one task.
Here a mergeable sketch proposes split points and every value is counted into the slot of a point or between
two points (exact counts, whatever the quality of the sketch). Only the slots that hold a wanted rank go on: one of few
rows is sorted by itself, one above the row budget becomes a group of its own and is split again,
until none is left. Quantiles are linear interpolations between neighbouring ranks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.session import written

SKETCH_POINTS = 256
SKETCH_ACCURACY = 20000
ROWS_PER_SLOT = 1_000_000


def even_probabilities(n_bins: int) -> list[float]:
    """0, 1/n, 2/n, ... 1, each a multiple of the same step."""
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins)] + [1.0]


def _split_points(values: DataFrame, keys: list[str]) -> DataFrame:
    """``SKETCH_POINTS`` ascending numbers per group, the last ones infinite; slots of half the row budget at best."""
    grid = ", ".join(f"{i / SKETCH_POINTS}D" for i in range(1, SKETCH_POINTS))
    sketch = values.groupBy(*keys).agg(
        F.count("value").alias("n"),
        F.expr(f"percentile_approx(value, array({grid}), {SKETCH_ACCURACY})").alias("points"),
    )
    wanted = F.greatest(F.lit(16.0), F.col("n") / F.lit(ROWS_PER_SLOT / 2))
    stride = F.greatest(F.lit(1), F.floor(F.lit(float(SKETCH_POINTS)) / wanted).cast("int"))
    thinned = F.array_sort(F.array_distinct(F.filter("points", lambda _, i: i % F.col("stride") == 0)))
    padding = F.array_repeat(F.lit(float("inf")), SKETCH_POINTS)
    return sketch.withColumn("stride", stride).select(
        *keys, F.slice(F.concat(thinned, padding), 1, SKETCH_POINTS).alias("points")
    )


def _slot(value: Column, points: Column) -> Column:
    """Twice the number of sorted points not above the value, less one on a point itself.

    Odd slots hold a single value, so a slot that holds several is always smaller than its group. The search
    is a binary one in generated code.
    """
    found, step = F.lit(0), SKETCH_POINTS // 2
    while step:
        above = F.coalesce(F.get(points, found + (step - 1)) <= value, F.lit(False))
        found = found + F.when(above, step).otherwise(0)
        step //= 2
    last = F.coalesce(F.get(points, found) <= value, F.lit(False))
    found = found + F.when(last, 1).otherwise(0)
    on_point = F.coalesce(F.get(points, found - 1) == value, F.lit(False))
    return found * 2 - on_point.cast("int")


def _numbered(probabilities: list[float]) -> Column:
    """The wanted ranks of a group of ``n`` rows; the ends of probability ``i`` are ``2 i`` (low) and ``2 i + 1`` (high)."""
    return F.flatten(
        F.transform(
            F.array(*[F.lit(float(p)) for p in probabilities]),
            lambda p, i: F.array(
                F.struct((i * 2).alias("end"), F.floor(p * (F.col("n") - 1)).alias("rank")),
                F.struct((i * 2 + 1).alias("end"), F.ceil(p * (F.col("n") - 1)).alias("rank")),
            ),
        )
    )


def _asks(counts: DataFrame, keys: list[str], asked: DataFrame | None, probabilities: list[float]) -> DataFrame:
    """Which ranks to pick in which slot, from one count per group and slot; slots without a wanted rank are left out.

    ``rank`` counts from the start of the slot. A group has at most twice ``SKETCH_POINTS`` + 1 slots. The first
    time the ranks follow from the group's rows, later they are those ``asked`` of the group.
    """
    each = Window.partitionBy(*keys)
    sized = counts.withColumn("upto", F.sum("in_slot").over(each.orderBy("slot")))
    if asked is None:
        sized = sized.withColumn("n", F.sum("in_slot").over(each)).withColumn("all_asks", _numbered(probabilities))
    else:
        sized = sized.join(asked.select(*keys, "n", F.col("asks").alias("all_asks")), keys)
    before = F.col("upto") - F.col("in_slot")
    inside = F.filter("all_asks", lambda a: (a["rank"] >= before) & (a["rank"] < F.col("upto")))
    asks = F.transform(inside, lambda a: F.struct(a["end"].alias("end"), (a["rank"] - before).alias("rank")))
    return sized.select(*keys, "slot", "in_slot", "n", asks.alias("asks")).where(F.size("asks") > 0)


def _picked(slotted: DataFrame, wanted: DataFrame, group: str) -> DataFrame:
    """``group, n, end, value`` of the wanted ranks; every slot is sorted by itself, equal values are one row."""
    slot = [group, "_path", "slot"]
    # The pairs are unique, so the inner join filters; a semi join would be moved below the slot and compute it twice.
    inside = slotted.join(wanted.select(*slot), slot).groupBy(*slot, "value").agg(F.count("*").alias("copies"))
    upto = F.sum("copies").over(Window.partitionBy(*slot).orderBy("value"))
    return (
        inside.select(*slot, "value", upto.alias("upto"), (upto - F.col("copies")).alias("before"))
        .join(wanted, slot)
        .select(group, "n", "value", "before", "upto", F.inline("asks"))
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto")))
        .select(group, "n", "end", "value")
    )


def _interpolate(low: Column, high: Column, share: Column) -> Column:
    """Between equal ends the value itself, infinite ones included."""
    gap = high - low
    between = F.when(share >= 0.5, high - gap * (1 - share)).otherwise(low + gap * share)
    return F.when(low == high, low).otherwise(between)


def exact_quantiles(df: DataFrame, group: str, value: str, probabilities: list[float]) -> DataFrame:
    """One row per group: ``group``, ``n`` (non-null values) and ``quantiles`` in the order asked for.

    Nulls and NaN are ignored. ``df`` is read for the sketch, for the slot counts and for the picking;
    hand in a stored table when it is costly to compute. Split points, slot counts, results and the rows of slots that
    are split again are tables in the shared folder, whatever the number of groups, so that plans using them do not
    repeat the work. No task sorts more than ``ROWS_PER_SLOT`` rows of a group, however many it has.
    """
    values = df.select(group, F.lit("").alias("_path"), F.col(value).cast("double").alias("value")).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    keys, asked, rounds = [group, "_path"], None, []
    # a round leaves slots of a hundredth of the rows or so, and one value less at the least
    while True:
        splits = written(_split_points(values, keys), "split_points")
        slotted = values.join(splits, keys).withColumn("slot", _slot(F.col("value"), F.col("points"))).drop("points")
        counts = slotted.groupBy(*keys, "slot").agg(F.count("*").alias("in_slot"))
        wanted = written(_asks(counts, keys, asked, probabilities), "wanted_ranks")
        large = (F.col("in_slot") > ROWS_PER_SLOT) & (F.col("slot") % 2 == 0)
        rounds.append(_picked(slotted, wanted.where(~large), group))
        if wanted.where(large).isEmpty():
            break
        deeper = F.concat_ws("/", "_path", F.col("slot").cast("string"))
        asked = wanted.where(large).select(group, deeper.alias("_path"), "n", "asks")
        narrowed = slotted.join(wanted.where(large).select(*keys, "slot"), [*keys, "slot"])
        values = written(narrowed.select(group, deeper.alias("_path"), "value"), "narrowed_values")
    picked = (
        reduce(DataFrame.unionByName, rounds)
        .groupBy(group)
        .agg(F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("end", "value"))).alias("ends"))
    )

    def quantile(p: Column, i: Column) -> Column:
        position = p * (F.col("n") - 1)
        low, high = F.element_at("ends", i * 2), F.element_at("ends", i * 2 + 1)
        return _interpolate(low, high, position - F.floor(position))

    quantiles = F.transform(F.array(*[F.lit(float(p)) for p in probabilities]), quantile)
    return written(picked.select(group, "n", quantiles.alias("quantiles")), "quantiles")
