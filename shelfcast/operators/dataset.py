"""Training sets: features aligned with labels, month sufficiency and splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.functions.calendar import join_calendar
from shelfcast.functions.dates import month_index
from shelfcast.sources.schemas import (
    JOIN_KEYS,
    LABEL,
    OOT_MONTHS,
    TEST_MONTHS,
    TRAIN_MONTHS,
    VAL_MONTHS,
)

SPLIT_MONTHS = {"train": TRAIN_MONTHS, "val": VAL_MONTHS, "test": TEST_MONTHS, "oot": OOT_MONTHS}
WINDOW_MONTHS = sum(SPLIT_MONTHS.values())


def align(features: DataFrame, labels: DataFrame, label_at: str = "S") -> DataFrame:
    """Features of month S with the sales of month S+1 of the same pair, all months in one join.

    ``label_at`` tells how the label store files a label: under its own month, or one month earlier.
    """
    back = -1 if label_at == "S" else 0
    filed = labels.select(F.add_months("snapshot_date", back).alias("snapshot_date"), *JOIN_KEYS, LABEL)
    return features.join(filed, ["snapshot_date", *JOIN_KEYS])


def next_month_label(features: DataFrame, ready: DataFrame, sales: str = "sales_LM") -> DataFrame:
    """The same pairing taken from the panel itself, where the label is next month's ``sales``.

    A range frame of exactly one month ahead shares the partitioning and order of the trailing windows,
    so no second shuffle and no join of two panels is needed.
    """
    w = Window.partitionBy(*JOIN_KEYS).orderBy("month_idx").rangeBetween(1, 1)
    labelled = (
        features.withColumn("month_idx", month_index("snapshot_date"))
        .withColumn(LABEL, F.max(sales).over(w))
        .drop("month_idx")
        .where(F.col(LABEL).isNotNull())
    )
    label_months = ready.select(F.add_months("snapshot_date", -1).alias("snapshot_date"))
    return join_calendar(labelled, label_months, how="left_semi")


def required_months(run_months: DataFrame, months: int = WINDOW_MONTHS) -> DataFrame:
    """For every run month S: features of S-n..S-1 and labels of S-n+1..S."""
    back = F.explode(F.sequence(F.lit(0), F.lit(months - 1)))
    feature = run_months.select("run_month", back.alias("k")).select(
        "run_month", F.lit("feature").alias("kind"), F.expr("add_months(run_month, -1 - k)").alias("snapshot_date")
    )
    label = run_months.select("run_month", back.alias("k")).select(
        "run_month", F.lit("label").alias("kind"), F.expr("add_months(run_month, -k)").alias("snapshot_date")
    )
    return feature.unionByName(label)


def missing_months(run_months: DataFrame, feature_months: DataFrame, label_months: DataFrame) -> DataFrame:
    """The required months that are absent; a run month without a row here can train."""
    have = feature_months.select(F.lit("feature").alias("kind"), "snapshot_date").unionByName(
        label_months.select(F.lit("label").alias("kind"), "snapshot_date")
    )
    return join_calendar(required_months(run_months), have, ["kind", "snapshot_date"], "left_anti")


def trainable_months(run_months: DataFrame, feature_months: DataFrame, label_months: DataFrame) -> DataFrame:
    missing = missing_months(run_months, feature_months, label_months)
    return join_calendar(run_months, missing.select("run_month").distinct(), "run_month", "left_anti")


def usable_months(feature_months: DataFrame, label_months: DataFrame) -> DataFrame:
    """Feature months whose label, one month later, exists."""
    labelled = label_months.select(F.add_months("snapshot_date", -1).alias("snapshot_date"))
    return join_calendar(feature_months, labelled, how="left_semi")


def split_name(age):
    """Split of a month by its age: 1 is the newest month of the window."""
    bound, column = 0, None
    for name in ("oot", "test", "val", "train"):
        bound += SPLIT_MONTHS[name]
        column = F.when(age <= bound, name) if column is None else column.when(age <= bound, name)
    return column


def rolling_split(usable: DataFrame, anchor: str) -> DataFrame:
    """The newest 24 usable months up to ``anchor`` with their split; empty when there are fewer.

    Works on the month table, one row per calendar month.
    """
    newest = Window.orderBy(F.col("snapshot_date").desc())
    aged = (
        usable.where(F.col("snapshot_date") <= F.lit(anchor).cast("date"))
        .withColumn("age", F.row_number().over(newest))
        .where(F.col("age") <= WINDOW_MONTHS)
        .withColumn("have", F.count("*").over(Window.partitionBy(F.lit(0))))
    )
    return aged.where(F.col("have") == WINDOW_MONTHS).select("snapshot_date", split_name(F.col("age")).alias("split"))


def with_split(df: DataFrame, split: DataFrame) -> DataFrame:
    return join_calendar(df, split, how="inner")


def split_statistics(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(
        F.min("snapshot_date").alias("start"), F.max("snapshot_date").alias("end"), F.count("*").alias("rows")
    )


def day_window_split(df: DataFrame, run_date: str, column: str, train_test_days: int, oot_days: int) -> DataFrame:
    """``oot``: the days just before the run date; ``train_test``: the days before those; others dropped."""
    run = dt.date.fromisoformat(run_date)
    oot_start = run - dt.timedelta(days=oot_days)
    start = oot_start - dt.timedelta(days=train_test_days)
    day = dt.timedelta(days=1)
    c = F.col(column)
    part = F.when(c.between(F.lit(oot_start), F.lit(run - day)), "oot").when(
        c.between(F.lit(start), F.lit(oot_start - day)), "train_test"
    )
    return df.withColumn("split", part).where(F.col("split").isNotNull())


def hash_split(df: DataFrame, keys: list[str], share: float, seed: int) -> DataFrame:
    """Repeatable random split: a row's side depends on its keys and the seed, not on its partition."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 1000
    return df.withColumn("split", F.when(bucket < int(share * 1000), "train").otherwise("test"))


def cutoff_split(df: DataFrame, weeks: int, column: str = "week_start") -> DataFrame:
    """Hold out the newest ``weeks`` weeks."""
    cutoff = df.agg(F.date_sub(F.max(column), 7 * weeks)).scalar()
    return df.withColumn("split", F.when(F.col(column) <= cutoff, "train").otherwise("test"))
