"""Trailing three-month features.

Each measure is smoothed at its own grain - pairs for sales, stores for transactions, the month table
for prices - with a range frame over a month counter, so a missing month counts as missing instead of
being replaced by an older one. A window group holds one row per calendar month, so no group is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.functions.calendar import join_calendar, months_window
from shelfcast.functions.dates import month_index
from shelfcast.operators.rollup import PAIR


def _three_months(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("month_idx").rangeBetween(-2, 0)


def sales_features(monthly: DataFrame) -> DataFrame:
    w = _three_months(PAIR)
    return (
        monthly.withColumn("month_idx", month_index("snapshot_date"))
        .withColumns(
            {
                "sales_LM": F.col("sales"),
                "AVG_sales_L3M": F.avg("sales").over(w),
                "SUM_sales_L3M": F.sum("sales").over(w),
                "onpromotion_LM": F.col("onpromotion_sum"),
                "AVG_onpromotion_L3M": F.avg("onpromotion_sum").over(w),
                "SUM_onpromotion_L3M": F.sum("onpromotion_sum").over(w),
            }
        )
        .drop("month_idx")
    )


def transaction_features(monthly: DataFrame) -> DataFrame:
    w = _three_months(["store_nbr"])
    return monthly.withColumn("month_idx", month_index("snapshot_date")).select(
        "snapshot_date",
        "store_nbr",
        F.col("transactions").alias("transactions_LM"),
        F.avg("transactions").over(w).alias("AVG_transactions_L3M"),
        F.sum("transactions").over(w).alias("SUM_transactions_L3M"),
    )


TRANSACTION_FEATURES = ["transactions_LM", "AVG_transactions_L3M", "SUM_transactions_L3M"]


def with_transactions(pairs: DataFrame, monthly: DataFrame) -> DataFrame:
    """The transaction features of its store and month beside every row.

    A store's months are one map, at most one entry a calendar month. So the join is by store alone: rows that lie by
    store for their windows, and the windows here, are not shuffled again.
    """
    entry = F.struct("snapshot_date", F.struct(*TRANSACTION_FEATURES))
    known = transaction_features(monthly).where(F.col("snapshot_date").isNotNull())
    stores = known.groupBy("store_nbr").agg(F.map_from_entries(F.collect_list(entry)).alias("_months"))
    found = F.try_element_at("_months", "snapshot_date")
    joined = pairs.join(stores, "store_nbr", "left").withColumn("_found", found)
    return joined.select(*[F.col(f"`{c}`") for c in pairs.columns], *[F.col(f"_found.{c}") for c in TRANSACTION_FEATURES])


def oil_features(monthly: DataFrame) -> DataFrame:
    w = months_window(-2, 0)
    return monthly.withColumn("month_idx", month_index("snapshot_date")).select(
        "snapshot_date",
        F.col("avg_dcoilwtico").alias("AVG_dcoilwtico_LM"),
        F.avg("avg_dcoilwtico").over(w).alias("AVG_dcoilwtico_L3M"),
        F.sum("avg_dcoilwtico").over(w).alias("SUM_dcoilwtico_L3M"),
    )


def complete_months(months: DataFrame, span: int = 3) -> DataFrame:
    """Months S for which S and the ``span - 1`` months before it are all present."""
    counted = months.withColumn("month_idx", month_index("snapshot_date")).withColumn(
        "have", F.count("*").over(months_window(1 - span, 0))
    )
    return counted.where(F.col("have") == span).select("snapshot_date")


def keep_months(df: DataFrame, months: DataFrame) -> DataFrame:
    return join_calendar(df, months, how="left_semi")
