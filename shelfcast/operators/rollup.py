"""Roll-ups to month and week grain.

All are plain grouped aggregates: Spark combines on the map side, so a hot store or family is already
one row per task and key before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import month_start, week_start

PAIR = ["store_nbr", "family"]


def monthly_sales(sales: DataFrame) -> DataFrame:
    promo = F.col("onpromotion").cast("float")
    return sales.groupBy(month_start("date").alias("snapshot_date"), *PAIR).agg(
        F.sum("sales").alias("sales"),
        F.sum(promo).alias("onpromotion_sum"),
        F.avg(promo).alias("onpromotion_avg"),
    )


def monthly_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(month_start("date").alias("snapshot_date"), "store_nbr").agg(
        F.sum("transactions").alias("transactions")
    )


def monthly_oil(oil: DataFrame) -> DataFrame:
    return oil.groupBy(month_start("date").alias("snapshot_date")).agg(F.avg("dcoilwtico").alias("avg_dcoilwtico"))


def daily_pairs(sales: DataFrame) -> DataFrame:
    """One row per store, family and day: the grain of the daily panel."""
    return sales.groupBy(*PAIR, "date").agg(
        F.sum("sales").alias("sales"),
        F.count("sales").alias("n_sales"),
        F.sum("onpromotion").alias("onpromotion"),
    )


def weekly_sales(daily: DataFrame) -> DataFrame:
    """Sum per store, family and Monday week."""
    return daily.groupBy(*PAIR, week_start("date").alias("week_start")).agg(F.sum("sales").alias("sales_week"))


def first_active(sales: DataFrame, keys: list[str]) -> DataFrame:
    """First month with a sale above zero, per key."""
    return (
        sales.where(F.col("sales") > 0)
        .groupBy(*keys)
        .agg(F.min(month_start("date")).alias("first_active_month"))
    )


def first_active_all_grains(sales: DataFrame) -> DataFrame:
    """The three start-date tables (store, family, both) from one scan.

    The minimum at the pair grain is taken first, so grouping sets expand pairs instead of raw rows.
    """
    pairs = first_active(sales, PAIR)
    return (
        pairs.groupingSets([["store_nbr"], ["family"], ["store_nbr", "family"]], "store_nbr", "family")
        .agg(F.min("first_active_month").alias("first_active_month"), F.grouping_id().alias("g"))
        .select(
            F.when(F.col("g") == 1, "store").when(F.col("g") == 2, "family").otherwise("store_family").alias("grain"),
            "store_nbr",
            "family",
            "first_active_month",
        )
    )


def active_months(sales: DataFrame, keys: list[str]) -> DataFrame:
    """Months whose total is above zero, per key."""
    return (
        sales.groupBy(*keys, month_start("date").alias("snapshot_date"))
        .agg(F.sum("sales").alias("sales"))
        .where(F.col("sales") > 0)
    )


def first_active_by_total(sales: DataFrame, keys: list[str]) -> DataFrame:
    """First month whose total is above zero, per key."""
    return active_months(sales, keys).groupBy(*keys).agg(F.min("snapshot_date").alias("first_active_month"))


def late_starters(starts: DataFrame, dataset_start: str) -> DataFrame:
    return starts.where(F.col("first_active_month") > F.lit(dataset_start).cast("date"))


def starts_per_month(starts: DataFrame) -> DataFrame:
    return starts.groupBy("first_active_month").agg(F.count("*").alias("num_new_pairs"))
