"""Weekly panel: roll-up with holiday flags, trailing weeks, lags and next-week rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.functions.dates import iso_week, week_start
from shelfcast.operators import holidays, panel
from shelfcast.operators.rollup import PAIR


def by_week():
    return Window.partitionBy(*PAIR).orderBy("week_start")


def weekly_rollup(sales: DataFrame, holiday_dates: DataFrame) -> DataFrame:
    """Sum, mean, days with sales and a holiday flag per store, family and Monday week.

    One aggregate over the sales, with one shuffle: the days of a week are a bit each, so they need no grouping by
    day first, and the mean is that of the original rows. Sales without a date count no day.
    """
    flagged = holidays.flag_holidays(sales, holiday_dates)
    days = F.bit_or(F.expr("shiftleft(1, weekday(date))"))
    return flagged.groupBy(*PAIR, week_start("date").alias("week_start")).agg(
        F.sum("sales").alias("weekly_sales_sum"),
        (F.sum("sales") / F.count("sales")).alias("weekly_sales_avg"),
        F.coalesce(F.bit_count(days), F.lit(0)).cast("long").alias("days_in_week"),
        F.max("is_holiday").alias("any_holiday"),
    )


def trailing_weeks(weekly: DataFrame) -> DataFrame:
    """Mean and sum of the two and the three weeks before, 0 where there is none."""
    two, three = by_week().rowsBetween(-2, -1), by_week().rowsBetween(-3, -1)
    return weekly.withColumns(
        {
            "avg_sales_14d": F.avg("weekly_sales_avg").over(two),
            "avg_sales_28d": F.avg("weekly_sales_avg").over(three),
            "sum_sales_14d": F.sum("weekly_sales_sum").over(two),
            "sum_sales_28d": F.sum("weekly_sales_sum").over(three),
        }
    ).fillna(0.0, ["avg_sales_14d", "avg_sales_28d", "sum_sales_14d", "sum_sales_28d"])


def lag_features(weekly: DataFrame) -> DataFrame:
    """Last week's sales, mean of the four weeks before, ISO week."""
    four = by_week().rowsBetween(-4, -1)
    return weekly.withColumns(
        {
            "sales_lag_1": F.lag("sales_week", 1).over(by_week()),
            "sales_avg_4": panel.full_frame(F.avg("sales_week"), "sales_week", four, 4),
            "weekofyear": iso_week("week_start"),
        }
    )


def latest_weeks(weekly: DataFrame, n: int = 4) -> DataFrame:
    """The last ``n`` rows of every pair."""
    newest = Window.partitionBy(*PAIR).orderBy(F.col("week_start").desc())
    return weekly.withColumn("age", F.row_number().over(newest)).where(F.col("age") <= n)


def next_week_rows(weekly: DataFrame) -> DataFrame:
    """One feature row per pair for the week after the last week of the data."""
    next_week = weekly.agg(iso_week(F.date_add(F.max("week_start"), 7))).scalar()
    return (
        latest_weeks(weekly)
        .groupBy(*PAIR)
        .agg(
            F.max(F.when(F.col("age") == 1, F.col("sales_week"))).alias("sales_lag_1"),
            F.avg("sales_week").alias("sales_avg_4"),
        )
        .withColumn("weekofyear", next_week)
    )
