"""Daily panel features: lags, rolling statistics and multi-day targets.

The panel has one row per store, family and day, so a window group is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.operators.rollup import PAIR


def by_day():
    return Window.partitionBy(*PAIR).orderBy("date")


def full_frame(value: Column, counted: str, frame, rows: int) -> Column:
    """The aggregate, or null while the frame holds fewer than ``rows`` values."""
    return F.when(F.count(counted).over(frame) == rows, value.over(frame))


def lags(daily: DataFrame) -> DataFrame:
    return daily.withColumns(
        {"sales_lag_1": F.lag("sales", 1).over(by_day()), "sales_lag_7": F.lag("sales", 7).over(by_day())}
    )


def rolling(daily: DataFrame, rows: int = 7) -> DataFrame:
    """Mean and sample deviation of the ``rows`` rows before the current one."""
    frame = by_day().rowsBetween(-rows, -1)
    return daily.withColumns(
        {
            f"rolling_mean_{rows}": full_frame(F.avg("sales"), "sales", frame, rows),
            f"rolling_std_{rows}": full_frame(F.stddev_samp("sales"), "sales", frame, rows),
        }
    )


def calendar_columns(daily: DataFrame) -> DataFrame:
    return daily.withColumns({"day_of_week": F.weekday("date"), "month": F.month("date")})


def future_targets(daily: DataFrame, horizon: int = 7) -> DataFrame:
    return daily.withColumns({f"y_d{i}": F.lead("sales", i).over(by_day()) for i in range(1, horizon + 1)})


def daily_features(daily: DataFrame) -> DataFrame:
    """All of the above; every window shares one shuffle and one sort."""
    return future_targets(calendar_columns(rolling(lags(daily))))
