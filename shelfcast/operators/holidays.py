"""Monthly holiday features and daily holiday flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import join_calendar, months_window
from shelfcast.functions.dates import month_index, month_start
from shelfcast.functions.text import truth_flag
from shelfcast.sources.schemas import HOLIDAY_LOCALE_VALUES, HOLIDAY_TYPE_VALUES


def monthly_holidays(
    holidays: DataFrame,
    types: list[str] = HOLIDAY_TYPE_VALUES,
    locales: list[str] = HOLIDAY_LOCALE_VALUES,
) -> DataFrame:
    """Counts per month: all, transferred, and one column per listed type and locale.

    The lists are declared, so the output schema is known before any data is read.
    """
    per_value = [F.count_if(F.col("type") == v).alias(f"num_holidays_type_{v}") for v in types]
    per_value += [F.count_if(F.col("locale") == v).alias(f"num_holidays_locale_{v}") for v in locales]
    return holidays.groupBy(month_start("date").alias("snapshot_date")).agg(
        F.count("*").alias("num_holidays_total"),
        F.sum(truth_flag("transferred")).alias("num_transferred"),
        *per_value,
    )


def with_next_month(monthly: DataFrame) -> DataFrame:
    """Beside each month the counts of the calendar month after it; null when that month has no row.

    A range frame of exactly one month ahead respects gaps and needs the month table only once.
    """
    ahead = months_window(1, 1)
    counts = [c for c in monthly.columns if c != "snapshot_date"]
    return monthly.withColumn("month_idx", month_index("snapshot_date")).select(
        "snapshot_date",
        *[F.col(f"`{c}`") for c in counts],
        *[F.max(F.col(f"`{c}`")).over(ahead).alias(f"{c}_NM") for c in counts],
    )


def holiday_dates(holidays: DataFrame, locale: str = "National") -> DataFrame:
    """Each date with at least one event of the locale, once."""
    return holidays.where(F.col("locale") == locale).select("date").distinct()


def flag_holidays(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """``is_holiday`` 1 or 0; dates are distinct, so no row is multiplied."""
    marked = dates.select("date", F.lit(1).alias("_hit"))
    return join_calendar(daily, marked, "date").withColumn("is_holiday", F.coalesce("_hit", F.lit(0))).drop("_hit")
