"""Tables with one row per calendar month or day, and joins against them.

Such a table is bounded by the calendar whatever the size of the data: the DATE domain 0001 to 9999
has 119,988 months and 3.7 million days, a few tens of megabytes at most. That bound is what makes
the broadcast below safe; every caller passes the output of a grouping by month (or day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def join_calendar(df: DataFrame, calendar: DataFrame, on: str | list[str] = "snapshot_date", how: str = "left"):
    """Join a big table to a calendar table without shuffling the big side."""
    return df.join(F.broadcast(calendar), on, how)


def months_window(first: int, last: int):
    """A frame over the month table itself; one task is enough for calendar many rows."""
    return Window.orderBy("month_idx").rangeBetween(first, last)
