"""Date columns: month and week keys, tolerant parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c: str | Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(c, "month")


def month_end(c: str | Column) -> Column:
    return F.last_day(c)


def month_index(c: str | Column) -> Column:
    """Months counted on one line, so that a range frame of -2..0 is three calendar months."""
    return F.year(c) * 12 + F.month(c)


def shift_months(c: str | Column, n: int) -> Column:
    return F.add_months(c, n)


def week_start(c: str | Column) -> Column:
    """Monday of the week, as DATE."""
    return F.date_trunc("week", c).cast("date")


def weekday_monday0(c: str | Column) -> Column:
    return F.weekday(c)


def iso_week(c: str | Column) -> Column:
    return F.weekofyear(c)


def tolerant_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Parsed date, null where the text is no date."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c, F.lit(fmt)).cast("date")


def snapshot_from_tag(c: str | Column) -> Column:
    """Date of a partition tag in either spelling: 2015-06-01 or 2015_06_01."""
    return F.coalesce(tolerant_date(c, "yyyy-MM-dd"), tolerant_date(c, "yyyy_MM_dd"))


def snapshot_tag(c: str | Column) -> Column:
    return F.date_format(c, "yyyy_MM_dd")
