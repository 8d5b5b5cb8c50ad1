"""Cleaning and schema enforcement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import join_calendar
from shelfcast.functions.dates import month_start, tolerant_date
from shelfcast.functions.text import truth_flag
from shelfcast.sources.schemas import UNKNOWN_CATEGORY, spark_type

NUMERIC_TYPES = ("int", "bigint", "float", "double")


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    """The same table, or an error naming the missing columns before any job starts."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def date_column(df: DataFrame) -> str:
    """First column whose name contains "date"."""
    for c in df.columns:
        if "date" in c.lower():
            return c
    raise ValueError("no date column")


def add_month_columns(df: DataFrame, column: str = "date") -> DataFrame:
    """``snapshot_date`` (first of month), ``year`` and ``month`` from a date column."""
    return df.withColumns(
        {"snapshot_date": month_start(column), "year": F.year(column), "month": F.month(column)}
    )


def _typed(df: DataFrame, name: str, type_name: str) -> Column:
    column = F.col(f"`{name}`")
    if type_name == "bool":
        return truth_flag(column).cast("boolean").alias(name)
    if type_name == "date" and dict(df.dtypes)[name] == "string":
        return tolerant_date(column).alias(name)
    return column.try_cast(spark_type(type_name)).alias(name)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Configured casts for the columns that exist, others unchanged; a bad value becomes null."""
    return df.select(*[_typed(df, c, types[c]) if c in types else F.col(f"`{c}`") for c in df.columns])


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    for key in keys:
        if key in df.columns:
            df = df.where(F.col(key).isNotNull())
    return df


def impute_by_month(df: DataFrame, value: str, month: str = "snapshot_date") -> DataFrame:
    """Null values become the mean of their month; a month without any value stays null.

    The mean comes from a map-side combined aggregate joined back as a month table, not from a window
    over the month, so a month of any size is never gathered in one task.
    """
    number = F.col(value).try_cast("double")
    means = df.groupBy(month).agg(F.avg(number).alias("_mean"))
    filled = F.coalesce(number, F.col("_mean"))
    return join_calendar(df, means, month).withColumn(value, filled).drop("_mean")


def fill_numbers(df: DataFrame, columns: list[str], value: float = 0) -> DataFrame:
    """Nulls of the given numeric columns become a constant."""
    return df.fillna({c: value for c in columns if c in df.columns})


def fill_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna({c: UNKNOWN_CATEGORY for c in columns if c in df.columns})


def complete_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES]


def select_present(df: DataFrame, wanted: list[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns that exist, and the names of those that do not."""
    missing = [c for c in wanted if c not in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns]), missing


def silver(df: DataFrame, types: dict[str, str], keys: list[str]) -> DataFrame:
    """Null keys out, month columns in, configured types on."""
    return cast_columns(add_month_columns(drop_null_keys(df, keys)), types)


def silver_oil(df: DataFrame, types: dict[str, str], keys: list[str]) -> DataFrame:
    """The price table is silver with missing prices filled from their month before the cast.

    The month is non-null wherever the date is; saying so gives the rows and their means the same
    filters, so one shuffle feeds both.
    """
    dated = add_month_columns(drop_null_keys(df, keys)).where(F.col("snapshot_date").isNotNull())
    return cast_columns(impute_by_month(dated, "dcoilwtico"), types)
