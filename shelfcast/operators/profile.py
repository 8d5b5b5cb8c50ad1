"""Profiling queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.functions.dates import month_start
from shelfcast.functions.quantiles import exact_quantiles
from shelfcast.operators.clean import numeric_columns


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack([t.agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows")) for n, t in tables.items()])


def date_ranges(tables: dict[str, DataFrame]) -> DataFrame:
    """First and last date of every table that has a date column."""
    return _stack(
        [
            t.agg(F.lit(n).alias("table_name"), F.min("date").alias("min_date"), F.max("date").alias("max_date"))
            for n, t in tables.items()
            if "date" in t.columns
        ]
    )


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def distinct_per_group(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(column).alias(name))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def _long_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").cast("double").alias("x")) for c in columns])
    )
    return df.select(pairs.alias("p")).select("p.variable", "p.x")


def describe_numbers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact interpolated quartiles per numeric column."""
    columns = columns or numeric_columns(df)
    long = _long_numbers(df, columns)
    simple = long.groupBy("variable").agg(
        F.count("x").alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    quartiles = exact_quantiles(long, "variable", "x", [0.25, 0.5, 0.75]).select(
        "variable",
        F.get("quantiles", F.lit(0)).alias("p25"),
        F.get("quantiles", F.lit(1)).alias("p50"),
        F.get("quantiles", F.lit(2)).alias("p75"),
    )
    return simple.join(F.broadcast(quartiles), "variable", "left")  # one row per column


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per text column.

    Values are counted first, so only distinct values reach the second step, which combines map-side.
    """
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("v")) for c in columns])
        ).alias("p")
    ).select("p.variable", "p.v")
    counted = long.where(F.col("v").isNotNull()).groupBy("variable", "v").agg(F.count("*").alias("n"))
    return counted.groupBy("variable").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("top"),
        F.max("n").alias("freq"),
    )


def day_bits(date: str) -> Column:
    """The days of a group within one month, a bit each: merged on the map side, counted by ``bit_count``."""
    return F.bit_or(F.when(F.col(date).isNotNull(), F.expr(f"shiftleft(1, dayofmonth(`{date}`) - 1)")))


def panel_density(sales: DataFrame) -> DataFrame:
    """Rows against days x stores x families; null dates, stores and families are no value of their own.

    The daily rows become one row per store, family and month, with the month's days as bits; only these are grouped
    by month, by store and by family.
    """
    state = sales.groupBy("store_nbr", "family", month_start("date").alias("month")).agg(
        day_bits("date").alias("days"), F.count("*").alias("n")
    )
    grouped = state.groupingSets([["month"], ["store_nbr"], ["family"]], "month", "store_nbr", "family").agg(
        F.bit_or("days").alias("days"), F.sum("n").alias("n"), F.grouping_id().alias("g")
    )
    of_month, of_store, of_family = (F.col("g") == g for g in (0b011, 0b101, 0b110))
    counts = grouped.agg(
        F.coalesce(F.sum(F.when(of_month, F.bit_count("days"))), F.lit(0)).alias("n_days"),
        F.count_if(of_store & F.col("store_nbr").isNotNull()).alias("n_stores"),
        F.count_if(of_family & F.col("family").isNotNull()).alias("n_families"),
        F.coalesce(F.sum(F.when(of_month, F.col("n"))), F.lit(0)).alias("n_rows"),
    )
    return counts.withColumn("full_panel_rows", F.col("n_days") * F.col("n_stores") * F.col("n_families"))


def values_per_month(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(month_start("date").alias("snapshot_date")).agg(F.count(column).alias("non_null_count"))


def months_without_value(df: DataFrame, column: str) -> DataFrame:
    return values_per_month(df, column).where(F.col("non_null_count") == 0)


def busy_store_months(transactions: DataFrame) -> DataFrame:
    """Store-months with more than one distinct day; the days are bits, so rows are shuffled combined."""
    days = transactions.groupBy("store_nbr", month_start("date").alias("snapshot_date")).agg(
        F.bit_count(day_bits("date")).cast("long").alias("n_unique_days")
    )
    return days.where(F.col("n_unique_days") > 1)


def null_summary(df: DataFrame) -> DataFrame:
    """Columns with nulls and how many."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column_name", "n_nulls").where(
        F.col("n_nulls") > 0
    )


def promo_values_per_month(sales: DataFrame) -> DataFrame:
    """Distinct promotion values per store, family and month, and whether there is just one."""
    return (
        sales.groupBy("store_nbr", "family", month_start("date").alias("snapshot_date"))
        .agg(F.count_distinct("onpromotion").alias("unique_promo_values"))
        .withColumn("is_constant", F.col("unique_promo_values") == 1)
    )


def promo_constancy(sales: DataFrame) -> DataFrame:
    return promo_values_per_month(sales).groupBy("is_constant").agg(F.count("*").alias("n"))


def promo_change_share(sales: DataFrame) -> DataFrame:
    """Pairs whose monthly mean promotion changes over time, and their share."""
    monthly = sales.groupBy("store_nbr", "family", month_start("date").alias("snapshot_date")).agg(
        F.avg("onpromotion").alias("mean_promo")
    )
    per_pair = monthly.groupBy("store_nbr", "family").agg(F.count_distinct("mean_promo").alias("n_means"))
    return per_pair.agg(F.count_if(F.col("n_means") > 1).alias("changing"), F.count("*").alias("total")).withColumn(
        "share", F.col("changing") / F.col("total")
    )


def running_total(monthly_starts: DataFrame) -> DataFrame:
    """Cumulative count over the month table."""
    so_far = Window.orderBy("first_active_month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly_starts.withColumn("cumulative_pairs", F.sum("num_new_pairs").over(so_far))


def next_month_alignment(holiday_features: DataFrame, base: str = "num_holidays_total") -> DataFrame:
    """How many months carry, as next-month value, the value of the following row."""
    following = Window.orderBy("snapshot_date")
    compared = holiday_features.withColumn("shifted", F.lead(base).over(following))
    differs = ~F.coalesce(F.col(f"{base}_NM") == F.col("shifted"), F.lit(False))
    return compared.agg(
        F.count("*").alias("n_months"), F.count_if(differs).alias("mismatches")
    ).withColumn("aligned", F.col("n_months") - F.col("mismatches"))
