"""Daily tables to the monthly feature store and label store, for all months or for one."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.calendar import join_calendar
from shelfcast.operators import clean, holidays, rollup, trailing
from shelfcast.session import written
from shelfcast.sources import files, retail, schemas


@dataclass(frozen=True)
class Retail:
    """The daily inputs, cleaned, and the monthly holiday table."""

    sales: DataFrame
    transactions: DataFrame
    oil: DataFrame
    holiday_features: DataFrame


@dataclass(frozen=True)
class MonthTables:
    """The monthly roll-ups, and the months with sales in S-2, S-1 and S."""

    sales: DataFrame
    transactions: DataFrame
    oil: DataFrame
    holiday_features: DataFrame
    ready: DataFrame


def clean_inputs(spark: SparkSession, sf_dir: str) -> Retail:
    return Retail(
        sales=clean.silver(retail.daily_sales(spark, sf_dir), schemas.SALES_TYPES, schemas.SALES_KEYS),
        transactions=clean.silver(
            retail.daily_transactions(spark, sf_dir), schemas.TRANSACTION_TYPES, schemas.TRANSACTION_KEYS
        ),
        oil=clean.silver_oil(retail.oil_prices(spark, sf_dir), schemas.OIL_TYPES, schemas.OIL_KEYS),
        holiday_features=holidays.with_next_month(
            holidays.monthly_holidays(retail.holidays_events(spark, sf_dir))
        ),
    )


def _since(df: DataFrame, month: str | None) -> DataFrame:
    """Only the three months a single-month run needs; the date predicate reaches the scan."""
    if month is None:
        return df
    last = F.lit(month).cast("date")
    return df.where(F.col("date").between(F.add_months(last, -2), F.last_day(last)))


def _only(df: DataFrame, month: str | None) -> DataFrame:
    return df if month is None else df.where(F.col("snapshot_date") == F.lit(month).cast("date"))


def feature_store(data: Retail, month: str | None = None) -> DataFrame:
    """Key and 34 features for every pair and month that has its two months of history.

    With ``month`` the inputs are cut to the three months needed, and the result equals that month of
    the full plan: the windows look back two calendar months and no further.
    """
    return feature_rows(month_tables(data, month), month)


def month_tables(data: Retail, month: str | None = None) -> MonthTables:
    sales = _since(data.sales, month)
    return MonthTables(
        sales=rollup.monthly_sales(sales),
        transactions=rollup.monthly_transactions(_since(data.transactions, month)),
        oil=rollup.monthly_oil(_since(data.oil, month)),
        holiday_features=data.holiday_features,
        ready=ready_months(sales),
    )


def feature_rows(tables: MonthTables, month: str | None = None) -> DataFrame:
    """The feature store from the monthly roll-ups."""
    return _with_month_columns(_only(pair_features(tables), month), tables)


def pair_features(tables: MonthTables) -> DataFrame:
    """The monthly sales and the columns that differ between the pairs of a month.

    All windows and joins are within a store: ``tables.sales`` that lies by store is not shuffled again.
    """
    return trailing.with_transactions(trailing.sales_features(tables.sales), tables.transactions)


def _with_month_columns(rows: DataFrame, tables: MonthTables) -> DataFrame:
    """The rows of ready months, and beside them the prices and holidays that a whole month shares."""
    oil = trailing.oil_features(tables.oil)
    month_table = join_calendar(join_calendar(tables.ready, oil), tables.holiday_features)
    return join_calendar(rows, month_table, how="inner").select(
        "snapshot_date", *schemas.JOIN_KEYS, *[F.col(f"`{c}`") for c in schemas.NUMERIC_FEATURES]
    )


def write_stores(
    tables: MonthTables, features: str, labels: str, changed: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Feature store and label store by month into the two paths, for the ready months or those ``changed``; opened.

    The pair columns are stored first: months, labels and features read them. ``tables.ready`` is not read. Rows go to
    their files before they get the columns that a whole month shares: those are most of a row.
    """
    pairs = written(pair_features(tables), "pair_features")
    ready = trailing.complete_months(pairs.select("snapshot_date").distinct())
    if changed is not None:
        ready = join_calendar(ready, changed, how="left_semi")
    tables = replace(tables, sales=pairs, ready=written(ready, "ready_months"))
    narrow = trailing.keep_months(pairs, tables.ready).drop("sales", "onpromotion_sum", "onpromotion_avg")
    rows, label = _with_month_columns(files.by_month(narrow), tables), label_rows(tables)
    files.write_months(rows, features, placed=True)
    files.write_months(label, labels)
    spark = pairs.sparkSession
    return files.read_table(spark, features, rows.schema), files.read_table(spark, labels, label.schema)


def ready_months(sales: DataFrame) -> DataFrame:
    """Months with sales in S-2, S-1 and S."""
    months = sales.select(F.trunc("date", "month").alias("snapshot_date")).distinct()
    return trailing.complete_months(months)


def label_store(data: Retail, month: str | None = None, label_at: str = "S") -> DataFrame:
    """Sales of month S as the label, filed under S (paired with features of S-1) or under S-1."""
    return label_rows(month_tables(data, month), month, label_at)


def label_rows(tables: MonthTables, month: str | None = None, label_at: str = "S") -> DataFrame:
    """The label store from the monthly roll-ups."""
    kept = trailing.keep_months(_only(tables.sales, month), tables.ready)
    if label_at not in ("S", "S-1"):
        raise ValueError("label_at must be S or S-1")
    filed = F.col("snapshot_date") if label_at == "S" else F.add_months("snapshot_date", -1)
    return kept.select(filed.alias("snapshot_date"), *schemas.JOIN_KEYS, F.col("sales").alias(schemas.LABEL))
