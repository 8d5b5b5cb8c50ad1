"""The monthly stores kept up by new days alone.

The state of a daily table has one row of sums per month, key and batch of new files. A batch writes only its own
partitions (month, batch), so landing it again after a failure replaces what the first attempt left; a month's
roll-up is the sum over its batches. New days change the state of their months, and the features of
these months and of the two after them: only those partitions of the stores are written again.

Files arrive through a file stream with a checkpoint: each raw file is read once ever. Its batch lands and
refreshes in one step, and the stream repeats the step if it did not end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.calendar import join_calendar
from shelfcast.functions.dates import tolerant_date
from shelfcast.operators import clean, rollup
from shelfcast.plans import monthly
from shelfcast.plans.jobs import DATASETS, DERIVED, Layout
from shelfcast.session import written
from shelfcast.sources import schemas

#: Keys of the state below its month, and how its sums are named.
KEYS = {"daily_sales": rollup.PAIR, "daily_transactions": ["store_nbr"]}
SUMS = {
    "daily_sales": {"sales": "double", "n": "long", "promoted": "double", "n_promoted": "long"},
    "daily_transactions": {"transactions": "long", "n": "long"},
}


def sums(rows: DataFrame, table: str) -> DataFrame:
    """One mergeable row per month and key of cleaned daily rows."""
    added = {
        "daily_sales": [
            F.sum("sales").alias("sales"),
            F.count("sales").alias("n"),
            F.sum(F.col("onpromotion").cast("float")).alias("promoted"),
            F.count("onpromotion").alias("n_promoted"),
        ],
        "daily_transactions": [F.sum("transactions").alias("transactions"), F.count("transactions").alias("n")],
    }
    return rows.groupBy("snapshot_date", *KEYS[table]).agg(*added[table])


def state_schema(table: str) -> T.StructType:
    columns = {k: "string" for k in KEYS[table]} | SUMS[table] | {"snapshot_date": "date", "batch": "string"}
    return T.StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in columns.items()))


def land(at: Layout, table: str, rows: DataFrame, batch: str) -> DataFrame:
    """The batch's sums into the state; gives the months it holds, one row each. Rows without a date are left out.

    The months are the folders of the batch, so its rows are neither kept twice nor read for them.
    """
    (
        sums(rows.where(F.col("snapshot_date").isNotNull()), table)
        .withColumn("batch", F.lit(batch))
        .hint("rebalance", F.col("snapshot_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date", "batch")
        .parquet(at.state(table))
    )
    stored = rows.sparkSession.read.schema(state_schema(table)).parquet(at.state(table))
    return stored.where(F.col("batch") == batch).select("snapshot_date").distinct()


def rolled_up(spark: SparkSession, at: Layout, table: str, months: DataFrame | None = None) -> DataFrame:
    """The monthly roll-up over all batches, for the months given; empty while nothing has landed.

    ``months`` is a calendar table, so its broadcast prunes the partitions that are read. The result lies by store, where
    the windows of the features need it: batches, months and windows share one shuffle.
    """
    schema = state_schema(table)
    stored = spark.read.schema(schema).parquet(at.state(table)) if _there(spark, at.state(table)) else None
    if stored is None:
        stored = spark.createDataFrame([], schema)
    if months is not None:
        stored = join_calendar(stored, months, how="left_semi")
    added = stored.repartition("store_nbr").groupBy("snapshot_date", *KEYS[table]).agg(*[F.sum(c).alias(c) for c in SUMS[table]])
    if table == "daily_transactions":
        return added.drop("n")
    return added.select(
        "snapshot_date",
        *rollup.PAIR,
        F.when(F.col("n") > 0, F.col("sales")).alias("sales"),
        F.when(F.col("n_promoted") > 0, F.col("promoted")).alias("onpromotion_sum"),
        F.when(F.col("n_promoted") > 0, F.col("promoted") / F.col("n_promoted")).alias("onpromotion_avg"),
    )


def _there(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def refresh(spark: SparkSession, at: Layout, touched: DataFrame, oil: DataFrame, holiday_features: DataFrame) -> None:
    """Features and labels of the touched months and of the two after them, from five months of state around each.

    ``oil`` (cleaned days) and ``holiday_features`` are calendar tables and handed in whole.
    """

    def shifted(months: DataFrame, *by: int) -> DataFrame:
        every = F.explode(F.array(*[F.add_months("snapshot_date", k) for k in by]))
        return months.select(every.alias("snapshot_date")).distinct()

    changed = written(shifted(touched, 0, 1, 2), "changed-months")
    needed = written(shifted(changed, -2, -1, 0), "needed-months")
    tables = monthly.MonthTables(
        sales=rolled_up(spark, at, "daily_sales", needed),
        transactions=rolled_up(spark, at, "daily_transactions", needed),
        oil=rollup.monthly_oil(oil),
        holiday_features=holiday_features,
        ready=changed,
    )
    monthly.write_stores(tables, at.gold("feature_store"), at.gold("label_store"), changed)


def cleaned(rows: DataFrame, table: str) -> DataFrame:
    """Raw text rows of a daily table, as the silver layer has them."""
    _, types, keys = DATASETS[table]
    dated = clean.require_columns(rows, ["date"]).withColumn("date", tolerant_date("date"))
    return clean.silver(dated, types, keys)


def land_new_files(
    spark: SparkSession, at: Layout, table: str, oil: DataFrame | None = None, holiday_features: DataFrame | None = None
) -> int:
    """All CSV files of ``<raw>/<table>`` that have not landed yet; gives the number of rows read.

    With ``oil`` and ``holiday_features`` the stores are refreshed too. A file must not change once it is there.
    """
    _, types, _ = DATASETS[table]
    schema = schemas.raw_schema({c: t for c, t in types.items() if c not in DERIVED})

    def step(rows: DataFrame, number: int) -> None:
        touched = land(at, table, cleaned(rows, table), f"{number:09d}")
        if oil is not None and holiday_features is not None:
            refresh(spark, at, touched, oil, holiday_features)

    query = (
        spark.readStream.schema(schema)
        .option("header", True)
        .csv(f"{at.raw}/{table}")
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", f"{at.state(table)}-files")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)
