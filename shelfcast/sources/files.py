"""Scans and sinks: CSV, JSON, month-partitioned and plain Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.dates import snapshot_from_tag

MONTH = "snapshot_date"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema: one pass, no inference job."""
    return spark.read.csv(path, header=True, schema=schema)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_month(spark: SparkSession, path: str, month: str) -> DataFrame:
    """One month of a partitioned table; the predicate is a partition filter."""
    return read_table(spark, path).where(F.col(MONTH) == F.lit(month).cast("date"))


def read_months(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """A closed range of months in a single scan."""
    return read_table(spark, path).where(F.col(MONTH).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def read_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """All Parquet files below a folder whose name matches."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(path)


def snapshots(df: DataFrame) -> DataFrame:
    """The months present in a table, one row each."""
    return df.select(MONTH).distinct()


def snapshots_from_tags(tags: DataFrame, column: str) -> DataFrame:
    """Months named by partition tags in either spelling; other names are ignored."""
    parsed = tags.select(snapshot_from_tag(column).alias(MONTH))
    return parsed.where(F.col(MONTH).isNotNull()).distinct()


def by_month(df: DataFrame) -> DataFrame:
    """Rows of a month side by side: packs a month into few files and splits a month that is too large for one task."""
    return df.hint("rebalance", F.col(MONTH))


def write_months(df: DataFrame, path: str, placed: bool = False) -> None:
    """Replace just the months present in ``df``; running again gives the same table.

    ``placed`` rows went through ``by_month`` before they got further columns and are not shuffled again.
    """
    (
        (df if placed else by_month(df))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def write_reference(df: DataFrame, path: str) -> None:
    """Replace a whole reference table."""
    df.write.mode("overwrite").parquet(path)


#: Folders of a table by pair, whatever the number of pairs.
PAIR_FOLDERS = 256


def _pair_folder(keys: list[Column], folders: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(folders)).cast("int")


def write_by_pair(df: DataFrame, path: str, keys: list[str], folders: int = PAIR_FOLDERS) -> None:
    """Every key combination in one of a fixed number of folders, in a single write; large folders are split over tasks.

    A folder per combination costs a file, a rename and a listing each, and their number grows with the data. Rows of a
    combination lie side by side in their files, so a read of one skips the row groups of the others.
    """
    placed = df.withColumn("pair_folder", _pair_folder([F.col(k) for k in keys], folders))
    rows = placed.hint("rebalance", F.col("pair_folder")).sortWithinPartitions("pair_folder", *keys)
    rows.write.mode("overwrite").partitionBy("pair_folder").parquet(path)


def read_pair(spark: SparkSession, path: str, pair: dict[str, str], folders: int = PAIR_FOLDERS) -> DataFrame:
    """One key combination of a table by pair, from its folder alone; ``pair`` has the keys in the order of the write."""
    rows = read_table(spark, path).where(F.col("pair_folder") == _pair_folder([F.lit(v) for v in pair.values()], folders))
    for key, value in pair.items():
        rows = rows.where(F.col(key).eqNullSafe(F.lit(value)))
    return rows.drop("pair_folder")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def append_events(df: DataFrame, path: str) -> None:
    """Append to an event log table."""
    df.write.mode("append").parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Nested records, one per line or one per file; text that does not parse is left out."""
    wanted = T.StructType(schema.fields + [T.StructField("_broken", T.StringType())])
    text = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .text(path, wholetext=multi_line)
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    parsed = text.select(F.from_json("value", wanted, options).alias("record"))
    return parsed.where(F.col("record._broken").isNull()).select(
        *[F.col(f"record.`{f.name}`").alias(f.name) for f in schema.fields]
    )
