"""Histograms of the monitored variables, stored per reference and month.

The edges of a reference are fixed once. A month is counted once under them, when it comes or when it is written again,
and replaces just its own partition; a report then reads the counts of its month and of the reference, not the
features. Several references stand side by side. The tables have variables x bins rows per reference and month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import drift
from shelfcast.plans.jobs import Layout
from shelfcast.sources.schemas import DRIFT_BINS

EDGES, COUNTS = "drift_edges", "drift_counts"
EDGES_SCHEMA = "variable string, edges array<double>, reference_date date"
COUNTS_SCHEMA = "variable string, bin int, lower double, n long, reference_date date, snapshot_date date"


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    (
        df.hint("rebalance", *[F.col(c) for c in partitions])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def _day(text: str):
    return F.lit(text).cast("date")


def fix_edges(
    features: DataFrame,
    at: Layout,
    reference: str,
    variables: list[str],
    n_bins: int = DRIFT_BINS,
    method: str = "quantile",
) -> None:
    """Bin edges from the reference month. Counts made under earlier edges of it have to be made again."""
    edges = drift.reference_edges(features, reference, variables, n_bins, method)
    _replace(edges.withColumn("reference_date", _day(reference)), at.gold(EDGES), "reference_date")


def edges_of(spark: SparkSession, at: Layout, reference: str) -> DataFrame:
    stored = spark.read.schema(EDGES_SCHEMA).parquet(at.gold(EDGES))
    return stored.where(F.col("reference_date") == _day(reference)).drop("reference_date")


def count_months(features: DataFrame, at: Layout, reference: str, months: list[str] | None = None) -> None:
    """Counts of the months given, or of all, under the reference's edges; empty bins are stored as zeros.

    The months are a partition filter on ``features``. A month without rows is left as it is.
    """
    edges = edges_of(features.sparkSession, at, reference)
    found = edges.agg(F.collect_set("variable"), F.max(F.size("edges"))).first()
    variables, n_edges = sorted(found[0]), found[1]
    if not variables:
        raise ValueError(f"no edges are stored for the reference {reference}")
    if months is not None:
        features = features.where(F.col("snapshot_date").isin([_day(m) for m in months]))
    present = features.select("snapshot_date").distinct()
    counts = drift.histogram(drift.long_values(features, variables), edges, n_edges - 1)
    filled = drift.filled_counts(counts, edges, present)
    _replace(
        filled.select(
            "variable", "bin", "lower", F.col("n").cast("long").alias("n"), _day(reference).alias("reference_date"), "snapshot_date"
        ),
        at.gold(COUNTS),
        "reference_date",
        "snapshot_date",
    )


def comparison(spark: SparkSession, at: Layout, reference: str, months: list[str] | None = None) -> DataFrame:
    """Shares beside the reference's for the months given and the reference, or for all that are counted.

    The same rows as ``drift.binned_comparison`` gives from the features. The reference has to be counted too.
    """
    stored = spark.read.schema(COUNTS_SCHEMA).parquet(at.gold(COUNTS))
    own = stored.where(F.col("reference_date") == _day(reference)).drop("reference_date")
    if months is not None:
        own = own.where(F.col("snapshot_date").isin([_day(m) for m in {*months, reference}]))
    return drift.beside_reference(drift.with_shares(own), reference)
