"""Predictions against labels, and error statistics that add up over months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.functions.metrics import all_metrics, r2_from
from shelfcast.sources.schemas import JOIN_KEYS, LABEL, PREDICTION


def naive_predictions(features: DataFrame, column: str = "sales_LM") -> DataFrame:
    """Last month's sales as the forecast: a model-free prediction table."""
    return features.select(*JOIN_KEYS, "snapshot_date", F.col(column).cast("double").alias(PREDICTION))


def evaluation_rows(labels: DataFrame, predictions: DataFrame, label_at: str = "S") -> DataFrame:
    """Labels of month S with the predictions made in S-1, by pair.

    ``snapshot_date`` of the result is the month the label belongs to.
    """
    shift = 0 if label_at == "S" else 1
    actual = labels.select(F.add_months("snapshot_date", shift).alias("snapshot_date"), *JOIN_KEYS, LABEL)
    made = predictions.select(F.add_months("snapshot_date", 1).alias("snapshot_date"), *JOIN_KEYS, PREDICTION)
    return actual.join(made, ["snapshot_date", *JOIN_KEYS])


def metrics_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), *all_metrics(LABEL, PREDICTION))


def month_statistics(rows: DataFrame) -> DataFrame:
    """Per month: count, absolute and squared error, and mean and squared deviation of the label."""
    error = F.col(PREDICTION) - F.col(LABEL)
    return rows.groupBy("snapshot_date").agg(
        F.count("*").alias("n"),
        F.sum(F.abs(error)).alias("abs_error"),
        F.sum(error * error).alias("sq_error"),
        F.avg(LABEL).alias("mean"),
        (F.var_pop(LABEL) * F.count(LABEL)).alias("sq_dev"),
    )


def combined_metrics(statistics: DataFrame, *keys: str) -> DataFrame:
    """Metrics of several months together from their statistics; works on the month table only."""
    group = Window.partitionBy(*keys)
    whole_mean = F.sum(F.col("n") * F.col("mean")).over(group) / F.sum("n").over(group)
    spread = statistics.withColumn("_mean", whole_mean).withColumn(
        "sq_dev", F.col("sq_dev") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), 2)
    )
    return spread.groupBy(*keys).agg(
        F.sqrt(F.sum("sq_error") / F.sum("n")).alias("rmse"),
        (F.sum("abs_error") / F.sum("n")).alias("mae"),
        r2_from(F.sum("sq_error"), F.sum("sq_dev")).alias("r2"),
        F.sum("n").alias("rows"),
        F.min("snapshot_date").alias("start"),
        F.max("snapshot_date").alias("end"),
    )
