"""Fitted candidates of every training window and their stored statistics, as the registry queries read them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.calendar import join_calendar
from shelfcast.functions.metrics import r2_from
from shelfcast.operators import clean, dataset, lifecycle, sliding
from shelfcast.plans.gold import Gold, gold
from shelfcast.session import written
from shelfcast.sources import schemas


@dataclass(frozen=True)
class Candidates:
    """Each table is written when it is first asked for; all but ``rows`` are bounded by the calendar."""

    gold: Gold
    versions: DataFrame

    @cached_property
    def rows(self) -> DataFrame:
        """The features of every pair and month with its label, without nulls."""
        aligned = clean.fill_numbers(dataset.align(self.gold.features, self.gold.labels), schemas.RIDGE_FEATURES)
        rows = aligned.select("snapshot_date", *schemas.JOIN_KEYS, *schemas.RIDGE_FEATURES, schemas.LABEL)
        return written(rows, "candidate_rows")

    @cached_property
    def sums(self) -> DataFrame:
        return written(sliding.month_sums(self.rows, schemas.RIDGE_FEATURES), "month_sums")

    @cached_property
    def models(self) -> DataFrame:
        found = sliding.candidate_models(self.sums, self.versions, schemas.RIDGE_FEATURES, schemas.RIDGE_PENALTY)
        return written(found, "candidate_models")

    @cached_property
    def scores(self) -> DataFrame:
        """Metrics per version and split; none on the training months, whose rows are counted only."""
        held = sliding.held_out_statistics(self.rows, self.models, schemas.RIDGE_FEATURES)
        train = sliding.training_statistics(self.sums, self.versions)
        return written(lifecycle.version_metrics(held.unionByName(train)), "candidate_scores")

    @cached_property
    def live_scores(self) -> DataFrame:
        """Metrics per version and month of the label, on every month that the version may be live in.

        Promotion only takes versions that beat all before them, so no other is scored; the first one is, for its months.
        """
        offered = self.scores.where(F.col("split") == "oot").withColumnRenamed("training_window_end", "model_version")
        wanted = lifecycle.ever_best(offered).unionByName(self.models.agg(F.min("training_window_end").alias("model_version")))
        return written(self._live(wanted.distinct()), "live_scores")

    def scores_of(self, version: str) -> DataFrame:
        """Metrics of one version per month of the label."""
        one = self.models.select(F.col("training_window_end").alias("model_version")).distinct()
        return self._live(one.where(F.col("model_version") == F.lit(version).cast("date"))).drop("model_version")

    def _live(self, wanted: DataFrame) -> DataFrame:
        ends = wanted.select(F.col("model_version").alias("training_window_end"))
        models = join_calendar(self.models, ends, "training_window_end", "left_semi")
        found = sliding.live_statistics(self.rows, models, schemas.RIDGE_FEATURES)
        return found.select(
            F.add_months("snapshot_date", 1).alias("snapshot_date"),
            F.col("training_window_end").alias("model_version"),
            F.col("n").alias("n_rows"),
            F.sqrt(F.col("sq_error") / F.col("n")).alias("rmse"),
            (F.col("abs_error") / F.col("n")).alias("mae"),
            r2_from(F.col("sq_error"), F.col("sq_dev")).alias("r2"),
        )


def build(tables: Gold) -> Candidates:
    """All months that have 24 months of features and labels up to them are versions."""
    months = [t.select("snapshot_date").distinct() for t in (tables.features, tables.labels)]
    runs = months[1].select(F.col("snapshot_date").alias("run_month"))
    ready = dataset.trainable_months(runs, *months)
    versions = written(ready.select(F.add_months("run_month", -1).alias("training_window_end")), "versions")
    return Candidates(tables, versions)


_stored: dict[Gold, Candidates] = {}


def fitted(spark: SparkSession, sf_dir: str) -> Candidates:
    """The candidates of the stored gold tables, built on first use."""
    tables = gold(spark, sf_dir)
    if tables not in _stored:
        _stored[tables] = build(tables)
    return _stored[tables]
