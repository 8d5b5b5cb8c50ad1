"""The monthly jobs over stored tables, one call per layer and month.

Order within a month: ``bronze``, ``silver``, ``gold``, ``promote``, ``train``, ``score``, ``registry``,
``monitor``. Every job replaces just its month, so running a month again gives the same tables. A job
whose inputs are not there yet returns False and writes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shelfcast.functions.dates import tolerant_date
from shelfcast.operators import clean, dataset, drift, holidays, lifecycle, modelling, rollup, scoring
from shelfcast.plans import monthly, training
from shelfcast.sources import files, schemas

# Table name, raw file name, types, keys that must not be null
DATASETS = {
    "daily_sales": ("train.csv", schemas.SALES_TYPES, schemas.SALES_KEYS),
    "daily_transactions": ("transactions.csv", schemas.TRANSACTION_TYPES, schemas.TRANSACTION_KEYS),
    "oil_prices": ("oil.csv", schemas.OIL_TYPES, schemas.OIL_KEYS),
}
HOLIDAY_FILE = "holidays_events.csv"
DERIVED = ("year", "month", "snapshot_date")


@dataclass(frozen=True)
class Layout:
    """Where the tables live; ``root`` is a folder every executor reaches."""

    raw: str
    root: str

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def state(self, table: str) -> str:
        return f"{self.root}/state/{table}"

    def reference(self, table: str) -> str:
        return f"{self.root}/silver_reference/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def models(self, name: str) -> str:
        return f"{self.root}/model_store/{name}"


def _month(text: str):
    return F.lit(text).cast("date")


def shifted(month: str, n: int) -> str:
    year, index = divmod(int(month[:4]) * 12 + int(month[5:7]) - 1 + n, 12)
    return dt.date(year, index + 1, 1).isoformat()


def _if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None where nothing was written yet; other failures stay failures."""
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    return _if_there(lambda: spark.read.parquet(path))


def _months_of(df: DataFrame | None, first: str, last: str) -> DataFrame | None:
    return None if df is None else df.where(F.col("snapshot_date").between(_month(first), _month(last)))


def _empty(df: DataFrame | None) -> bool:
    return df is None or df.isEmpty()


# -- data layers -------------------------------------------------------------


def bronze(spark: SparkSession, at: Layout, month: str, last: str | None = None) -> None:
    """Rows of one month, or of all months up to ``last``, of every raw file, as they came, under their month.

    Each raw file is scanned once, however many months are asked for.
    """
    for table, (file, types, _) in DATASETS.items():
        columns = {c: t for c, t in types.items() if c not in DERIVED}
        raw = files.read_csv(spark, f"{at.raw}/{file}", schemas.raw_schema(columns))
        dated = clean.require_columns(raw, ["date"]).withColumn("date", tolerant_date("date"))
        wanted = F.col("date").between(_month(month), F.last_day(_month(last or month)))
        files.write_months(dated.where(wanted).withColumn("snapshot_date", F.trunc("date", "month")), at.bronze(table))


def silver(spark: SparkSession, at: Layout, month: str) -> None:
    """Typed and cleaned rows of one month."""
    for table, (_, types, keys) in DATASETS.items():
        rows = _months_of(_stored(spark, at.bronze(table)), month, month)
        if _empty(rows):
            continue
        tidy = clean.silver_oil if table == "oil_prices" else clean.silver
        files.write_months(tidy(rows.drop("snapshot_date"), types, keys), at.silver(table))


def reference_tables(spark: SparkSession, at: Layout) -> None:
    """Holiday features and the three start-date tables, from the full raw files."""
    raw = files.read_csv(spark, f"{at.raw}/{HOLIDAY_FILE}", schemas.raw_schema(schemas.HOLIDAY_TYPES))
    events = clean.cast_columns(raw, schemas.HOLIDAY_TYPES)
    files.write_reference(events, at.reference("holiday_events"))
    features = holidays.with_next_month(holidays.monthly_holidays(events))
    files.write_reference(features, at.reference("holiday_features"))

    columns = {c: t for c, t in schemas.SALES_TYPES.items() if c not in DERIVED}
    sales = clean.cast_columns(
        files.read_csv(spark, f"{at.raw}/{DATASETS['daily_sales'][0]}", schemas.raw_schema(columns)), columns
    )
    starts = rollup.first_active(sales, rollup.PAIR)
    files.write_reference(starts, at.reference("store_family_start_dates"))
    pairs = files.read_table(spark, at.reference("store_family_start_dates"))
    for key in rollup.PAIR:
        grain = pairs.groupBy(key).agg(F.min("first_active_month").alias("first_active_month"))
        files.write_reference(grain, at.reference(f"{key.removesuffix('_nbr')}_start_dates"))


def gold(spark: SparkSession, at: Layout, month: str) -> bool:
    """Features and labels of one month from its three silver months."""
    first = shifted(month, -2)
    tables = {t: _months_of(_stored(spark, at.silver(t)), first, month) for t in DATASETS}
    sales = tables["daily_sales"]
    if sales is None or sales.select("snapshot_date").distinct().count() < 3:
        return False
    holiday = _stored(spark, at.reference("holiday_features"))
    if any(t is None for t in (*tables.values(), holiday)):
        return False
    data = monthly.Retail(sales, tables["daily_transactions"], tables["oil_prices"], holiday)
    files.write_months(monthly.feature_store(data, month), at.gold("feature_store"))
    files.write_months(monthly.label_store(data, month), at.gold("label_store"))
    return True


# -- models ------------------------------------------------------------------


def train(spark: SparkSession, at: Layout, month: str, trees: int = 100) -> bool:
    """Candidate model on the 24 feature months before ``month``, when all are there."""
    features, labels = _stored(spark, at.gold("feature_store")), _stored(spark, at.gold("label_store"))
    if features is None or labels is None:
        return False
    run = spark.range(1).select(_month(month).alias("run_month"))
    months = [t.select("snapshot_date").distinct() for t in (features, labels)]
    if not dataset.missing_months(run, *months).isEmpty():
        return False
    version = shifted(month, -1)
    known_labels = labels.where(F.col("snapshot_date") <= _month(month))
    fitted = training.monthly_boosted_trees(features, known_labels, version, trees)
    fitted.model.save(f"{at.models('candidates')}/{version}")
    files.write_json(
        training.metadata_row(fitted, version, trees), f"{at.models('candidate_metadata')}/version={version}"
    )
    return True


def candidate_metadata(spark: SparkSession, at: Layout) -> DataFrame | None:
    """Metadata of every candidate; an unreadable document is left out."""
    path = at.models("candidate_metadata")
    return _if_there(lambda: files.read_json(spark, path, schemas.MODEL_METADATA_SCHEMA))


def deployed_version(spark: SparkSession, at: Layout, month: str) -> str | None:
    """The version live in a month: one row per promotion, the newest wins."""
    promotions = _stored(spark, at.models("deployments"))
    if promotions is None:
        return None
    row = promotions.where(F.col("snapshot_date") <= _month(month)).agg(
        F.max_by("model_version", "snapshot_date").alias("version")
    )
    return row.first()["version"]


def monitoring_reports(spark: SparkSession, at: Layout, month: str | None = None) -> DataFrame | None:
    """All reports, or the one of a month; None when there is none."""
    path = at.gold("model_monitoring") + (f"/report={month}" if month else "")
    return _if_there(lambda: files.read_json(spark, path, schemas.REPORT_SCHEMA))


def promote(spark: SparkSession, at: Layout, month: str, deployment: str) -> bool:
    """Put the best candidate live: at the deployment month, later when the latest report is in breach."""
    if month < deployment:
        return False
    known = candidate_metadata(spark, at)
    if _empty(known):
        return False
    trigger = None
    if month > deployment:
        reports = monitoring_reports(spark, at)
        latest = None if reports is None else lifecycle.latest_report(reports, shifted(month, -1)).first()
        if latest is None or not latest["breach_flag"]:
            return False
        trigger = latest["snapshot_date"]
    seen = known.where(F.col("training_window_end") <= _month(shifted(month, -2)))
    best = lifecycle.best_candidate(lifecycle.registry(seen, None))
    event = best.where(F.col("model_version").isNotNull()).select(
        _month(month).alias("snapshot_date"),
        "model_version",
        "oot_r2",
        F.lit(trigger).cast("date").alias("triggered_by"),
        F.lit("monitoring_breach" if trigger else "initial_deployment").alias("reason"),
    )
    files.write_months(event, at.models("deployments"))
    return not event.isEmpty()


def promotion_log(spark: SparkSession, at: Layout) -> DataFrame:
    """Breach-triggered promotions; the first deployment is not an event."""
    return spark.read.parquet(at.models("deployments")).where(F.col("triggered_by").isNotNull())


def score(spark: SparkSession, at: Layout, month: str, deployment: str) -> bool:
    """Predictions of one feature month by the live model, as a table and a CSV copy."""
    version = deployed_version(spark, at, month) if month >= deployment else None
    features = _months_of(_stored(spark, at.gold("feature_store")), month, month)
    if version is None or _empty(features):
        return False
    model = modelling.TreeModel.load(
        spark, f"{at.models('candidates')}/{version}", schemas.NUMERIC_FEATURES, schemas.CATEGORICAL_FEATURES
    )
    rows = modelling.prediction_rows(model.predict(features)).withColumn("model_version", F.lit(version))
    files.write_months(rows, at.gold("predictions"))
    stored = files.read_month(spark, at.gold("predictions"), month)
    files.write_csv(stored, f"{at.gold('predictions_csv')}/{month}")
    return True


def registry(spark: SparkSession, at: Layout, month: str) -> bool:
    """Flat table of all candidates, as JSON and CSV."""
    known = candidate_metadata(spark, at)
    if _empty(known):
        return False
    flat = lifecycle.registry(known, deployed_version(spark, at, month))
    files.write_json(flat, at.models("registry_json"))
    files.write_csv(flat, at.models("registry_csv"))
    return True


def monitor(
    spark: SparkSession,
    at: Layout,
    month: str,
    deployment: str,
    rule: str = "any",
    baseline: str = "deployed",
    allowed: dict[str, float] | None = None,
) -> bool:
    """Report of one month: metrics, breaches against a baseline, drift.

    Right after a promotion the predictions still come from the model before. ``baseline`` chooses whose
    out-of-time metrics they are held against: those of the model now live (``deployed``), or of the model
    that made them (``scored_by``). ``allowed`` gives thresholds (``r2_drop``, ``rmse_ratio``, ``mae_ratio``).
    """
    if baseline not in ("deployed", "scored_by"):
        raise ValueError("baseline must be deployed or scored_by")
    if month < shifted(deployment, 1):
        return False
    made = shifted(month, -1)
    version = deployed_version(spark, at, month)
    if version is None:
        raise ValueError("no model is deployed")
    features = spark.read.parquet(at.gold("feature_store"))
    labels = files.read_month(spark, at.gold("label_store"), month)
    predictions = files.read_month(spark, at.gold("predictions"), made)
    clean.require_columns(labels, [schemas.LABEL])
    clean.require_columns(predictions, [schemas.PREDICTION])
    scores = scoring.metrics_by(scoring.evaluation_rows(labels, predictions), "snapshot_date")
    lifecycle.require_rows(scores, f"labels and predictions for {month}")
    held_against = version
    if baseline == "scored_by":
        held_against = predictions.agg(F.max("model_version").alias("v")).first()["v"]
    metadata = candidate_metadata(spark, at)
    oot = metadata.where(F.col("model_version") == held_against).select("metrics.oot.*")
    now = lifecycle.with_breaches(scores, oot, **(allowed or {}))
    previous = monitoring_reports(spark, at, made) if rule == "persistent" else None
    if previous is not None:
        now = now.unionByName(previous.select("snapshot_date", "breaches.*"), allowMissingColumns=True)
    flagged = lifecycle.with_breach_flag(now, rule).where(F.col("snapshot_date") == _month(month))

    variables = [v for v in schemas.DRIFT_VARIABLES if v in features.columns]
    two = features.where(F.col("snapshot_date").isin([_month(version), _month(made)]))
    compared = drift.binned_comparison(two, version, variables)
    table = drift.drift_table(compared.where(F.col("snapshot_date") == _month(made)))
    scored = files.read_table(spark, at.gold("predictions"))
    scored = scored.where(F.col("snapshot_date").isin([_month(version), _month(made)]))
    missing = drift.missing_variables(two, schemas.DRIFT_VARIABLES)
    csi = drift.prediction_drift(scored, version)
    report = lifecycle.report_rows(flagged, table, version, missing, csi, **(allowed or {}))
    files.write_json(report, f"{at.gold('model_monitoring')}/report={month}")
    return True


def run_month(
    spark: SparkSession, at: Layout, month: str, deployment: str, rule: str = "any", trees: int = 100
) -> dict[str, bool]:
    """All jobs of one month in order; tells which of them had something to do."""
    bronze(spark, at, month)
    silver(spark, at, month)
    done = {"gold": gold(spark, at, month)}
    if not done["gold"]:
        return done
    done["promote"] = promote(spark, at, month, deployment)
    done["train"] = train(spark, at, month, trees)
    done["score"] = score(spark, at, month, deployment)
    done["registry"] = registry(spark, at, month)
    live = deployed_version(spark, at, month) is not None
    done["monitor"] = live and monitor(spark, at, month, deployment, rule)
    return done
