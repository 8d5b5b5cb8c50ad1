"""Candidate models, registry, monitoring reports and promotion decisions as queries.

Everything here lives on the month table or the candidate table: one row per month, whatever the size
of the panel behind the metrics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.functions.calendar import join_calendar, months_window
from shelfcast.functions.dates import month_index
from shelfcast.operators.dataset import WINDOW_MONTHS, split_name
from shelfcast.operators.scoring import combined_metrics
from shelfcast.sources import schemas

METRIC_NAMES = ["rmse", "mae", "r2"]


# -- candidates and registry -------------------------------------------------


def candidate_metrics(statistics: DataFrame, versions: DataFrame) -> DataFrame:
    """Metrics per candidate version and split, from monthly error statistics.

    A version is the last feature month of its 24-month window; each month of statistics contributes to
    the 24 versions that contain it. ``statistics`` is keyed by feature month.
    """
    spread = statistics.select("*", F.explode(F.sequence(F.lit(1), F.lit(WINDOW_MONTHS))).alias("age")).select(
        F.expr("add_months(snapshot_date, age - 1)").alias("training_window_end"),
        split_name(F.col("age")).alias("split"),
        *statistics.columns,
    )
    known = join_calendar(spread, versions, "training_window_end", "left_semi")
    return combined_metrics(known, "training_window_end", "split")


def version_metrics(statistics: DataFrame) -> DataFrame:
    """Metrics per candidate version and split from error statistics by version and feature month."""
    age = month_index("training_window_end") - month_index("snapshot_date") + 1
    return combined_metrics(statistics.withColumn("split", split_name(age)), "training_window_end", "split")


def model_metadata(candidates: DataFrame, numeric: list[str] = schemas.NUMERIC_FEATURES) -> DataFrame:
    """One nested record per candidate version."""

    def of(split: str, *fields: str) -> Column:
        picked = F.struct(*[F.col(f) for f in fields])
        return F.max(F.when(F.col("split") == split, picked)).alias(split)

    nested = candidates.groupBy("training_window_end").agg(
        F.struct(*[of(s, *METRIC_NAMES) for s in ("val", "test", "oot")]).alias("metrics"),
        F.struct(*[of(s, "start", "end", "rows") for s in ("train", "val", "test", "oot")]).alias("split_stats"),
    )
    return nested.select(
        F.date_format("training_window_end", "yyyy-MM-dd").alias("model_version"),
        "training_window_end",
        F.lit("label_at_S_plus_1").alias("label_alignment"),
        F.array(*[F.lit(k) for k in schemas.JOIN_KEYS]).alias("join_keys"),
        F.lit(schemas.LABEL).alias("target_col"),
        F.array(*[F.lit(k) for k in schemas.CATEGORICAL_FEATURES]).alias("categorical_features"),
        F.array(*[F.lit(k) for k in numeric]).alias("numerical_features"),
        "metrics",
        "split_stats",
    )


def registry(metadata: DataFrame, deployed_version: str | None) -> DataFrame:
    """Flat registry: one row per candidate in order of its window end."""
    stamp = F.col("timestamp_utc") if "timestamp_utc" in metadata.columns else F.lit(None).cast("string")
    flat = [
        F.col(f"metrics.{s}.{m}").alias(f"{s}_{m}") for s in ("val", "test", "oot") for m in METRIC_NAMES
    ]
    rows = [F.col(f"split_stats.{s}.rows").alias(f"{s}_rows") for s in ("train", "val", "test", "oot")]
    return metadata.select(
        F.coalesce("model_version", F.lit("unknown")).alias("model_version"),
        "training_window_end",
        stamp.alias("timestamp_utc"),
        F.coalesce(F.col("model_version") == F.lit(deployed_version), F.lit(False)).alias("is_deployed"),
        *flat,
        *rows,
    ).orderBy("training_window_end")


def candidate_comparison(registered: DataFrame) -> DataFrame:
    """Out-of-time R2 per candidate with the deployed one marked, by version."""
    return (
        registered.where(F.col("oot_r2").isNotNull())
        .select("model_version", "oot_r2", "is_deployed")
        .orderBy("model_version")
    )


def best_candidate(registered: DataFrame) -> DataFrame:
    """The highest out-of-time R2; the earliest version where several share it."""
    return registered.where(F.col("oot_r2").isNotNull()).agg(
        F.min_by("model_version", F.struct(-F.col("oot_r2"), F.col("model_version"))).alias("model_version"),
        F.max("oot_r2").alias("oot_r2"),
    )


# -- monitoring --------------------------------------------------------------


def breach_columns(current: dict[str, Column], baseline: dict[str, Column], **allowed: float) -> dict[str, Column]:
    """Threshold breaches per metric; null where there is no baseline to compare with."""
    return {
        "r2_breach": (baseline["r2"] - current["r2"]) > allowed.get("r2_drop", schemas.R2_DROP_ALLOWED),
        "rmse_breach": (current["rmse"] / baseline["rmse"]) > allowed.get("rmse_ratio", schemas.RMSE_RATIO_ALLOWED),
        "mae_breach": (current["mae"] / baseline["mae"]) > allowed.get("mae_ratio", schemas.MAE_RATIO_ALLOWED),
    }


def _set(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def any_breach(r2: Column, rmse: Column, mae: Column) -> Column:
    return _set(r2) | _set(rmse) | _set(mae)


def persistent_breach(r2: Column, rmse: Column, mae: Column, rmse_before: Column, mae_before: Column) -> Column:
    """R2 counts at once; rmse and mae only when the same metric was in breach one month before."""
    return _set(r2) | (_set(rmse) & _set(rmse_before)) | (_set(mae) & _set(mae_before))


def with_breaches(scores: DataFrame, baseline: DataFrame, **allowed: float) -> DataFrame:
    """Monthly scores beside the baseline (one row of rmse, mae, r2, or none) and the breaches.

    ``allowed`` are the thresholds ``r2_drop``, ``rmse_ratio`` and ``mae_ratio`` where they differ from the usual ones.
    """
    base = baseline.agg(F.first(F.struct(*METRIC_NAMES))).scalar()
    with_base = scores.withColumn("_base", base).withColumns(
        {f"base_{m}": F.col(f"_base.{m}") for m in METRIC_NAMES}
    )
    return with_base.drop("_base").withColumns(
        breach_columns(
            {m: F.col(m) for m in METRIC_NAMES},
            {m: F.col(f"base_{m}") for m in METRIC_NAMES},
            **allowed,
        )
    )


def with_breach_flag(breaches: DataFrame, rule: str = "any") -> DataFrame:
    """``breach_flag`` under the any-breach or the persistent rule."""
    now = [F.col(f"{m}_breach") for m in ("r2", "rmse", "mae")]
    if rule == "any":
        return breaches.withColumn("breach_flag", any_breach(*now))
    if rule != "persistent":
        raise ValueError("rule must be any or persistent")
    before = breaches.select(
        F.add_months("snapshot_date", 1).alias("snapshot_date"),
        F.col("rmse_breach").alias("_rmse_before"),
        F.col("mae_breach").alias("_mae_before"),
    )
    return (
        join_calendar(breaches, before)
        .withColumn("breach_flag", persistent_breach(*now, F.col("_rmse_before"), F.col("_mae_before")))
        .drop("_rmse_before", "_mae_before")
    )


def from_month(df: DataFrame, month: str, column: str = "snapshot_date", months_later: int = 0) -> DataFrame:
    """Rows from a deployment month on, or from some months after it."""
    return df.where(F.col(column) >= F.add_months(F.lit(month).cast("date"), months_later))


def report_rows(
    flagged: DataFrame,
    drift: DataFrame,
    reference_month: str,
    missing: DataFrame,
    prediction_csi: DataFrame,
    **allowed: float,
) -> DataFrame:
    """One nested monitoring report per month.

    ``drift``, ``missing`` (``snapshot_date, missing``: drift variables without a value in a month) and
    ``prediction_csi`` are keyed by the prediction month; a month that ``missing`` lacks has no features at all.
    ``allowed`` are the thresholds that the breaches were found with.
    """
    reference = F.lit(reference_month).cast("date")
    absent = missing.where(F.col("snapshot_date") == reference).agg(F.first("missing")).scalar()
    every = F.array(*[F.lit(v) for v in schemas.DRIFT_VARIABLES])
    base = flagged.select(
        "snapshot_date",
        F.add_months("snapshot_date", -1).alias("prediction_snapshot"),
        F.lit(reference_month).cast("date").alias("reference_snapshot_for_drift"),
        F.struct(*METRIC_NAMES).alias("metrics"),
        F.struct(F.struct(*[F.col(f"base_{m}").alias(m) for m in METRIC_NAMES]).alias("oot")).alias(
            "baseline_metrics"
        ),
        F.struct("r2_breach", "rmse_breach", "mae_breach").alias("breaches"),
        "breach_flag",
        F.struct(
            F.lit(float(allowed.get("r2_drop", schemas.R2_DROP_ALLOWED))).alias("r2_drop_allowed"),
            F.lit(float(allowed.get("rmse_ratio", schemas.RMSE_RATIO_ALLOWED))).alias("rmse_increase_ratio"),
            F.lit(float(allowed.get("mae_ratio", schemas.MAE_RATIO_ALLOWED))).alias("mae_increase_ratio"),
        ).alias("thresholds"),
        F.coalesce(absent, every).alias("missing_in_reference"),
    )
    current = missing.select(F.col("snapshot_date").alias("prediction_snapshot"), F.col("missing").alias("_missing"))
    csi = prediction_csi.select(
        F.col("snapshot_date").alias("prediction_snapshot"), F.col("csi").alias("_csi"), F.col("csi_severity").alias("_kind")
    )
    base = (
        join_calendar(join_calendar(base, current, "prediction_snapshot"), csi, "prediction_snapshot")
        .withColumns(
            {
                "missing_in_current": F.coalesce("_missing", every),
                "prediction_csi": F.struct(
                    F.col("_csi").alias("value"),
                    F.col("_kind").alias("severity"),
                    F.col("reference_snapshot_for_drift").alias("reference_snapshot"),
                    F.col("prediction_snapshot").alias("current_snapshot"),
                ),
            }
        )
        .drop("_missing", "_csi", "_kind")
    )
    summary = drift.groupBy(F.col("snapshot_date").alias("prediction_snapshot")).agg(
        F.sort_array(F.collect_list(F.struct("variable", "psi", "psi_severity", "csi", "csi_severity"))).alias(
            "psi_csi_summary"
        )
    )
    return join_calendar(base, summary, "prediction_snapshot")


def latest_report(reports: DataFrame, until: str) -> DataFrame:
    """The newest report up to a month."""
    return reports.where(F.col("snapshot_date") <= F.lit(until).cast("date")).agg(
        F.max("snapshot_date").alias("snapshot_date"),
        F.max_by("breach_flag", "snapshot_date").alias("breach_flag"),
    )


# -- promotion ---------------------------------------------------------------


def ranked_offers(candidates: DataFrame) -> DataFrame:
    """``snapshot_date`` of the version and its ``offer``: the greater one wins, of equal ones the earlier version."""
    return candidates.where(F.col("r2").isNotNull()).select(
        F.col("model_version").alias("snapshot_date"),
        F.struct(
            F.col("r2"),
            (-month_index("model_version")).alias("earlier"),
            F.col("model_version").alias("version"),
            F.col("rmse"),
            F.col("mae"),
        ).alias("offer"),
    )


def ever_best(candidates: DataFrame) -> DataFrame:
    """``model_version`` of the candidates that beat all before them; promotion never takes another one.

    Whatever the run month, its best known candidate is the best of all versions up to some month.
    """
    until = months_window(Window.unboundedPreceding, 0)
    ranked = ranked_offers(candidates).withColumn("month_idx", month_index("snapshot_date"))
    best = ranked.withColumn("best", F.max("offer").over(until))
    return best.where(F.col("best.version") == F.col("snapshot_date")).select(F.col("snapshot_date").alias("model_version"))


def best_so_far(months: DataFrame, candidates: DataFrame, lag_months: int = 2) -> DataFrame:
    """For every run month the best candidate known by then.

    Promotion runs before training, so a run sees versions up to two months back. ``candidates`` has
    model_version (DATE) and its out-of-time rmse, mae, r2.
    """
    offered = ranked_offers(candidates)
    timeline = months.select("snapshot_date").unionByName(offered.select("snapshot_date")).distinct()
    known = Window.orderBy("month_idx").rangeBetween(Window.unboundedPreceding, -lag_months)
    ranked = (
        join_calendar(timeline, offered)
        .withColumn("month_idx", month_index("snapshot_date"))
        .withColumn("best", F.max("offer").over(known))
        .select("snapshot_date", "best")
    )
    return join_calendar(months, ranked)


def deployment_timeline(scores: DataFrame, candidates: DataFrame, deployment: str, rule: str = "any") -> DataFrame:
    """Replay of promotion and monitoring month by month.

    In every run month promotion comes first: at the deployment month the best known candidate goes
    live, later the best known candidate goes live when the latest report is in breach. Then the month
    is scored against the baseline of the model now live. The state passes from month to month, so the
    replay is one fold over the month table - one row per calendar month, gathered in one place.

    ``scores`` has a row per month or, with ``model_version``, one per month and version: then a month counts
    the errors of the version that was live a month earlier, when its predictions were made.
    """
    start = F.lit(deployment).cast("date")
    by_version = "model_version" in scores.columns
    seen = from_month(scores, deployment)
    if by_version:
        entry = F.struct("model_version", F.struct(*METRIC_NAMES))
        seen = seen.groupBy("snapshot_date").agg(F.map_from_entries(F.collect_list(entry)).alias("found"))
    else:
        seen = seen.select("snapshot_date", F.struct(*METRIC_NAMES).alias("found"))
    # maps have no order, so the rows are sorted by their month alone
    gathered = best_so_far(seen, candidates).agg(
        F.array_sort(
            F.collect_list(F.struct("snapshot_date", "found", "best")),
            lambda a, b: F.datediff(a["snapshot_date"], b["snapshot_date"]),
        ).alias("runs")
    )
    no = F.lit(None)
    nothing = F.struct(
        no.cast("date").alias("version"),
        no.cast("double").alias("rmse"),
        no.cast("double").alias("mae"),
        no.cast("double").alias("r2"),
    )
    row_type = (
        "array<struct<snapshot_date:date,deployed_version:date,promoted:boolean,triggered_by:date,"
        "rmse:double,mae:double,r2:double,r2_breach:boolean,rmse_breach:boolean,mae_breach:boolean,"
        "breach_flag:boolean>>"
    )
    initial = F.struct(
        nothing.alias("live"),
        no.cast("date").alias("reported"),
        F.lit(False).alias("flag"),
        F.lit(False).alias("rmse_breach"),
        F.lit(False).alias("mae_breach"),
        F.array().cast(row_type).alias("rows"),
    )

    def step(state: Column, run: Column) -> Column:
        month, best = run["snapshot_date"], run["best"]
        now = run["found"][state["live"]["version"]] if by_version else run["found"]
        due = (month == start) | ((month > start) & state["reported"].isNotNull() & state["flag"])
        promoted = due & best.isNotNull()
        offered = F.struct(
            best["version"].alias("version"),
            best["rmse"].alias("rmse"),
            best["mae"].alias("mae"),
            best["r2"].alias("r2"),
        )
        live = F.when(promoted, offered).otherwise(state["live"])
        monitored = (month > start) & now["rmse"].isNotNull() & live["version"].isNotNull()
        broken = breach_columns({m: now[m] for m in METRIC_NAMES}, {m: live[m] for m in METRIC_NAMES})
        r2_b, rmse_b, mae_b = (_set(broken[f"{m}_breach"]) & monitored for m in ("r2", "rmse", "mae"))
        if rule == "any":
            flag = any_breach(r2_b, rmse_b, mae_b)
        else:
            month_before = _set(state["reported"] == F.add_months(month, -1))
            flag = persistent_breach(
                r2_b, rmse_b, mae_b, month_before & state["rmse_breach"], month_before & state["mae_breach"]
            )
        row = F.struct(
            month.alias("snapshot_date"),
            live["version"].alias("deployed_version"),
            promoted.alias("promoted"),
            F.when(promoted & (month > start), state["reported"]).alias("triggered_by"),
            now["rmse"].alias("rmse"),
            now["mae"].alias("mae"),
            now["r2"].alias("r2"),
            r2_b.alias("r2_breach"),
            rmse_b.alias("rmse_breach"),
            mae_b.alias("mae_breach"),
            (flag & monitored).alias("breach_flag"),
        )
        return F.struct(
            live.alias("live"),
            F.when(monitored, month).otherwise(state["reported"]).alias("reported"),
            F.when(monitored, flag).otherwise(state["flag"]).alias("flag"),
            F.when(monitored, rmse_b).otherwise(state["rmse_breach"]).alias("rmse_breach"),
            F.when(monitored, mae_b).otherwise(state["mae_breach"]).alias("mae_breach"),
            F.concat(state["rows"], F.array(row)).alias("rows"),
        )

    folded = gathered.select(F.aggregate("runs", initial, step).alias("state"))
    return folded.select(F.inline("state.rows"))


def promotion_events(timeline: DataFrame, candidates: DataFrame) -> DataFrame:
    """Log rows of breach-triggered promotions; the first deployment is not logged."""
    events = timeline.where(F.col("promoted") & F.col("triggered_by").isNotNull())
    named = candidates.select(F.col("model_version").alias("deployed_version"), F.col("r2").alias("oot_r2"))
    return join_calendar(events, named, "deployed_version").select(
        F.date_format("deployed_version", "yyyy-MM-dd").alias("promoted_model"),
        "oot_r2",
        "triggered_by",
        F.lit("monitoring_breach").alias("reason"),
    )


# -- gates -------------------------------------------------------------------


def readiness(df: DataFrame, day: str, column: str = "date") -> DataFrame:
    """Whether a day has any row, with the count."""
    return df.where(F.col(column) == F.lit(day).cast("date")).agg(
        F.lit(day).cast("date").alias("date"), F.count("*").alias("n_rows"), (F.count("*") > 0).alias("ready")
    )


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The same table, or an error when it has no row; looks at one row only."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
