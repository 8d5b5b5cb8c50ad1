"""Training jobs: monthly boosted trees, weekly boosted trees, weekly ridge per pair."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import dataset, linear, modelling
from shelfcast.operators.rollup import PAIR
from shelfcast.session import written
from shelfcast.sources import schemas

WEEKLY_NUMERIC = ["sales_lag_1", "sales_avg_4", "weekofyear"]
#: Stores grow with the data, so they enter the trees as the mean label of each store, families as tree categories.
MEAN_ENCODED = ("store_nbr",)
RIDGE_COLUMNS = ["avg_sales_14d", "avg_sales_28d", "sum_sales_14d", "sum_sales_28d"]
RIDGE_LABEL = "weekly_sales_sum"


@dataclass(frozen=True)
class Fitted:
    model: modelling.TreeModel
    rows: DataFrame
    scores: DataFrame


def monthly_boosted_trees(features: DataFrame, labels: DataFrame, anchor: str, trees: int = 100) -> Fitted:
    """Boosted trees on the 24-month window ending at ``anchor``, scored on every split.

    The window runs from the split's first month, so only its partitions of both stores are read. The aligned rows are
    written once: every boosting round reads them again.
    """
    usable = dataset.usable_months(
        features.select("snapshot_date").distinct(), labels.select("snapshot_date").distinct()
    )
    split = dataset.rolling_split(usable, anchor)
    first = split.agg(F.min("snapshot_date")).scalar()
    window = F.col("snapshot_date").between(first, F.lit(anchor).cast("date"))
    aligned = dataset.align(features.where(window), labels)
    rows = written(dataset.with_split(aligned, split), "training_rows")
    model = modelling.boosted_trees(
        rows.where(F.col("split") == "train").drop("split"),
        rows.where(F.col("split") == "val").drop("split"),
        schemas.NUMERIC_FEATURES,
        schemas.CATEGORICAL_FEATURES,
        schemas.LABEL,
        trees=trees,
        mean_encoded=MEAN_ENCODED,
    )
    return Fitted(model, rows, modelling.regression_scores(model.predict(rows), "split"))


def weekly_boosted_trees(weeks: DataFrame, trees: int = schemas.WEEKLY_BOOSTING_TREES) -> Fitted:
    """Boosted trees on weekly lags; the newest weeks are held out, as many weeks before them stop the boosting.

    The weekly rows are written once; the cutoffs and every later reading take them from there.
    """
    stored = written(weeks.withColumn("sales_week", F.col("sales_week").cast("double")), "weekly_rows")
    older = dataset.cutoff_split(stored, 2 * schemas.HOLDOUT_WEEKS).withColumnRenamed("split", "older")
    cut = dataset.cutoff_split(older, schemas.HOLDOUT_WEEKS)
    split = F.when(F.col("older") == "train", "train").when(F.col("split") == "train", "val").otherwise("test")
    rows = cut.withColumn("split", split).drop("older")
    model = modelling.boosted_trees(
        rows.where(F.col("split") == "train").drop("split"),
        rows.where(F.col("split") == "val").drop("split"),
        WEEKLY_NUMERIC,
        schemas.CATEGORICAL_FEATURES,
        "sales_week",
        trees=trees,
        depth=schemas.WEEKLY_BOOSTING_DEPTH,
        rate=schemas.WEEKLY_BOOSTING_RATE,
        subsample=schemas.WEEKLY_BOOSTING_SUBSAMPLE,
        mean_encoded=MEAN_ENCODED,
        fold_keys=("week_start", *PAIR),
    )
    return Fitted(model, rows, modelling.regression_scores(model.predict(rows), "split", label="sales_week"))


def weekly_ridge(weeks: DataFrame, columns: list[str] = RIDGE_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Ridge coefficients per pair and the training summary over all pairs.

    The weekly table is read twice, for the cutoff and for the moments by pair and split; fit and errors follow from
    these. The newest weeks are out of time, the others are split 80/20 by hash. Features are the trailing weeks
    only: figures of the same week would hold the target.
    """
    split = dataset.cutoff_split(written(weeks, "weekly_features"), schemas.HOLDOUT_WEEKS)
    hashed = dataset.hash_split(
        split.withColumnRenamed("split", "era"),
        [*PAIR, "week_start"],
        schemas.RANDOM_SPLIT_SHARE,
        schemas.RANDOM_SPLIT_SEED,
    )
    rows = hashed.withColumn("split", F.when(F.col("era") == "test", "oot").otherwise(F.col("split"))).drop("era")
    found = written(rows.groupBy(*PAIR, "split").agg(*linear.moments(columns, RIDGE_LABEL)), "weekly_moments")
    train = found.where(F.col("split") == "train").drop("split")
    models = written(linear.solved(train, columns, schemas.RIDGE_PENALTY), "weekly_models")
    return models, linear.summary_by(found, models, PAIR, columns, schemas.RIDGE_PENALTY)


def metadata_row(fitted: Fitted, version: str, trees: int) -> DataFrame:
    """The nested metadata record of a candidate."""
    spans = dataset.split_statistics(fitted.rows)
    facts = fitted.scores.drop("n_rows").join(F.broadcast(spans), "split")  # one row per split

    def of(split: str, *fields: str):
        return F.max(F.when(F.col("split") == split, F.struct(*fields))).alias(split)

    gains = fitted.model.gains()
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("gain")).alias("k"), "feature", "gain")))
    importance = gains.agg(
        F.transform(F.slice(ordered, 1, schemas.TOP_FEATURES), lambda g: F.struct(g["feature"], g["gain"])).alias("top"),
        F.map_from_entries(F.collect_list(F.struct("feature", "gain"))).alias("full"),
    )
    record = facts.agg(
        F.struct(*[of(s, "rmse", "mae", "r2") for s in ("val", "test", "oot")]).alias("metrics"),
        F.struct(*[of(s, "start", "end", "rows") for s in ("train", "val", "test", "oot")]).alias("split_stats"),
    )
    names = {
        "join_keys": schemas.JOIN_KEYS,
        "categorical_features": schemas.CATEGORICAL_FEATURES,
        "numerical_features": schemas.NUMERIC_FEATURES,
    }
    return record.select(
        F.lit(version).alias("model_version"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp_utc"),
        F.lit(version).cast("date").alias("training_window_end"),
        F.lit("label_at_S_plus_1").alias("label_alignment"),
        *[F.array(*[F.lit(c) for c in cs]).alias(n) for n, cs in names.items()],
        F.lit(schemas.LABEL).alias("target_col"),
        F.create_map(F.lit("trees"), F.lit(str(trees)), F.lit("seed"), F.lit(str(schemas.BOOSTING_SEED))).alias(
            "best_params"
        ),
        "metrics",
        "split_stats",
        importance.select("top").scalar().alias("feature_importance_top20_gain"),
        importance.select("full").scalar().alias("feature_importance_full_gain"),
    )
