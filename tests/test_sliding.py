"""Ridge candidates of sliding windows, the solver beneath them, and scoring by the model that was live."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from shelfcast.operators import lifecycle, linear, sliding
from shelfcast.sources import schemas

COLUMNS = ["x0", "odd name", "x2"]


def month(k):
    return dt.date(2015 + k // 12, k % 12 + 1, 1)


@pytest.fixture(scope="module")
def panel(spark):
    """Thirty months; how the label follows from the features drifts, one feature is constant in the early ones."""
    rng = np.random.default_rng(11)
    data = []
    for k in range(30):
        for pair in range(12):
            x = [float(rng.normal(50, 9)), float(rng.normal(2, 3)), 4.0 if k < 20 else float(rng.normal(4, 1))]
            y = (1 + k / 10) * x[0] - 3 * x[1] + x[2] + float(rng.normal(0, 5))
            data.append((month(k), str(pair), "f", *x, y))
    names = "snapshot_date date, store_nbr string, family string, x0 double, `odd name` double, x2 double, label_next_month_sales double"
    return spark.createDataFrame(data, names)


@pytest.fixture(scope="module")
def models(spark, panel):
    versions = spark.createDataFrame([(month(k),) for k in range(23, 30)], "training_window_end date")
    sums = sliding.month_sums(panel, COLUMNS)
    return sliding.candidate_models(sums, versions, COLUMNS, 0.1)


def test_every_window_equals_linear_regression(panel, models):
    found = {r["training_window_end"]: r for r in models.collect()}
    assert sorted(found) == [month(k) for k in range(23, 30)]
    for k in range(23, 30):
        train = panel.where(F.col("snapshot_date").between(month(k - 23), month(k - 6)))
        vectors = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(train)
        theirs = LinearRegression(labelCol=schemas.LABEL, regParam=0.1, elasticNetParam=0.0, solver="normal").fit(vectors)
        mine = found[month(k)]
        assert mine["n_rows"] == train.count()
        assert mine["intercept"] == pytest.approx(theirs.intercept, rel=1e-6)
        assert [mine[f"coef_{c}"] for c in COLUMNS] == pytest.approx(list(theirs.coefficients), rel=1e-6, abs=1e-9)


def test_scores_equal_plain_errors(panel, models):
    held = sliding.held_out_statistics(panel, models, COLUMNS)
    got = {
        (r["training_window_end"], r["split"]): r
        for r in lifecycle.version_metrics(held).collect()
    }
    assert len(got) == 3 * 7
    rows, fits = panel.collect(), {r["training_window_end"]: r for r in models.collect()}
    for k in range(23, 30):
        fit = fits[month(k)]
        for split, months in (("oot", (k - 1, k)), ("test", (k - 3, k - 2)), ("val", (k - 5, k - 4))):
            own = [r for r in rows if r["snapshot_date"] in [month(m) for m in months]]
            y = np.array([r[schemas.LABEL] for r in own])
            p = np.array([fit["intercept"] + sum(fit[f"coef_{c}"] * r[c] for c in COLUMNS) for r in own])
            row = got[month(k), split]
            assert row["rows"] == len(own)
            assert row["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
            assert row["mae"] == pytest.approx(np.mean(abs(y - p)))
            assert row["r2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_errors_follow_from_moments(panel):
    found = panel.withColumn("split", F.when(F.month("snapshot_date") < 9, "train").otherwise("oot"))
    moments = found.groupBy("store_nbr", "split").agg(*linear.moments(COLUMNS, schemas.LABEL))
    train = moments.where("split = 'train'").drop("split")
    fits = linear.solved(train, COLUMNS, 0.1)
    got = {r["store_nbr"]: r for r in linear.summary_by(moments, fits, ["store_nbr"], COLUMNS, 0.1).collect()}
    plain = {
        (r["store_nbr"], r["split"]): r["rmse"]
        for r in found.join(fits, "store_nbr")
        .withColumn("e", linear.prediction(COLUMNS) - F.col(schemas.LABEL))
        .groupBy("store_nbr", "split")
        .agg(F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"))
        .collect()
    }
    assert len(got) == 12 and all(r["test_rmse"] is None for r in got.values())
    for (store, split), rmse in plain.items():
        assert got[store][f"{split}_rmse"] == pytest.approx(rmse)


def test_solver_without_penalty_leaves_repeated_columns_out(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 2.0, 5.0), ("a", 2.0, 4.0, 7.0), ("a", 4.0, 8.0, 11.0), ("b", 1.0, 1.0, 3.0)],
        "k string, x double, twice double, y double",
    )
    got = {r["k"]: r for r in linear.fitted(rows, ["k"], ["x", "twice"], "y", 0.0).collect()}
    assert (got["a"]["coef_x"], got["a"]["coef_twice"], got["a"]["intercept"]) == pytest.approx((2.0, 0.0, 3.0))
    assert (got["b"]["coef_x"], got["b"]["coef_twice"], got["b"]["intercept"]) == (0.0, 0.0, 3.0)


def test_months_take_the_model_live_then(spark, panel, models):
    """Months without a decision keep the last one, also where the panel lacks the month of the decision."""
    decided = [(month(25), month(23)), (month(27), None), (month(28), month(26))]
    timeline = spark.createDataFrame(decided, "snapshot_date date, deployed_version date")
    features = panel.where((F.col("snapshot_date") >= month(24)) & (F.col("snapshot_date") != month(28)))
    got = sliding.as_of_predictions(features, models, timeline, COLUMNS).collect()
    expected = {25: 23, 26: 23, 27: 23, 29: 26}
    assert {(r["snapshot_date"], r["training_window_end"]) for r in got} == {
        (month(a), month(b)) for a, b in expected.items()
    }
    fits = {r["training_window_end"]: r for r in models.collect()}
    rows = {(r["snapshot_date"], r["store_nbr"]): r for r in features.collect()}
    for r in got:
        fit, own = fits[r["training_window_end"]], rows[r["snapshot_date"], r["store_nbr"]]
        value = fit["intercept"] + sum(fit[f"coef_{c}"] * own[c] for c in COLUMNS)
        assert r[schemas.PREDICTION] == pytest.approx(value)


def test_replay_counts_the_errors_of_the_live_version(spark):
    """Version 0 goes live, fails in month 5, is replaced by version 2, whose own errors count from then on."""
    offers = [(month(k), 10.0, 8.0, 0.5 + k / 100) for k in range(3)]
    good, bad = (10.0, 8.0, 0.5), (30.0, 20.0, 0.1)
    scores = [
        (month(m), month(v), *(bad if (m, v) == (5, 0) else good)) for m in range(2, 9) for v in range(0, m - 1)
    ]
    candidates = spark.createDataFrame(offers, "model_version date, rmse double, mae double, r2 double")
    live = spark.createDataFrame(scores, "snapshot_date date, model_version date, rmse double, mae double, r2 double")
    got = lifecycle.deployment_timeline(live, candidates, str(month(2)), "any").orderBy("snapshot_date").collect()
    assert [r["deployed_version"] for r in got] == [month(0)] * 4 + [month(2)] * 3
    assert [r["breach_flag"] for r in got] == [False, False, False, True, False, False, False]
    assert [r["promoted"] for r in got] == [True, False, False, False, True, False, False]
    assert got[0]["rmse"] is None and got[3]["rmse"] == 30.0 and got[4]["rmse"] == 10.0
