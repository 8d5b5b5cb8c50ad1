import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from shelfcast.operators import modelling
from shelfcast.plans import training


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    data = []
    for key, n in (("a", 60), ("b", 40), ("flat", 10), ("one", 1)):
        for _ in range(n):
            x = [float(rng.normal(5, 2)), float(rng.normal(100, 30)), 4.0]
            y = 7.0 if key == "flat" else 3 * x[0] - 0.2 * x[1] + float(rng.normal(0, 1))
            data.append((key, *x, y))
    return spark.createDataFrame(data, "k string, x0 double, x1 double, x2 double, y double")


def test_ridge_equals_spark_linear_regression(rows):
    columns = ["x0", "x1", "x2"]
    models = {r["k"]: r for r in modelling.ridge_by(rows, ["k"], columns, "y", 0.1).collect()}
    for key in ("a", "b"):
        one = VectorAssembler(inputCols=columns, outputCol="features").transform(rows.where(F.col("k") == key))
        spark_fit = LinearRegression(labelCol="y", regParam=0.1, elasticNetParam=0.0).fit(one)
        assert models[key]["intercept"] == pytest.approx(spark_fit.intercept, rel=1e-6)
        assert [models[key][f"coef_{c}"] for c in columns] == pytest.approx(list(spark_fit.coefficients), rel=1e-6, abs=1e-9)
    assert models["flat"]["intercept"] == pytest.approx(7.0)
    assert models["one"]["n_rows"] == 1
    assert [models["one"][f"coef_{c}"] for c in columns] == [0.0] * 3


def test_scaling_of_single_and_constant_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("b", 5.0), ("c", 1.0), ("c", 3.0)], "k string, v double")
    got = sorted((r["k"], round(r["v_scaled"], 6)) for r in modelling.standardize_by(df, ["k"], ["v"]).collect())
    assert got == [("a", 0.0), ("b", 0.0), ("b", 0.0), ("c", -0.707107), ("c", 0.707107)]


def test_own_label_does_not_change_own_encoding(spark):
    """Every row's encoding is the other folds' smoothed mean, whatever happens to its own label."""
    rng = np.random.default_rng(8)
    data = [(k, f"c{k % 7}" if k % 11 else None, float(rng.normal(k % 7, 1)) if k % 13 else None) for k in range(200)]
    frame = lambda rows: spark.createDataFrame(rows, "k int, c string, y double")
    folds = {r["k"]: r["f"] for r in frame(data).select("k", modelling.fold_of(["k"], 5).alias("f")).collect()}
    inside, new = modelling.out_of_fold_encoding(frame(data), "c", "y", ["k"], folds=5, prior=3.0)
    found = {r["k"]: r["c_idx"] for r in inside.collect()}

    def mean(rows, whole):
        labels, every = ([y for _, _, y in part if y is not None] for part in (rows, whole))
        return (sum(labels) + 3.0 * sum(every) / len(every)) / (len(labels) + 3.0)

    for k, c, _ in data:
        rest = [r for r in data if folds[r[0]] != folds[k]]
        assert found[k] == pytest.approx(mean([r for r in rest if r[1] == c], rest))
    moved = [(k, c, 1e6 if k == 50 else y) for k, c, y in data]
    again, _ = modelling.out_of_fold_encoding(frame(moved), "c", "y", ["k"], folds=5, prior=3.0)
    assert again.where("k = 50").first()["c_idx"] == pytest.approx(found[50])
    table = {r["c"]: r["c_idx"] for r in new.collect()}
    labelled = [y for _, _, y in data if y is not None]
    assert table[None] == pytest.approx(sum(labelled) / len(labelled)) and len(table) == 8
    assert table["c3"] == pytest.approx(mean([r for r in data if r[1] == "c3"], data))
    inside, new = modelling.out_of_fold_encoding(frame(data[:0]), "c", "y", ["k"])
    assert inside.count() == 0 and [tuple(r) for r in new.collect()] == [(None, 0.0)]


def panel(spark, stores):
    rng = np.random.default_rng(4)
    data = []
    for m in range(6):
        for s in range(stores):
            level = float(s % 9) * 10
            noise = float(rng.normal(0, 1))
            data.append((dt.date(2015, 1 + m, 1), str(s), "A" if s % 2 else None, level, level * 2 + noise))
    return spark.createDataFrame(data, "snapshot_date date, store_nbr string, family string, v double, y double")


@pytest.mark.parametrize("mean_encoded", [(), ("store_nbr",)])
def test_trees_beat_the_mean_and_survive_saving(spark, tmp_path, mean_encoded):
    df = panel(spark, 30)
    train, held = df.where("snapshot_date < '2015-05-01'"), df.where("snapshot_date >= '2015-05-01'")
    model = modelling.boosted_trees(
        train, held, ["v"], ["store_nbr", "family"], "y", trees=5, depth=3, mean_encoded=mean_encoded
    )
    assert set(model.encodings) == set(mean_encoded)
    score = modelling.regression_scores(model.predict(held), label="y").first()
    assert score["r2"] > 0.9
    assert {r["feature"] for r in model.gains().collect()} == {"v", "store_nbr_idx", "family_idx"}
    model.save(str(tmp_path / "m"))
    again = modelling.TreeModel.load(spark, str(tmp_path / "m"), ["v"], ["store_nbr", "family"])
    pick = lambda m: sorted((r["store_nbr"], r["predicted_sales"]) for r in m.predict(held).collect())
    assert pick(again) == pick(model)


def test_unseen_category_is_scored(spark):
    df = panel(spark, 10)
    model = modelling.boosted_trees(df, df, ["v"], ["store_nbr", "family"], "y", trees=2)
    new = df.limit(1).withColumn("store_nbr", F.lit("new")).withColumn("v", F.lit(None).cast("double"))
    assert model.predict(new).count() == 1


def test_categories_only_in_validation_and_too_many_for_trees(spark):
    few, many = panel(spark, 3), panel(spark, 60)
    model = modelling.boosted_trees(few, many, ["v"], ["store_nbr", "family"], "y", trees=2)
    assert model.predict(many).count() == many.count()
    with pytest.raises(ValueError, match="mean_encoded"):
        modelling.boosted_trees(many, many, ["v"], ["store_nbr"], "y", trees=2, most_bins=50)


def test_patience_counts_rounds_without_a_lower_error():
    assert modelling.best_round([5, 4, 4, 4.5], 2) == (2, True)
    assert modelling.best_round([5, 4, 4.5, 3.9, 4, 4], 3) == (4, False)
    assert modelling.best_round([5, 4, 4.1, 4.2, 1], 2) == (2, True)
    assert modelling.best_round([5, 4, 3], 50) == (3, False)


@pytest.fixture(scope="module")
def slow(spark):
    """Small steps on a smooth signal: every round gains far less than one percent for long."""
    rng = np.random.default_rng(9)
    x = rng.uniform(0, 10, (600, 2))
    y = 5 * x[:, 0] + x[:, 1] + np.sin(3 * x[:, 0]) + rng.normal(0, 0.5, 600)
    rows = [("s", "f", float(a), float(b), float(c)) for (a, b), c in zip(x, y)]
    df = spark.createDataFrame(rows, "store_nbr string, family string, a double, b double, y double")
    parts = df.withColumn("k", F.pmod(F.xxhash64("a"), F.lit(3)))
    train, held = parts.where("k > 0").drop("k"), parts.where("k = 0").drop("k")
    model = modelling.boosted_trees(train, held, ["a", "b"], ["store_nbr"], "y", trees=60, depth=2, rate=0.04, patience=8)
    return model, train, held


def test_boosting_goes_on_past_small_gains_and_keeps_the_best_prefix(spark, slow, tmp_path):
    model, train, held = slow
    ensemble = model.pipeline.stages[-1]
    assert ensemble.getNumTrees > 25
    judged = model.prepare(held)
    for stage in model.pipeline.stages[:-1]:
        judged = stage.transform(judged)
    curve = ensemble.evaluateEachIteration(judged.select("features", F.col("y")), "squared")
    assert len(curve) == ensemble.getNumTrees and min(curve) == curve[-1]
    assert max(1 - b / a for a, b in zip(curve[20:], curve[21:])) > 0
    scored = model.predict(held).agg(F.avg(F.pow(F.col("predicted_sales") - F.col("y"), 2))).first()[0]
    assert scored == pytest.approx(curve[-1])
    model.save(str(tmp_path / "slow"))
    again = modelling.TreeModel.load(spark, str(tmp_path / "slow"), ["a", "b"], ["store_nbr"])
    pick = lambda m: sorted(r["predicted_sales"] for r in m.predict(held).collect())
    assert pick(again) == pick(model)


def test_gains_add_up_like_the_importances_of_each_tree(slow):
    model, *_ = slow
    got = {r["feature"]: r["gain"] for r in model.gains().collect()}
    assert set(got) == {"a", "b", "store_nbr_idx"} and got["store_nbr_idx"] == 0.0
    assert got["a"] > got["b"] > 0
    # of a single tree, Spark's importance is the share of the total gain
    one = modelling.first_rounds(model.pipeline.stages[-1], 1)
    alone = modelling.replace(model, pipeline=modelling.PipelineModel([*model.pipeline.stages[:-1], one]))
    gains = [r["gain"] for r in alone.gains().collect()]
    assert [g / sum(gains) for g in gains] == pytest.approx(list(one.featureImportances.toArray()))


def test_trained_trees_do_not_grow_with_the_stores(spark):
    """Stores are no tree category, so neither the bins of the numbers nor the sums of a node depend on their count."""
    weeks = spark.range(300 * 50).select(
        (F.col("id") % 300).cast("string").alias("store_nbr"),
        F.lit("A").alias("family"),
        F.date_add(F.lit(dt.date(2015, 1, 5)), (F.floor(F.col("id") / 300) * 7).cast("int")).alias("week_start"),
        (F.col("id") % 7).cast("double").alias("sales_week"),
        (F.col("id") % 7).cast("double").alias("sales_lag_1"),
        F.lit(1.0).alias("sales_avg_4"),
        F.lit(1).alias("weekofyear"),
    )
    model = training.weekly_boosted_trees(weeks, trees=2).model
    assert set(model.encodings) == {"store_nbr"}
    assert model.encodings["store_nbr"].count() == 301
    assert model.pipeline.stages[-1].getMaxBins() == modelling.NUMBER_BINS
