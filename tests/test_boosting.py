"""Boosting over blocks gives the trees of Spark's trainer, in as many rounds as are needed."""

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfcast.operators import boosting, modelling
from shelfcast.plans import queries_models, registry
from shelfcast.session import written


@pytest.fixture(scope="module")
def vectors(spark):
    """Numbers with many and with few values, a tree category, a constant."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(3000):
        a, b, c = float(rng.uniform(0, 10)), float(rng.integers(0, 5)), "uvwxyz"[rng.integers(0, 6)]
        y = 100 + 5 * np.sin(a) + b * (c in "vz") + 3 * ("uvwxyz".index(c) % 3) + float(rng.normal(0, 0.5))
        rows.append((k, a, b, c, 1.0, float(y)))
    df = spark.createDataFrame(rows, "k int, a double, b double, c string, one double, y double")
    indexed = StringIndexer(inputCol="c", outputCol="c_idx", handleInvalid="keep").fit(df).transform(df)
    made = VectorAssembler(inputCols=["a", "b", "c_idx", "one"], outputCol="features").transform(indexed)
    stored = written(made.select("k", "features", "y"), "test_vectors")
    return stored.where("k < 2400").select("features", "y"), stored.where("k >= 2400").select("features", "y")


def regressor(**more):
    return GBTRegressor(featuresCol="features", labelCol="y", predictionCol="p", stepSize=0.2, seed=3, **more)


@pytest.mark.parametrize("cells", [boosting.MOST_CELLS, 100])
def test_trees_are_those_of_sparks_trainer(vectors, monkeypatch, cells):
    """Splits, gains, counts and predictions; also with blocks of few rows and the nodes of a level in several passes."""
    monkeypatch.setattr(boosting, "MOST_CELLS", cells)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 200)
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    train, held = vectors
    of = regressor(maxDepth=4, maxIter=5, maxBins=32)
    seen = []
    found = boosting.boosted(of, train, held, lambda curve: (seen.append(list(curve)), (len(curve), False))[1])
    expected = of.fit(train)
    assert found.getNumTrees == expected.getNumTrees == 5
    assert found.treeWeights == expected.treeWeights
    assert seen[-1] == pytest.approx(expected.evaluateEachIteration(held, "squared"))
    assert list(found.featureImportances.toArray()) == pytest.approx(list(expected.featureImportances.toArray()))
    for mine, theirs in zip(found.trees, expected.trees):
        assert (mine.numNodes, mine.depth) == (theirs.numNodes, theirs.depth)
        assert [w for w in mine.toDebugString.split() if w[0] not in "-0123456789"][2:] == [
            w for w in theirs.toDebugString.split() if w[0] not in "-0123456789"
        ][2:]
    both = found.transform(held).join(expected.transform(held).withColumnRenamed("p", "q"), ["features", "y"])
    assert both.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-8


def test_no_round_is_fitted_twice(vectors, monkeypatch):
    """Boosting ends right after the patience is used up, and every tree is grown once."""
    train, held = vectors
    grown, trees = boosting.grown, []
    monkeypatch.setattr(boosting, "grown", lambda *a: trees.append(grown(*a)) or trees[-1])
    noise = [x.withColumn("y", (F.col("y") * 1e6) % 1) for x in (train, held)]
    model = boosting.boosted(
        regressor(maxDepth=2, maxIter=40), *noise, lambda curve: modelling.best_round(curve, 3)
    )
    assert len(trees) == model.getNumTrees + 3 < 40


def test_of_features_that_part_the_rows_alike_the_first_is_taken():
    """Whatever rounding the order of the sums leaves: the second feature's gain is larger by that alone."""
    cuts, node = np.array([0.5]), boosting.Node()
    first, second = np.array([3.3, 7.7]), np.array([np.nextafter(3.3, 0), np.nextafter(7.7, 8)])
    counts = np.array([10.0, 10.0])
    boosting.best_splits([node], [counts, counts, first, second, np.array([9.0])], boosting.Bins([cuts, cuts], [2, 2]))
    assert node.feature == 0 and [c.total for c in node.children] == pytest.approx([3.3, 7.7])


def test_sampled_rows_are_drawn_anew_every_round_and_repeat():
    draw = lambda number, done: boosting._sampled(number, 10_000, 0.8, 42, done)
    assert draw(1, 2).mean() == pytest.approx(0.8, abs=0.02)
    assert (draw(1, 2) == draw(1, 2)).all()
    assert (draw(1, 2) != draw(1, 3)).any() and (draw(1, 2) != draw(2, 2)).any()
    assert boosting._sampled(1, 10, 1.0, 42, 1) is None


def test_missing_labels_are_an_error(vectors):
    train, held = vectors
    with pytest.raises(ValueError, match="null or NaN"):
        boosting.boosted(regressor(maxIter=2), train, held.withColumn("y", F.lit(None).cast("double")), lambda c: (1, False))


def test_weekly_forecast_rolls_the_sales_up_once(spark, sf_dir, monkeypatch):
    """The lines are read for one stored weekly table, which the fit, its cutoffs and the forecast share."""
    scans, daily = [], queries_models.retail.daily_sales
    monkeypatch.setattr(queries_models.retail, "daily_sales", lambda *a: scans.append(a) or daily(*a))
    monkeypatch.setattr(queries_models, "_weekly_boosted", {})
    monkeypatch.setattr(modelling, "best_round", lambda curve, patience: (len(curve), len(curve) == 2))
    found = registry.QUERIES["m15_next_week_forecast"](spark, sf_dir)
    assert len(scans) == 1
    assert not any("lineitem" in f for f in found.inputFiles())
    assert found.where("pred_sales_next_week is null").count() == 0
