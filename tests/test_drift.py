"""Exact quantiles and drift statistics against numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions import quantiles
from shelfcast.operators import drift
from shelfcast.session import written

REF, CUR = dt.date(2015, 4, 1), dt.date(2015, 6, 1)


def numpy_edges(ref, n=10):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, n + 1)))
    return edges if len(edges) > 1 else np.array([ref.min() - 1e-9, ref.max() + 1e-9])


def numpy_shares(x, edges):
    counts = np.histogram(x, bins=edges)[0] + 1e-6
    return counts / counts.sum()


SAMPLES = {
    "lognormal": (lambda r, n: r.lognormal(8, 2, n), lambda r, n: r.lognormal(8.3, 2, n)),
    "few_values": (lambda r, n: r.integers(0, 4, n) * 1.0, lambda r, n: r.integers(0, 5, n) * 1.0),
    "one_hot_value": (
        lambda r, n: np.where(r.random(n) < 0.4, 7.0, r.normal(0, 10, n)),
        lambda r, n: np.where(r.random(n) < 0.1, 7.0, r.normal(1, 10, n)),
    ),
    "constant": (lambda r, n: np.full(n, 5.0), lambda r, n: np.full(n, 9.0)),
    "same_constant": (lambda r, n: np.full(n, 5.0), lambda r, n: np.full(n, 5.0)),
    "tiny": (lambda r, n: r.normal(0, 1, 3), lambda r, n: r.normal(0, 1, 3)),
}


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(5)
    return {k: (f(rng, 5000), g(rng, 4000)) for k, (f, g) in SAMPLES.items()}


@pytest.fixture(scope="module")
def features(spark, samples):
    """A wide table: one row per position, one column per sample; nulls and NaN mixed in."""
    frames = []
    for side, month in ((0, REF), (1, CUR)):
        for name, pair in samples.items():
            values = [float(v) for v in pair[side]] + [None, float("nan")]
            one = spark.createDataFrame([(v,) for v in values], f"{name} double")
            frames.append(one.withColumn("snapshot_date", F.lit(month)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.repartition(5)


def test_psi_and_csi_equal_numpy(features, samples):
    compared = drift.binned_comparison(features, "2015-04-01", list(samples))
    rows = drift.drift_table(compared.where(F.col("snapshot_date") == F.lit(CUR))).collect()
    got = {r["variable"]: (r["psi"], r["csi"]) for r in rows}
    for name, (ref, cur) in samples.items():
        edges = numpy_edges(ref)
        p, q = numpy_shares(ref, edges), numpy_shares(cur, edges)
        assert got[name] == (
            pytest.approx(np.sum((p - q) * np.log(p / q)), abs=2e-6),
            pytest.approx(np.abs(p - q).sum(), abs=2e-6),
        ), name


def test_constant_reference_never_drifts(features):
    compared = drift.binned_comparison(features, "2015-04-01", ["constant", "same_constant"])
    assert all(r["psi"] == 0 and r["csi"] == 0 for r in drift.drift_table(compared).collect())


def test_shares_add_up_and_reference_equals_itself(features, samples):
    compared = drift.binned_comparison(features, "2015-04-01", list(samples))
    sums = compared.groupBy("variable", "snapshot_date").agg(F.sum("cur_share").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1) for r in sums)
    own = drift.drift_table(compared.where(F.col("snapshot_date") == F.lit(REF))).collect()
    assert all(r["psi"] == 0 and r["severity"] == "stable" for r in own)


def test_variable_without_reference_gets_one_open_bin(spark, features):
    edges = drift.bin_edges(drift.long_values(drift.month_of(features, "2015-04-01"), ["tiny"]), ["tiny", "absent"])
    rows = {r["variable"]: r["edges"] for r in edges.collect()}
    assert rows["absent"] == [float("-inf"), float("inf")]
    assert len(rows["tiny"]) == 11


def test_value_on_the_top_edge_and_outside(spark):
    edges = spark.createDataFrame([("v", [0.0, 5.0, 10.0])], "variable string, edges array<double>")
    values = spark.createDataFrame(
        [("v", REF, x) for x in (0.0, 4.9, 5.0, 10.0, 99.0, -1.0)], "variable string, snapshot_date date, value double"
    )
    counts = {r["bin"]: r["n"] for r in drift.histogram(values, edges, 2).collect()}
    assert counts == {0: 2, 1: 2}


@pytest.mark.parametrize("value, name", [(0.0999, "stable"), (0.10, "moderate"), (0.25, "significant"), (-0.3, "significant")])
def test_severity(spark, value, name):
    assert spark.range(1).select(drift.severity(F.lit(value))).first()[0] == name


def test_exact_quantiles_with_few_rows_per_slot(spark, monkeypatch):
    """Many slots and a third of the rows in one value: still the numpy quantiles."""
    monkeypatch.setattr(quantiles, "ROWS_PER_SLOT", 10)
    rng = np.random.default_rng(1)
    sets = {
        "a": np.concatenate([np.full(1000, 3.25), rng.normal(0, 5, 2000)]),
        "b": rng.exponential(2, 777),
        "c": np.array([4.0]),
    }
    rows = [(k, float(v)) for k, vs in sets.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    probabilities = quantiles.even_probabilities(10) + [0.99, 0.333]
    found = {r["g"]: (r["n"], r["quantiles"]) for r in quantiles.exact_quantiles(df, "g", "x", probabilities).collect()}
    for k, vs in sets.items():
        assert found[k][0] == len(vs)
        assert found[k][1] == [float(v) for v in np.quantile(vs, probabilities)]


def test_quantiles_of_very_many_groups(spark):
    df = spark.range(20_002).selectExpr("id % 10001 as g", "cast(id div 10001 as double) as x")
    found = quantiles.exact_quantiles(df, "g", "x", [0.0, 0.5, 1.0])
    assert found.count() == 10_001
    assert found.where("n != 2 or quantiles != array(0D, 0.5D, 1D)").isEmpty()


def test_slots_above_the_budget_are_split_again(spark, monkeypatch):
    """Three splits in a hot group, two at most in the small one; whatever is sorted keeps to the budget."""
    monkeypatch.setattr(quantiles, "SKETCH_POINTS", 4)
    monkeypatch.setattr(quantiles, "ROWS_PER_SLOT", 20)
    stored = {}

    def recorded(df, name, *rest):
        out = written(df, name, *rest)
        stored.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(quantiles, "written", recorded)
    rng = np.random.default_rng(3)
    infinite = np.concatenate([np.full(40, np.inf), np.full(30, -np.inf), rng.normal(0, 1, 81)])
    sets = {
        "hot": np.concatenate([np.full(1500, 2.5), rng.lognormal(1, 2, 3000), [0.0, -0.0]]),
        "small": rng.normal(0, 1, 50),
        "infinite": infinite,
    }
    rows = [(k, float(v)) for k, vs in sets.items() for v in vs] + [("hot", None), ("hot", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    wanted = quantiles.even_probabilities(10) + [0.003, 0.997]
    found = {r["g"]: (r["n"], r["quantiles"]) for r in quantiles.exact_quantiles(df, "g", "x", wanted).collect()}
    for k in ("hot", "small"):
        assert found[k] == (len(sets[k]), [float(v) for v in np.quantile(sets[k], wanted)])
    assert found["infinite"][0] == 151
    assert found["infinite"][1][:2] == [-np.inf, -np.inf] and found["infinite"][1][10] == np.inf
    assert len(stored["narrowed_values"]) >= 3
    assert len(stored["wanted_ranks"]) == len(stored["narrowed_values"]) + 1
    for asks, narrowed in zip(stored["wanted_ranks"], stored["narrowed_values"]):
        large = asks.where("in_slot > 20 and slot % 2 = 0")
        assert large.agg(F.sum("in_slot")).first()[0] == narrowed.count()
    assert stored["wanted_ranks"][-1].where("in_slot > 20 and slot % 2 = 0").isEmpty()


def test_clipped_density_covers_few_valued_variables(spark, sf_dir):
    """Every variable with a value in the reference month has bars, one of a single value too."""
    import __spark_entry__ as contract

    found = {name: contract.queries()[name](spark, sf_dir) for name in ("d10_clipped_density", "d1_quantile_edges")}
    charted, binned = ({r["variable"] for r in df.select("variable").distinct().collect()} for df in found.values())
    few = {r["variable"] for r in contract.queries()["d10_category_shares"](spark, sf_dir).select("variable").collect()}
    assert few and few <= charted and charted == binned
