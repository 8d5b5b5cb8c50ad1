"""Stored histograms give what the full plan gives, and a new month touches its own partition only."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import drift
from shelfcast.plans import drift_store
from shelfcast.plans.jobs import Layout

MONTHS = [dt.date(2015, m, 1) for m in (4, 5, 6, 7)]
VARIABLES = ["x", "few", "gone"]
FIRST, SECOND = "2015-04-01", "2015-05-01"


@pytest.fixture
def features(spark):
    """``gone`` has no value in the last month, ``few`` has three values; nulls and NaN are there."""
    rows = [
        (m, float((i * 37 + k * 11) % 101), float(i % 3 + (k == 2)), None if k == 3 else float(i))
        for k, m in enumerate(MONTHS)
        for i in range(120)
    ]
    rows += [(m, None, float("nan"), None) for m in MONTHS]
    return spark.createDataFrame(rows, "snapshot_date date, x double, few double, gone double").repartition(3)


def plain(df):
    return sorted(tuple(r) for r in df.select("variable", "snapshot_date", "bin", "lower", "ref_n", "cur_n", "ref_share", "cur_share").collect())


def files_below(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def test_stored_counts_equal_the_full_plan(spark, features, tmp_path):
    at = Layout(raw="", root=str(tmp_path))
    for reference, method in ((FIRST, "quantile"), (SECOND, "uniform")):
        drift_store.fix_edges(features, at, reference, VARIABLES, 5, method)
        drift_store.count_months(features, at, reference, ["2015-04-01", "2015-05-01", "2015-06-01"])
    before = files_below(at.gold(drift_store.COUNTS))
    drift_store.count_months(features, at, FIRST, ["2015-07-01"])
    after = files_below(at.gold(drift_store.COUNTS))
    assert before.items() <= after.items()
    assert all("reference_date=2015-04-01/snapshot_date=2015-07-01" in p for p in after.keys() - before.keys())

    full = drift.binned_comparison(features, FIRST, VARIABLES, 5)
    assert plain(drift_store.comparison(spark, at, FIRST)) == plain(full)
    other = drift.binned_comparison(features, SECOND, VARIABLES, 5, "uniform")
    assert plain(drift_store.comparison(spark, at, SECOND)) == plain(other.where("snapshot_date < date '2015-07-01'"))

    one = drift_store.comparison(spark, at, FIRST, ["2015-07-01"])
    assert plain(one) == plain(full.where(F.col("snapshot_date").isin(MONTHS[0], MONTHS[3])))
    filters = next(x for x in one._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in x)
    assert "reference_date" in filters and "snapshot_date" in filters.split("PartitionFilters")[1]


def test_a_month_counted_again_replaces_itself(spark, features, tmp_path):
    at = Layout(raw="", root=str(tmp_path))
    drift_store.fix_edges(features, at, FIRST, ["x"])
    for _ in range(2):
        drift_store.count_months(features, at, FIRST)
    assert plain(drift_store.comparison(spark, at, FIRST)) == plain(drift.binned_comparison(features, FIRST, ["x"]))
    drift_store.count_months(features.where("x < 50 or snapshot_date != date '2015-06-01'"), at, FIRST, ["2015-06-01"])
    june = drift_store.comparison(spark, at, FIRST, ["2015-06-01"]).where("snapshot_date = date '2015-06-01'")
    wanted = features.where("x < 50 and snapshot_date = date '2015-06-01'").count()
    assert june.agg(F.sum("cur_n")).first()[0] == wanted


def test_without_edges_or_rows(spark, features, tmp_path):
    at = Layout(raw="", root=str(tmp_path))
    drift_store.fix_edges(features, at, FIRST, VARIABLES)
    with pytest.raises(ValueError, match="no edges"):
        drift_store.count_months(features, at, SECOND)
    drift_store.count_months(features, at, FIRST)
    drift_store.count_months(features.limit(0), at, FIRST)
    assert drift_store.comparison(spark, at, FIRST).select("snapshot_date").distinct().count() == len(MONTHS)
