"""Stores kept up by new days, files landed once, days as bits, and what a report says is missing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import drift, profile
from shelfcast.plans import incremental, jobs, monthly
from shelfcast.sources import schemas

D = dt.date
SALES = "id string, date date, store_nbr string, family string, sales float, onpromotion int"


def files_of(path, month):
    folder = f"{path}/snapshot_date={month}"
    return {name: os.stat(f"{folder}/{name}").st_mtime_ns for name in os.listdir(folder) if name.endswith(".parquet")}


@pytest.fixture
def days(spark):
    rows = [
        (f"{m}-{d}-{s}", D(2015 + m // 12, 1 + m % 12, d), str(s), "A" if s else None, float(m * d + s), (m + d) % 3 % 2)
        for m in range(14)
        for d in (1, 9, 20)
        for s in range(3)
    ]
    sales = spark.createDataFrame(rows, SALES)
    calendar = sales.select("date").distinct()
    data = monthly.Retail(
        sales=sales.withColumn("snapshot_date", F.trunc("date", "month")),
        transactions=sales.groupBy("date", "store_nbr")
        .agg(F.count("*").cast("int").alias("transactions"))
        .withColumn("snapshot_date", F.trunc("date", "month")),
        oil=calendar.select("date", F.dayofmonth("date").cast("float").alias("dcoilwtico")),
        holiday_features=sales.select(F.trunc("date", "month").alias("snapshot_date"))
        .distinct()
        .select("snapshot_date", *[F.lit(1).cast("long").alias(c) for c in schemas.NUMERIC_FEATURES if "holiday" in c or c.startswith("num_")]),
    )
    return data


def land(at, data, rows, batch):
    return incremental.land(at, "daily_sales", rows(data.sales), batch).union(
        incremental.land(at, "daily_transactions", rows(data.transactions), batch)
    ).distinct()


def test_delta_equals_rebuild_and_keeps_other_months(spark, tmp_path, days):
    at = jobs.Layout(raw="", root=str(tmp_path / "mart"))
    late = F.col("date") == F.lit("2015-05-20").cast("date")
    touched = land(at, days, lambda df: df.where(~late), "0")
    incremental.refresh(spark, at, touched, days.oil, days.holiday_features)
    months = [f"2015-{m:02d}-01" for m in range(3, 13)] + ["2016-01-01", "2016-02-01"]
    before = {m: files_of(at.gold("feature_store"), m) for m in months}
    for _ in range(2):  # landing a batch again changes nothing
        touched = land(at, days, lambda df: df.where(late), "1")
        assert [r[0] for r in touched.collect()] == [D(2015, 5, 1)]
        incremental.refresh(spark, at, touched, days.oil, days.holiday_features)
    after = {m: files_of(at.gold("feature_store"), m) for m in months}
    assert [m for m in months if before[m] != after[m]] == ["2015-05-01", "2015-06-01", "2015-07-01"]
    for name, full in (("feature_store", monthly.feature_store(days)), ("label_store", monthly.label_store(days))):
        stored = spark.read.schema(full.schema).parquet(at.gold(name)).select(*[f"`{c}`" for c in full.columns])
        assert stored.count() == full.count() > 0
        assert stored.exceptAll(full).isEmpty()


def test_files_land_once_and_failed_steps_are_repeated(spark, tmp_path, monkeypatch):
    at = jobs.Layout(raw=str(tmp_path / "raw"), root=str(tmp_path / "mart"))
    folder = tmp_path / "raw" / "daily_transactions"
    folder.mkdir(parents=True)

    def drop(name, *rows):
        (folder / name).write_text("\n".join(["date,store_nbr,transactions", *rows]) + "\n")

    def state():
        return sorted(tuple(r) for r in incremental.rolled_up(spark, at, "daily_transactions").collect())

    assert state() == []
    drop("a.csv", "2015-01-02,1,5", "2015-01-03,1,6", "2015-02-01,2,1", "no day,1,100")
    assert incremental.land_new_files(spark, at, "daily_transactions") == 4
    first = [(D(2015, 1, 1), "1", 11), (D(2015, 2, 1), "2", 1)]
    assert state() == first
    assert incremental.land_new_files(spark, at, "daily_transactions") == 0

    drop("b.csv", "2015-01-30,1,100")
    whole, fails = incremental.land, [True]

    def broken(*args):
        found = whole(*args)
        if fails.pop():
            raise RuntimeError("lost after landing")
        return found

    monkeypatch.setattr(incremental, "land", broken)
    with pytest.raises(Exception, match="lost after landing"):
        incremental.land_new_files(spark, at, "daily_transactions")
    fails.append(False)
    incremental.land_new_files(spark, at, "daily_transactions")
    assert state() == [(D(2015, 1, 1), "1", 111), first[1]]


def test_days_as_bits(spark):
    rows = [(D(2015, 1, 31), "1", "A"), (D(2015, 1, 31), "1", "A"), (D(2015, 1, 1), "1", "B"), (D(2015, 2, 1), "2", None),
            (None, "2", "A"), (D(2015, 2, 28), None, "A")]
    df = spark.createDataFrame(rows, "date date, store_nbr string, family string")
    assert tuple(profile.panel_density(df).first()) == (4, 2, 2, 6, 16)
    assert tuple(profile.panel_density(df.limit(0)).first()) == (0, 0, 0, 0, 0)
    assert [tuple(r) for r in profile.busy_store_months(df).collect()] == [("1", D(2015, 1, 1), 2)]
    plan = profile.panel_density(df)._jdf.queryExecution().optimizedPlan().toString()
    scan = plan.index("LogicalRDD")
    assert plan.rindex("Expand") < plan.rindex("Aggregate") < scan  # rows are combined before they are multiplied


def test_variables_missing_on_one_side(spark):
    rows = [(D(2015, 1, 1), 1.0, None), (D(2015, 1, 1), 2.0, float("nan")), (D(2015, 2, 1), None, 3.0)]
    df = spark.createDataFrame(rows, "snapshot_date date, a double, b double")
    found = {r["snapshot_date"]: r["missing"] for r in drift.missing_variables(df, ["a", "c", "b"]).collect()}
    assert found == {D(2015, 1, 1): ["c", "b"], D(2015, 2, 1): ["a", "c"]}


def test_few_reference_values_are_categories(spark):
    rows = [("x", D(2015, 1, 1), float(k % 2)) for k in range(5)] + [("y", D(2015, 1, 1), float(k)) for k in range(3)]
    df = spark.createDataFrame(rows, "variable string, snapshot_date date, value double")
    kinds = drift.charted(df)
    assert dict(tuple(r) for r in kinds.collect()) == {"x": "category", "y": "histogram"}
    assert drift.of_kind(df, kinds, "histogram").count() == 3
