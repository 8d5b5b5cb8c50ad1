"""Hand-made frames for the awkward cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import dates
from shelfcast.functions.text import truth_flag
from shelfcast.operators import clean, dataset, holidays, panel, rollup, scoring, trailing, weekly
from shelfcast.sources import schemas

D = dt.date


def sales(spark, *rows):
    """rows of (date text, store, family, sales)"""
    df = spark.createDataFrame(list(rows), "date string, store_nbr string, family string, sales double")
    return df.select(
        F.monotonically_increasing_id().cast("string").alias("id"),
        F.to_date("date").alias("date"),
        "store_nbr",
        "family",
        F.col("sales").cast("float").alias("sales"),
        F.lit(0).alias("onpromotion"),
    )


def test_first_active_by_day_and_by_total_differ(spark):
    df = sales(spark, ("2013-01-01", "1", "A", 1.0), ("2013-01-02", "1", "A", -1.0), ("2013-02-01", "1", "A", 1.0))
    assert rollup.first_active(df, ["store_nbr"]).first()[1] == D(2013, 1, 1)
    assert rollup.first_active_by_total(df, ["store_nbr"]).first()[1] == D(2013, 2, 1)


def test_missing_month_shrinks_the_average(spark):
    df = sales(spark, ("2013-01-05", "1", "A", 10.0), ("2013-03-05", "1", "A", 20.0), ("2013-04-05", "1", "A", 40.0))
    rows = {r["snapshot_date"]: r for r in trailing.sales_features(rollup.monthly_sales(df)).collect()}
    assert rows[D(2013, 3, 1)]["AVG_sales_L3M"] == 15.0
    assert rows[D(2013, 4, 1)]["SUM_sales_L3M"] == 60.0


def test_months_with_full_history(spark):
    months = spark.createDataFrame(
        [(D(2013, m, 1),) for m in (1, 2, 3, 5, 6, 7)], "snapshot_date date"
    )
    assert [r[0] for r in trailing.complete_months(months).collect()] == [D(2013, 3, 1), D(2013, 7, 1)]


def test_two_holidays_on_a_date_do_not_double_sales(spark):
    events = spark.createDataFrame(
        [(D(2013, 1, 1), "National"), (D(2013, 1, 1), "National"), (D(2013, 1, 2), "Local")], "date date, locale string"
    )
    df = sales(spark, ("2013-01-01", "1", "A", 5.0), ("2013-01-02", "1", "A", 7.0))
    row = weekly.weekly_rollup(df, holidays.holiday_dates(events)).first()
    assert (row["weekly_sales_sum"], row["any_holiday"], row["days_in_week"]) == (12.0, 1, 2)


def test_month_without_holidays_has_no_next_month_value(spark):
    events = spark.createDataFrame(
        [(D(2013, 1, 1), "Event", "Local", "True"), (D(2013, 3, 1), "Work Day", "Local", None)],
        "date date, type string, locale string, transferred string",
    )
    rows = {r["snapshot_date"]: r for r in holidays.with_next_month(holidays.monthly_holidays(events)).collect()}
    assert set(rows) == {D(2013, 1, 1), D(2013, 3, 1)}
    assert rows[D(2013, 1, 1)]["num_holidays_total_NM"] is None
    assert rows[D(2013, 3, 1)]["num_holidays_type_Work Day"] == 1


@pytest.mark.parametrize(
    "word, flag", [("True", 1), ("1", 1), ("t", 1), ("YES", 1), ("y", 1), ("False", 0), ("0", 0), ("?", 0), (None, 0)]
)
def test_boolean_words(spark, word, flag):
    df = spark.createDataFrame([(word,)], "w string")
    assert df.select(truth_flag("w")).first()[0] == flag


def test_bad_values_become_null(spark):
    df = spark.createDataFrame([("abc", "2015-13-01", "x"), ("1.5", "2015-12-01", "y")], "sales string, date string, other string")
    rows = clean.cast_columns(df, schemas.SALES_TYPES).collect()
    assert tuple(rows[0]) == (None, None, "x")
    assert tuple(rows[1]) == (1.5, D(2015, 12, 1), "y")


def test_imputation_and_all_null_month(spark):
    df = spark.createDataFrame(
        [(D(2013, 1, 1), 1.0), (D(2013, 1, 1), None), (D(2013, 1, 1), 3.0), (D(2013, 2, 1), None)],
        "snapshot_date date, v double",
    )
    got = sorted(clean.impute_by_month(df, "v").select("snapshot_date", "v").collect())[:3]
    assert [r["v"] for r in got] == [1.0, 2.0, 3.0]
    assert clean.impute_by_month(df, "v").where("snapshot_date = '2013-02-01'").first()["v"] is None


def test_required_columns(spark):
    with pytest.raises(ValueError, match="date"):
        clean.require_columns(spark.range(1), ["date"])


def test_rolling_seven_needs_seven_rows_of_its_own_group(spark):
    rows = [("1", "A", D(2013, 1, 1) + dt.timedelta(i), float(i)) for i in range(9)]
    rows += [("2", "A", D(2013, 1, 1) + dt.timedelta(i), float(i + 9)) for i in range(9)]
    df = spark.createDataFrame(rows, "store_nbr string, family string, date date, sales double")
    got = [r["rolling_mean_7"] for r in panel.rolling(df).orderBy("store_nbr", "date").collect()]
    assert got == [None] * 7 + [3.0, 4.0] + [None] * 7 + [12.0, 13.0]


def test_iso_week_at_year_end(spark):
    df = spark.createDataFrame([(D(2021, 1, 3),)], "d date")
    row = df.select(dates.iso_week("d"), dates.weekday_monday0("d"), dates.week_start("d")).first()
    assert tuple(row) == (53, 6, D(2020, 12, 28))


def test_partition_tags_in_both_spellings(spark):
    df = spark.createDataFrame([("2015-06-01",), ("2015_06_01",), ("other",)], "t string")
    assert [r[0] for r in df.select(dates.snapshot_from_tag("t")).collect()] == [D(2015, 6, 1)] * 2 + [None]


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([(5.0, 5.0), (5.0, 5.0)], 1.0),
        ([(5.0, 5.0), (5.0, 6.0)], 0.0),
        ([(1.0, 3.0), (2.0, 2.0), (3.0, 1.0)], -3.0),
    ],
)
def test_r2_of_constant_and_bad_predictions(spark, pairs, expected):
    df = spark.createDataFrame([(D(2013, 1, 1), y, p) for y, p in pairs], "snapshot_date date, y double, p double")
    named = df.select("snapshot_date", F.col("y").alias(schemas.LABEL), F.col("p").alias(schemas.PREDICTION))
    assert scoring.metrics_by(named, "snapshot_date").first()["r2"] == pytest.approx(expected)


def test_metrics_of_months_add_up(spark):
    rows = [(D(2013, 1 + i % 3, 1), float(i * i % 17), float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, f"snapshot_date date, {schemas.LABEL} double, {schemas.PREDICTION} double")
    whole = scoring.metrics_by(df.withColumn("g", F.lit(1)), "g").first()
    parts = scoring.combined_metrics(scoring.month_statistics(df).withColumn("g", F.lit(1)), "g").first()
    for m in ("rmse", "mae", "r2"):
        assert parts[m] == pytest.approx(whole[m], rel=1e-12)


def test_split_needs_all_24_months(spark):
    months = spark.createDataFrame([(D(2013 + i // 12, 1 + i % 12, 1),) for i in range(25)], "snapshot_date date")
    split = dataset.rolling_split(months, "2015-01-01")
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sizes == {"train": 18, "val": 2, "test": 2, "oot": 2}
    assert dataset.rolling_split(months, "2014-11-01").count() == 0


def test_missing_month_blocks_training(spark):
    have = [D(2013 + i // 12, 1 + i % 12, 1) for i in range(30)]
    full = spark.createDataFrame([(m,) for m in have], "snapshot_date date")
    holed = full.where(F.col("snapshot_date") != F.lit("2014-03-01").cast("date"))
    runs = spark.createDataFrame([(D(2015, 1, 1),)], "run_month date")
    assert dataset.trainable_months(runs, full, full).count() == 1
    assert dataset.trainable_months(runs, holed, full).count() == 0
    assert [tuple(r) for r in dataset.missing_months(runs, holed, full).collect()] == [
        ("feature", D(2014, 3, 1), D(2015, 1, 1))
    ]


def test_hash_split_ignores_partitioning(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    one = {tuple(r) for r in dataset.hash_split(df.repartition(1), ["k"], 0.8, 88).collect()}
    many = {tuple(r) for r in dataset.hash_split(df.repartition(7), ["k"], 0.8, 88).collect()}
    assert one == many
    assert 0.75 < sum(s == "train" for _, s in one) / 2000 < 0.85
