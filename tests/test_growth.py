"""Steps whose cost must grow with the input alone."""

from datetime import date

from pyspark.sql import functions as F

from shelfcast.operators import clean, drift, lifecycle, rollup, sliding, trailing, weekly
from shelfcast.plans import candidates, incremental, jobs, monthly
from shelfcast.plans.registry import rounded, rounded_by_month
from shelfcast.sources import retail, schemas


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_weekly_rollup_shuffles_once_and_counts_days_as_bits(spark):
    days = [date(2024, 1, 1), date(2024, 1, 1), date(2024, 1, 7), date(2024, 1, 8), None]
    rows = [("1", "A", day, float(i)) for i, day in enumerate(days)]
    sales = spark.createDataFrame(rows, "store_nbr string, family string, date date, sales float")
    holidays = spark.createDataFrame([(date(2024, 1, 7),)], "date date")
    found = weekly.weekly_rollup(sales, holidays)
    assert shuffles(found) == 1
    assert {tuple(r)[2:] for r in found.collect()} == {
        (date(2024, 1, 1), 3.0, 1.0, 2, 1),
        (date(2024, 1, 8), 3.0, 3.0, 1, 0),
        (None, 4.0, 4.0, 0, 0),
    }


def test_category_shares_read_the_current_values_once(spark, tmp_path):
    rows = [("v", date(2024, m, 1), float(x)) for m, x in ((1, 0), (1, 1), (1, 1), (2, 1), (2, 2))]
    values = spark.createDataFrame(rows, "variable string, snapshot_date date, value double")
    values.write.parquet(str(tmp_path / "values"))
    stored = spark.read.parquet(str(tmp_path / "values"))
    found = drift.category_shares(drift.month_of(stored, "2024-01-01"), stored)
    got = {(str(r["snapshot_date"]), r["value"]): (r["ref_share"], r["cur_share"]) for r in found.collect()}
    assert got == {
        ("2024-01-01", 0.0): (1 / 3, 1 / 3),
        ("2024-01-01", 1.0): (2 / 3, 2 / 3),
        ("2024-02-01", 0.0): (1 / 3, 0.0),
        ("2024-02-01", 1.0): (2 / 3, 0.5),
        ("2024-02-01", 2.0): (0.0, 0.5),
    }
    assert not [f for f in found.inputFiles() if str(tmp_path) in f]


def test_month_sums_keep_one_running_sum_per_product(spark):
    rows = [(date(2024, m, 1), 100.0 + x * x, float(x), 7.0) for m in (1, 2) for x in range(5)]
    panel = spark.createDataFrame(rows, "snapshot_date date, label double, a double, b double")
    found = sliding.month_sums(panel, ["a", "b"], "label")
    assert "covar" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = found.orderBy("snapshot_date").collect()
    assert [(r["n_rows"], r["mean"], r["sq_dev"]) for r in got] == [(5, 106.0, 174.0)] * 2
    assert [(r["m0"], r["c0_0"], r["c0_1"], r["c1_1"], r["b0"], r["vy"]) for r in got] == [
        (10.0, 30.0, 70.0, 245.0, 1100.0, 56354.0)
    ] * 2


def test_rows_meet_only_the_versions_that_score_them(spark):
    months = [date(2024, m, 1) for m in range(1, 7)]
    rows = spark.createDataFrame([(m, 1.0, 2.0) for m in months], "snapshot_date date, x double, label double")
    ends = spark.createDataFrame([(m, 0.0, 1.0) for m in months], "training_window_end date, intercept double, coef_x double")
    known = sliding.scored(rows, ends, ["x"], F.col("training_window_end") == F.col("snapshot_date"))
    assert "sequence" not in known._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["snapshot_date"], r["training_window_end"]) for r in known.collect()) == [(m, m) for m in months]


def test_only_versions_that_promotion_can_take_are_scored_live(spark):
    r2 = [None, 0.5, 0.4, 0.5, float("nan"), 0.9]
    offers = spark.createDataFrame(
        [(date(2024, i + 1, 1), 1.0, 1.0, x) for i, x in enumerate(r2)], "model_version date, rmse double, mae double, r2 double"
    )
    assert [r[0].month for r in lifecycle.ever_best(offers).orderBy("model_version").collect()] == [2, 5]
    runs = spark.createDataFrame([(date(2024, m, 1),) for m in range(1, 13)], "snapshot_date date")
    taken = {r["best"]["version"].month for r in lifecycle.best_so_far(runs, offers).collect() if r["best"]}
    assert taken == {2, 5}


def test_live_scores_leave_out_versions_that_are_never_best(spark, sf_dir):
    found = candidates.fitted(spark, sf_dir)
    offers = found.scores.where("split = 'oot'").withColumnRenamed("training_window_end", "model_version")
    best = {r[0] for r in lifecycle.ever_best(offers).collect()}
    first = found.versions.agg(F.min("training_window_end")).first()[0]
    live = {r[0] for r in found.live_scores.select("model_version").distinct().collect()}
    assert live <= best | {first} and len(live) < found.versions.count()


def test_versions_are_listed_without_the_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(candidates, "_stored", {})
    found = candidates.fitted(spark, sf_dir)
    assert found.versions.count() > 0 and "rows" not in vars(found)


def test_monthly_transactions_equal_the_daily_roll_up(spark, tmp_path):
    rows = [(1, 1, date(2024, 1, 1)), (1, 1, date(2024, 1, 1)), (1, 1, date(2024, 1, 2)), (2, 1, date(2024, 1, 1))]
    rows += [(3, 2, date(2024, 2, 1)), (None, 2, date(2024, 3, 1)), (4, None, date(2024, 3, 1)), (5, 2, None)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_shipdate date")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = retail.monthly_transactions(spark, str(tmp_path))
    daily = clean.silver(
        retail.daily_transactions(spark, str(tmp_path)), schemas.TRANSACTION_TYPES, schemas.TRANSACTION_KEYS
    )
    wanted = rollup.monthly_transactions(daily)
    assert found.dtypes == wanted.dtypes
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in wanted.collect()}
    assert shuffles(found) < shuffles(wanted)


def test_orders_by_day_add_up_to_the_daily_transactions(spark, tmp_path):
    rows = [(1, 1, date(2024, 1, 1)), (1, 1, date(2024, 1, 1)), (1, 1, date(2024, 1, 2)), (2, 1, date(2024, 1, 1))]
    rows += [(None, 2, date(2024, 3, 1)), (4, None, date(2024, 3, 1)), (5, 2, None)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_shipdate date")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))

    def sums(source):
        tidy = clean.silver(source(spark, str(tmp_path)), schemas.TRANSACTION_TYPES, schemas.TRANSACTION_KEYS)
        return incremental.sums(tidy, "daily_transactions").drop("n")

    found, wanted = sums(retail.daily_orders), sums(retail.daily_transactions)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in wanted.collect()}
    assert shuffles(found) < shuffles(wanted)


def test_landing_keeps_its_sums_once(spark, tmp_path):
    at = jobs.Layout(raw="", root=str(tmp_path / "mart"))
    rows = spark.createDataFrame(
        [(date(2024, 1, 1), "1", 2), (date(2024, 2, 1), "1", 3), (None, "1", 9)],
        "snapshot_date date, store_nbr string, transactions int",
    )
    assert incremental.land(at, "daily_transactions", rows.limit(0), "0").isEmpty()
    for _ in range(2):
        months = incremental.land(at, "daily_transactions", rows, "1")
        assert all(at.state("daily_transactions") in f for f in months.inputFiles())
        assert sorted(r[0] for r in months.collect()) == [date(2024, 1, 1), date(2024, 2, 1)]
    assert [r[0] for r in incremental.land(at, "daily_transactions", rows.where("transactions = 3"), "2").collect()] == [
        date(2024, 2, 1)
    ]
    assert sorted(r["transactions"] for r in incremental.rolled_up(spark, at, "daily_transactions").collect()) == [2, 6]


def test_pair_columns_stay_by_store(spark):
    pairs = [(date(2024, m, 1), s, f, 1.0 * m, 1.0, 1.0) for m in (1, 2, 4) for s in ("1", "2", None) for f in ("A", "B")]
    pairs.append((None, "1", "A", 1.0, 1.0, 1.0))
    kinds = "snapshot_date date, store_nbr string, family string, sales double, onpromotion_sum double, onpromotion_avg double"
    sales = spark.createDataFrame(pairs, kinds).repartition("store_nbr")
    counts = [(date(2024, m, 1), s, m * 10) for m in (1, 2, 3) for s in ("1", "3", None)] + [(None, "1", 5)]
    transactions = spark.createDataFrame(counts, "snapshot_date date, store_nbr string, transactions long")
    found = trailing.with_transactions(trailing.sales_features(sales), transactions)
    wanted = trailing.sales_features(sales).join(
        trailing.transaction_features(transactions), ["snapshot_date", "store_nbr"], "left"
    )
    assert shuffles(found) == 2 < shuffles(wanted)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.select(found.columns).collect()))


def test_month_columns_come_after_the_shuffle_to_files(spark, tmp_path, monkeypatch):
    seen = []
    whole = monthly.files.by_month
    monkeypatch.setattr(monthly.files, "by_month", lambda df: seen.append(df.columns) or whole(df))
    month = spark.createDataFrame([(date(2024, m, 1),) for m in (1, 2, 3)], "snapshot_date date")
    shared = [c for c in schemas.NUMERIC_FEATURES if "holiday" in c or c.startswith("num_")]
    tables = monthly.MonthTables(
        sales=month.selectExpr("*", "'1' store_nbr", "'A' family", "1d sales", "1d onpromotion_sum", "1d onpromotion_avg"),
        transactions=month.selectExpr("*", "'1' store_nbr", "7L transactions"),
        oil=month.selectExpr("*", "2d avg_dcoilwtico"),
        holiday_features=month.selectExpr("*", *[f"1L `{c}`" for c in shared]),
        ready=month,
    )
    features, labels = monthly.write_stores(tables, str(tmp_path / "features"), str(tmp_path / "labels"))
    assert not set(seen[0]) & {*shared, "AVG_dcoilwtico_LM"}
    assert [(r["snapshot_date"], r["sales_LM"], r["SUM_transactions_L3M"]) for r in features.collect()] == [
        (date(2024, 3, 1), 1.0, 21)
    ]
    assert [r["snapshot_date"] for r in labels.collect()] == [date(2024, 3, 1)]


def test_month_columns_are_rounded_once_a_month(spark, tmp_path):
    rows = [(date(2024, m, 1), k, None if m == 2 else m / 7) for m in (1, 2, 3) for k in range(4)]
    spark.createDataFrame(rows, "snapshot_date date, k int, price double").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = rounded_by_month(stored, 3, "price")
    assert found.columns == stored.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, rounded(stored, 3, "price").collect()))
