"""Sinks, scans and the monthly jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import dataset, lifecycle
from shelfcast.plans import jobs, monthly
from shelfcast.session import shared_folder, written
from shelfcast.sources import files, retail, schemas


def months(spark, *values):
    return spark.createDataFrame([(dt.date.fromisoformat(m), v) for m, v in values], "snapshot_date date, v int")


def test_writing_a_month_again_replaces_only_that_month(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_months(months(spark, ("2015-01-01", 1), ("2015-02-01", 2)), path)
    for _ in range(2):
        files.write_months(months(spark, ("2015-02-01", 5)), path)
    assert sorted(tuple(r)[::-1] for r in files.read_table(spark, path).select("v", "snapshot_date").collect()) == [
        (dt.date(2015, 1, 1), 1),
        (dt.date(2015, 2, 1), 5),
    ]
    plan = files.read_month(spark, path, "2015-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_broken_documents_are_left_out(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "a.json").write_text('{"model_version": "2015-02-01",\n "metrics": {"oot": {"r2": 0.5}}}')
    (folder / "b.json").write_text('{"model_version": ')
    found = files.read_json(spark, str(folder), schemas.MODEL_METADATA_SCHEMA, multi_line=True)
    assert [(r["model_version"], r["metrics"]["oot"]["r2"]) for r in found.collect()] == [("2015-02-01", 0.5)]
    assert found.count() == 1 and not found.isEmpty()


def test_pairs_share_a_fixed_number_of_folders(spark, tmp_path):
    pairs = spark.range(400).select(
        (F.col("id") % 100).cast("string").alias("store_nbr"), F.lit("A").alias("family_key"), "id"
    )
    path = tmp_path / "pairs"
    files.write_by_pair(pairs, str(path), ["store_nbr", "family_key"], folders=8)
    assert len([p for p in path.iterdir() if p.is_dir()]) == 8
    assert sorted(r["id"] for r in files.read_table(spark, str(path)).select("id").collect()) == list(range(400))
    one = files.read_pair(spark, str(path), {"store_nbr": "7", "family_key": "A"}, folders=8)
    assert sorted(r["id"] for r in one.collect()) == [7, 107, 207, 307]


def test_event_log_keeps_what_it_has(spark, tmp_path):
    for i in range(2):
        files.append_events(spark.range(1).select(F.lit(i).alias("i")), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_files_by_pattern(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(3).write.parquet(str(tmp_path / "all" / name))
    (tmp_path / "all" / "notes.txt").write_text("no table")
    assert files.read_files(spark, str(tmp_path / "all"), "part-*.parquet").count() == 6


def test_written_tables_go_to_the_configured_folder(spark):
    df = written(spark.range(3), "three")
    assert df.inputFiles()[0].removeprefix("file://").startswith(shared_folder(spark))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_single_pass_alignment_equals_the_join(spark, sf_dir):
    data = monthly.clean_inputs(spark, sf_dir)
    features = monthly.feature_store(data)
    joined = dataset.align(features, monthly.label_store(data))
    single = dataset.next_month_label(features, monthly.ready_months(data.sales)).select(joined.columns)
    assert joined.count() == single.count() > 0
    assert joined.exceptAll(single).isEmpty()


def test_one_month_equals_that_month_of_the_full_plan(spark, sf_dir):
    data = monthly.clean_inputs(spark, sf_dir)
    full = monthly.feature_store(data).where("snapshot_date = '1998-03-01'")
    one = monthly.feature_store(data, "1998-03-01")
    assert one.count() == full.count() > 0
    assert one.exceptAll(full).isEmpty()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in (
        one._jdf.queryExecution().executedPlan().toString()
    )


DEPLOYMENT = "1997-05-01"


@pytest.fixture(scope="module")
def mart(spark, sf_dir, tmp_path_factory):
    """Raw CSV files, history stored up to 1997-02, then the monthly jobs for three months."""
    root = str(tmp_path_factory.mktemp("mart"))
    raw = {
        "train.csv": retail.daily_sales,
        "transactions.csv": retail.daily_transactions,
        "oil.csv": retail.oil_prices,
        "holidays_events.csv": retail.holidays_events,
    }
    for name, view in raw.items():
        files.write_csv(view(spark, sf_dir), f"{root}/raw/{name}")
    at = jobs.Layout(f"{root}/raw", f"{root}/mart")
    jobs.reference_tables(spark, at)
    data = monthly.clean_inputs(spark, sf_dir)
    before = F.col("snapshot_date") < F.lit("1997-03-01").cast("date")
    for table, df in (("daily_sales", data.sales), ("daily_transactions", data.transactions), ("oil_prices", data.oil)):
        files.write_months(df.where(before), at.silver(table))
    files.write_months(monthly.feature_store(data).where(before), at.gold("feature_store"))
    files.write_months(monthly.label_store(data).where(before), at.gold("label_store"))
    done = {
        m: jobs.run_month(spark, at, m, DEPLOYMENT, rule="persistent", trees=2)
        for m in ("1997-03-01", "1997-04-01", "1997-05-01", "1997-06-01")
    }
    return at, done


def test_jobs_start_when_their_inputs_are_there(mart):
    _, done = mart
    assert all(d["gold"] and d["train"] and d["registry"] for d in done.values())
    assert [d["promote"] for d in done.values()][:3] == [False, False, True]
    assert [d["score"] for d in done.values()] == [False, False, True, True]
    assert [d["monitor"] for d in done.values()] == [False, False, False, True]


def test_jobs_without_history_do_nothing(spark, tmp_path):
    at = jobs.Layout(str(tmp_path / "raw"), str(tmp_path / "mart"))
    assert not jobs.gold(spark, at, "1997-03-01")
    assert not jobs.train(spark, at, "1997-03-01")
    assert not jobs.promote(spark, at, "1997-05-01", DEPLOYMENT)
    assert not jobs.score(spark, at, "1997-05-01", DEPLOYMENT)
    assert not jobs.registry(spark, at, "1997-05-01")


def test_stored_features_equal_the_full_plan(spark, sf_dir, mart):
    at, _ = mart
    keys = ["snapshot_date", "store_nbr", "family"]
    exact = [c for c in schemas.NUMERIC_FEATURES if "dcoilwtico" not in c]  # prices went through text
    pick = [*keys, *[F.col(f"`{c}`") for c in exact]]
    range_ = F.col("snapshot_date").between(F.lit("1997-03-01").cast("date"), F.lit("1997-06-01").cast("date"))
    full = monthly.feature_store(monthly.clean_inputs(spark, sf_dir)).where(range_).select(pick)
    stored = spark.read.parquet(at.gold("feature_store")).where(range_).select(pick)
    assert stored.count() == full.count() > 0
    assert stored.exceptAll(full).isEmpty()


def test_report_and_registry(spark, mart):
    at, _ = mart
    report = jobs.monitoring_reports(spark, at).collect()
    assert [r["snapshot_date"] for r in report] == [dt.date(1997, 6, 1)]
    live = jobs.deployed_version(spark, at, "1997-06-01")
    assert report[0]["reference_snapshot_for_drift"] == dt.date.fromisoformat(live)
    assert len(report[0]["psi_csi_summary"]) == len(schemas.DRIFT_VARIABLES)
    assert report[0]["missing_in_current"] == []
    flat = spark.read.json(at.models("registry_json"))
    assert sorted(r["model_version"] for r in flat.collect()) == [
        "1997-02-01", "1997-03-01", "1997-04-01", "1997-05-01"
    ]
    assert flat.where("is_deployed").count() == 1
    assert spark.read.csv(f"{at.gold('predictions_csv')}/1997-06-01", header=True).count() > 0


def test_monitoring_again_gives_one_report(spark, mart):
    at, _ = mart
    assert jobs.monitor(spark, at, "1997-06-01", DEPLOYMENT, "persistent", baseline="scored_by")
    assert jobs.monitoring_reports(spark, at).count() == 1
    assert jobs.monitoring_reports(spark, at, "1997-05-01") is None


def test_start_date_tables(spark, sf_dir, mart):
    at, _ = mart
    assert spark.read.parquet(at.reference("store_start_dates")).columns == ["store_nbr", "first_active_month"]
    assert spark.read.parquet(at.reference("family_start_dates")).count() == 6
    sales = retail.daily_sales(spark, sf_dir)
    pairs = spark.read.parquet(at.reference("store_family_start_dates"))
    assert pairs.count() == sales.select("store_nbr", "family").distinct().count()


def test_bronze_of_many_months_is_one_scan_and_keeps_bad_text_out(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    days = ["1997-01-31", "1997-02-01", "1997-03-31", "1997-04-01", "not-a-date", ""]
    sales = [f"{k},{day},1,A,2.5,0" for k, day in enumerate(days)]
    (raw / "train.csv").write_text("\n".join(["id,date,store_nbr,family,sales,onpromotion", *sales]) + "\n")
    (raw / "transactions.csv").write_text("date,store_nbr,transactions\n1997-02-03,1,7\n")
    (raw / "oil.csv").write_text("date,dcoilwtico\n1997-03-03,50.5\n")
    at = jobs.Layout(str(raw), str(tmp_path / "mart"))
    jobs.bronze(spark, at, "1997-02-01", last="1997-03-01")
    rows = spark.read.parquet(at.bronze("daily_sales")).orderBy("id").collect()
    assert [(r["id"], r["snapshot_date"]) for r in rows] == [("1", dt.date(1997, 2, 1)), ("2", dt.date(1997, 3, 1))]


def test_thresholds_can_be_given(spark):
    scores = spark.createDataFrame([(dt.date(1997, 2, 1), 1.1, 1.1, 0.8)], "snapshot_date date, rmse double, mae double, r2 double")
    base = spark.createDataFrame([(1.0, 1.0, 0.82)], "rmse double, mae double, r2 double")
    usual = lifecycle.with_breaches(scores, base).first()
    strict = lifecycle.with_breaches(scores, base, r2_drop=0.01, rmse_ratio=1.05, mae_ratio=1.05).first()
    assert not (usual["r2_breach"] or usual["rmse_breach"] or usual["mae_breach"])
    assert strict["r2_breach"] and strict["rmse_breach"] and strict["mae_breach"]
