"""Decisions replayed over the recorded metrics in FIXTURES.md."""

import datetime as dt
import os
import re

import pytest

from shelfcast.operators import lifecycle

TEXT = open(os.path.join(os.path.dirname(__file__), "..", "FIXTURES.md")).read()


def table(section):
    """Rows of the first table after a heading, as lists of cell texts."""
    body = TEXT.split(f"### {section} ")[1]
    rows = re.findall(r"^\| (\d{4}-\d\d-\d\d) \|(.*)\|$", body.split("\n### ")[0], re.M)
    return [[first, *[c.strip() for c in rest.split("|")]] for first, rest in rows]


day = dt.date.fromisoformat


@pytest.fixture(scope="module")
def candidates(spark):
    rows = [(day(r[0]), float(r[1]), float(r[2]), float(r[3])) for r in table("4.1")]
    assert len(rows) == 29
    return spark.createDataFrame(rows, "model_version date, rmse double, mae double, r2 double")


@pytest.mark.parametrize("section, rule", [("4.2", "any"), ("4.3", "persistent")])
def test_replay(spark, candidates, section, rule):
    recorded = table(section)
    assert len(recorded) == 25
    rows = [(day("2015-06-01"), None, None, None)]
    rows += [(day(r[0]), float(r[2]), float(r[3]), float(r[4])) for r in recorded]
    scores = spark.createDataFrame(rows, "snapshot_date date, rmse double, mae double, r2 double")
    got = {
        r["snapshot_date"].isoformat(): r
        for r in lifecycle.deployment_timeline(scores, candidates, "2015-06-01", rule).collect()
    }
    first = got["2015-06-01"]
    assert (first["deployed_version"], first["triggered_by"]) == (day("2015-04-01"), None)
    months = sorted(got)
    for month, ref, *_, r2_b, rmse_b, mae_b, flag, promoted in recorded:
        row = got[month]
        assert row["deployed_version"] == day(ref), month
        assert [row["r2_breach"], row["rmse_breach"], row["mae_breach"], row["breach_flag"]] == [
            x == "T" for x in (r2_b, rmse_b, mae_b, flag)
        ], month
        if month != months[-1]:
            after = got[months[months.index(month) + 1]]
            assert after["promoted"] == (promoted != "—"), month
            if promoted != "—":
                assert (after["deployed_version"], after["triggered_by"]) == (day(promoted), day(month))
    timeline = lifecycle.deployment_timeline(scores, candidates, "2015-06-01", rule)
    events = lifecycle.promotion_events(timeline, candidates)
    assert events.count() == sum(r[-1] != "—" for r in recorded)


def breaches(spark, rows):
    return spark.createDataFrame(rows, "snapshot_date date, r2_breach boolean, rmse_breach boolean, mae_breach boolean")


def test_persistent_rule_needs_the_same_metric_in_the_month_before(spark):
    df = breaches(
        spark,
        [
            (day("2015-07-01"), False, True, False),
            (day("2015-08-01"), False, False, True),
            (day("2015-09-01"), False, False, True),
            (day("2015-11-01"), False, False, True),
            (day("2015-12-01"), True, None, None),
        ],
    )
    flags = [r["breach_flag"] for r in lifecycle.with_breach_flag(df, "persistent").orderBy("snapshot_date").collect()]
    assert flags == [False, False, True, False, True]
    assert all(r["breach_flag"] for r in lifecycle.with_breach_flag(df, "any").collect())


def test_no_baseline_means_no_breach(spark):
    scores = spark.createDataFrame([(day("2015-07-01"), 1.0, 1.0, 0.5)], "snapshot_date date, rmse double, mae double, r2 double")
    none = spark.createDataFrame([], "rmse double, mae double, r2 double")
    row = lifecycle.with_breach_flag(lifecycle.with_breaches(scores, none)).first()
    assert (row["r2_breach"], row["breach_flag"]) == (None, False)


def test_best_candidate_prefers_the_earliest_of_equals(spark):
    df = spark.createDataFrame([("2015-03-01", 0.9), ("2015-02-01", 0.9), ("2015-01-01", None)], "model_version string, oot_r2 double")
    assert tuple(lifecycle.best_candidate(df).first()) == ("2015-02-01", 0.9)
