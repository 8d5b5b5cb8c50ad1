"""Registered queries: joins, aggregations, windows, order and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.calendar import join_calendar
from shelfcast.operators import (
    clean,
    dataset,
    drift,
    holidays,
    lifecycle,
    modelling,
    panel,
    profile,
    rollup,
    scoring,
    trailing,
    weekly,
)
from shelfcast.plans import incremental, jobs, monthly
from shelfcast.plans.candidates import fitted
from shelfcast.plans.gold import gold
from shelfcast.plans.queries_tables import FEATURE_SQL, OIL_FEATURES, five_tables
from shelfcast.plans.registry import ANCHOR, REFERENCE, query, rounded, rounded_by_month
from shelfcast.session import new_table_path, written
from shelfcast.sources import files, retail, schemas

# -- joins -------------------------------------------------------------------


@query(
    "j1_sales_with_transactions",
    """select s.snapshot_date, s.store_nbr, s.family, s.sales, t.transactions
       from sales_m s left join txn_m t on s.snapshot_date = t.snapshot_date and s.store_nbr = t.store_nbr""",
)
def _(spark, d):
    sales = rollup.monthly_sales(retail.daily_sales(spark, d)).select("snapshot_date", *rollup.PAIR, "sales")
    return sales.join(
        rollup.monthly_transactions(retail.daily_transactions(spark, d)), ["snapshot_date", "store_nbr"], "left"
    )


@query(
    "j2_sales_with_oil",
    """select s.snapshot_date, s.store_nbr, s.family, s.sales, round(o.avg_dcoilwtico, 6) as avg_dcoilwtico
       from sales_m s left join oil_m o on s.snapshot_date = o.snapshot_date""",
)
def _(spark, d):
    data = monthly.clean_inputs(spark, d)
    sales = rollup.monthly_sales(data.sales).select("snapshot_date", *rollup.PAIR, "sales")
    return rounded(join_calendar(sales, rollup.monthly_oil(data.oil)), 6, "avg_dcoilwtico")


@query(
    "j3_sales_with_holidays",
    "select s.store_nbr, s.family, s.sales, h.*  replace (s.snapshot_date as snapshot_date) from sales_m s left join hol h on s.snapshot_date = h.snapshot_date",
)
def _(spark, d):
    data = monthly.clean_inputs(spark, d)
    sales = rollup.monthly_sales(data.sales).select("snapshot_date", *rollup.PAIR, "sales")
    return join_calendar(sales, data.holiday_features)


@query("j4_next_month_holidays", "select * from hol")
def _(spark, d):
    return holidays.with_next_month(holidays.monthly_holidays(retail.holidays_events(spark, d)))


@query(
    "j5_imputation_join",
    """select o.date, o.dcoilwtico as price, round(m.mean_price, 6) as mean_price
       from oil_prices o left join (select date_trunc('month', date) as month, avg(dcoilwtico) as mean_price
                                    from oil_prices group by 1) m on date_trunc('month', o.date) = m.month""",
)
def _(spark, d):
    oil = clean.add_month_columns(retail.oil_prices(spark, d))
    means = oil.groupBy("snapshot_date").agg(F.avg("dcoilwtico").alias("mean_price"))
    joined = join_calendar(oil, means).select("date", F.col("dcoilwtico").alias("price"), "mean_price")
    return rounded(joined, 6, "mean_price")


@query(
    "j6_holiday_flag",
    """select s.store_nbr, s.family, s.date, s.sales, (n.date is not null)::int as is_holiday
       from daily_pairs s left join national n on s.date = n.date""",
)
def _(spark, d):
    daily = rollup.daily_pairs(retail.daily_sales(spark, d)).select(*rollup.PAIR, "date", "sales")
    return holidays.flag_holidays(daily, holidays.holiday_dates(retail.holidays_events(spark, d)))


ALIGNED_SQL = f"""select {FEATURE_SQL}, label_next_month_sales from aligned"""


@query("j7_features_with_next_label", ALIGNED_SQL)
def _(spark, d):
    g = gold(spark, d)
    return rounded(dataset.align(g.features, g.labels), 6, *OIL_FEATURES)


@query("j7_single_pass_alignment", ALIGNED_SQL)
def _(spark, d):
    """The same rows without joining two panels: the label is taken from next month of the panel."""
    data = monthly.clean_inputs(spark, d)
    ready = monthly.ready_months(data.sales)
    aligned = dataset.next_month_label(monthly.feature_store(data), ready)
    return rounded(aligned, 6, *OIL_FEATURES)


@query("j8_features_with_filed_label", ALIGNED_SQL)
def _(spark, d):
    """Labels filed one month earlier, joined on the same month."""
    filed_early = monthly.label_store(monthly.clean_inputs(spark, d), label_at="S-1")
    aligned = dataset.align(gold(spark, d).features, filed_early, label_at="S-1")
    return rounded(aligned, 6, *OIL_FEATURES)


@query(
    "j9_labels_with_predictions",
    "select snapshot_date, store_nbr, family, y as label_next_month_sales, p as predicted_sales from scored",
)
def _(spark, d):
    return gold(spark, d).evaluation


@query(
    "j10_predictions_two_months",
    f"""select c.snapshot_date, c.store_nbr, c.family, r.predicted_sales as predicted_sales_ref,
               c.predicted_sales as predicted_sales_cur
        from pred r join pred c on r.store_nbr = c.store_nbr and r.family = c.family
        where r.snapshot_date = date '{REFERENCE}'""",
)
def _(spark, d):
    return drift.paired_predictions(gold(spark, d).predictions, REFERENCE)


@query(
    "j11_registry_with_deployed",
    f"""select strftime(training_window_end, '%Y-%m-%d') as model_version, training_window_end,
               training_window_end = date '{REFERENCE}' as is_deployed from versions""",
)
def _(spark, d):
    registered = lifecycle.registry(candidates(spark, d), REFERENCE)
    return registered.select("model_version", "training_window_end", "is_deployed")


@query(
    "j12_report_with_previous",
    """select a.snapshot_date, round(a.rmse, 4) as rmse, round(b.rmse, 4) as previous_rmse
       from scores a left join scores b on b.snapshot_date = a.snapshot_date - interval 1 month""",
)
def _(spark, d):
    scores = scoring.metrics_by(gold(spark, d).evaluation, "snapshot_date").select("snapshot_date", "rmse")
    before = scores.select(F.add_months("snapshot_date", 1).alias("snapshot_date"), F.col("rmse").alias("previous_rmse"))
    return rounded(join_calendar(scores, before), 4, "rmse", "previous_rmse")


def trainable_versions(spark, d):
    """Window ends of all run months with 24 months of features and labels."""
    return fitted(spark, d).versions


def candidate_scores(spark, d):
    """Metrics of the ridge model of every training window, keyed by window end and split."""
    return fitted(spark, d).scores


def candidates(spark, d):
    return lifecycle.model_metadata(candidate_scores(spark, d), schemas.RIDGE_FEATURES)


# -- aggregations ------------------------------------------------------------


@query("a1_monthly_sales", "select * from sales_m")
def _(spark, d):
    return rollup.monthly_sales(retail.daily_sales(spark, d))


@query("a2_monthly_transactions", "select * from txn_m")
def _(spark, d):
    return rollup.monthly_transactions(retail.daily_transactions(spark, d))


@query("a3_monthly_oil", "select snapshot_date, round(avg_dcoilwtico, 6) as avg_dcoilwtico from oil_m")
def _(spark, d):
    return rounded(rollup.monthly_oil(monthly.clean_inputs(spark, d).oil), 6, "avg_dcoilwtico")


@query("a4_holiday_counts", "select * from hol_m")
def _(spark, d):
    return holidays.monthly_holidays(retail.holidays_events(spark, d))


@query(
    "a5_first_active_month",
    """select 'store_family' as grain, store_nbr, family, first_active_month from starts
       union all select 'store', store_nbr, null, min(first_active_month) from starts group by 2
       union all select 'family', null, family, min(first_active_month) from starts group by 3""",
)
def _(spark, d):
    return rollup.first_active_all_grains(retail.daily_sales(spark, d))


@query(
    "a6_first_active_by_total",
    """select 'store' as grain, store_nbr as key, min(snapshot_date) as first_active_month
       from (select store_nbr, snapshot_date from sales_m group by 1, 2 having sum(sales) > 0) group by 2
       union all
       select 'family', family, min(snapshot_date)
       from (select family, snapshot_date from sales_m group by 1, 2 having sum(sales) > 0) group by 2""",
)
def _(spark, d):
    sales = retail.daily_sales(spark, d)

    def grain(name, key):
        starts = rollup.first_active_by_total(sales, [key])
        return starts.select(F.lit(name).alias("grain"), F.col(key).alias("key"), "first_active_month")

    return grain("store", "store_nbr").unionByName(grain("family", "family"))


@query(
    "a7_weekly_rollup",
    "select * replace (round(weekly_sales_avg, 4) as weekly_sales_avg) from weekly_r",
)
def _(spark, d):
    dates = holidays.holiday_dates(retail.holidays_events(spark, d))
    return rounded(weekly.weekly_rollup(retail.daily_sales(spark, d), dates), 4, "weekly_sales_avg")


@query("a8_weekly_sum", "select * from weekly")
def _(spark, d):
    return rollup.weekly_sales(retail.daily_sales(spark, d))


@query(
    "a9_row_counts",
    """select 'daily_sales' as table_name, count(*) as n_rows from daily_sales
       union all select 'monthly_sales', count(*) from sales_m
       union all select 'feature_store', count(*) from feat
       union all select 'label_store', count(*) from lab""",
)
def _(spark, d):
    g = gold(spark, d)
    sales = retail.daily_sales(spark, d)
    return profile.row_counts(
        {
            "daily_sales": sales,
            "monthly_sales": rollup.monthly_sales(sales),
            "feature_store": g.features,
            "label_store": g.labels,
        }
    )


@query(
    "a10_date_ranges",
    """select 'daily_sales' as table_name, min(date) as min_date, max(date) as max_date from daily_sales
       union all select 'daily_transactions', min(date), max(date) from daily_transactions
       union all select 'oil_prices', min(date), max(date) from oil_prices
       union all select 'holidays_events', min(date), max(date) from holidays_events""",
)
def _(spark, d):
    return profile.date_ranges(five_tables(spark, d))


@query(
    "a11_distinct_counts",
    """select store_nbr, count(distinct date) as n_days from daily_transactions group by 1
       union all select null, count(distinct store_nbr) from daily_sales""",
)
def _(spark, d):
    per_store = profile.distinct_per_group(retail.daily_transactions(spark, d), ["store_nbr"], "date", "n_days")
    overall = profile.distinct_counts(retail.daily_sales(spark, d), ["store_nbr"])
    return per_store.unionByName(
        overall.select(F.lit(None).cast("string").alias("store_nbr"), F.col("n_store_nbr").alias("n_days"))
    )


@query("a12_value_counts", "select family as value, count(*) as n from daily_sales group by 1")
def _(spark, d):
    return profile.value_counts(retail.daily_sales(spark, d), "family")


def _describe_sql(column: str, table: str) -> str:
    return f"""select '{column}' as variable, count({column}) as count, round(avg({column}::double), 4) as mean,
        round(stddev_samp({column}::double), 4) as std, min({column})::double as min, max({column})::double as max,
        round(quantile_cont({column}::double, 0.25), 4) as p25, round(quantile_cont({column}::double, 0.5), 4) as p50,
        round(quantile_cont({column}::double, 0.75), 4) as p75 from {table}"""


@query(
    "a13_describe_numbers",
    _describe_sql("sales", "daily_sales") + " union all " + _describe_sql("onpromotion", "daily_sales"),
)
def _(spark, d):
    described = profile.describe_numbers(retail.daily_sales(spark, d), ["sales", "onpromotion"])
    return rounded(described, 4, "mean", "std", "p25", "p50", "p75")


@query(
    "a13_describe_price",
    _describe_sql("dcoilwtico", "oil_prices") + " union all " + _describe_sql("transactions", "daily_transactions"),
)
def _(spark, d):
    oil = profile.describe_numbers(retail.oil_prices(spark, d), ["dcoilwtico"])
    transactions = profile.describe_numbers(retail.daily_transactions(spark, d), ["transactions"])
    return rounded(oil.unionByName(transactions), 4, "mean", "std", "p25", "p50", "p75")


@query(
    "a13_describe_text",
    " union all ".join(
        f"""select '{c}' as variable, sum(n)::bigint as count, count(*) as "unique",
                   arg_min(v, (-n, v)) as top, max(n) as freq
            from (select {c} as v, count(*) as n from daily_sales where {c} is not null group by 1)"""
        for c in ("id", "store_nbr", "family")
    ),
)
def _(spark, d):
    return profile.describe_text(retail.daily_sales(spark, d), ["id", "store_nbr", "family"])


@query(
    "a14_panel_density",
    """select *, n_days * n_stores * n_families as full_panel_rows from (
           select count(distinct date) as n_days, count(distinct store_nbr) as n_stores,
                  count(distinct family) as n_families, count(*) as n_rows from daily_sales)""",
)
def _(spark, d):
    return profile.panel_density(retail.daily_sales(spark, d))


@query(
    "a15_values_per_month",
    """select date_trunc('month', date)::date as snapshot_date, count(dcoilwtico) as non_null_count
       from oil_prices group by 1""",
)
def _(spark, d):
    return profile.values_per_month(retail.oil_prices(spark, d), "dcoilwtico")


def late_starts_per_month(spark, d):
    starts = rollup.first_active(retail.daily_sales(spark, d), rollup.PAIR)
    return rollup.starts_per_month(rollup.late_starters(starts, "1995-01-01"))


@query("a16_new_pairs_per_month", "select * from starts_m")
def _(spark, d):
    return late_starts_per_month(spark, d)


@query(
    "a17_busy_store_months",
    """select store_nbr, date_trunc('month', date)::date as snapshot_date, count(distinct date) as n_unique_days
       from daily_transactions group by all having count(distinct date) > 1""",
)
def _(spark, d):
    return profile.busy_store_months(retail.daily_transactions(spark, d))


@query(
    "a18_null_summary",
    f"""select * from (
        select 'AVG_dcoilwtico_LM' as column_name, count(*) filter ("AVG_dcoilwtico_LM" is null) as n_nulls from feat
        union all {" union all ".join(
            f"select '{c}', count(*) filter (" + f'"{c}" is null) from feat'
            for c in schemas.NUMERIC_FEATURES if c != "AVG_dcoilwtico_LM"
        )}) where n_nulls > 0""",
)
def _(spark, d):
    return profile.null_summary(gold(spark, d).features)


@query(
    "a19_promotion_constancy",
    """select unique_promo_values = 1 as is_constant, count(*) as n from (
           select count(distinct onpromotion) as unique_promo_values from daily_sales
           group by store_nbr, family, date_trunc('month', date)) group by 1""",
)
def _(spark, d):
    return profile.promo_constancy(retail.daily_sales(spark, d))


@query(
    "a19_promotion_change_share",
    """select changing, total, changing / total as share from (
           select count(*) filter (n_means > 1) as changing, count(*) as total from (
               select store_nbr, family, count(distinct mean_promo) as n_means from (
                   select store_nbr, family, date_trunc('month', date) as m, avg(onpromotion) as mean_promo
                   from daily_sales group by all) group by all))""",
)
def _(spark, d):
    return profile.promo_change_share(retail.daily_sales(spark, d))


@query(
    "a20_monthly_metrics",
    """select snapshot_date, n_rows, round(rmse, 4) as rmse, round(mae, 4) as mae, round(r2, 6) as r2 from scores""",
)
def _(spark, d):
    scores = scoring.metrics_by(gold(spark, d).evaluation, "snapshot_date")
    return rounded(rounded(scores, 4, "rmse", "mae"), 6, "r2")


@query(
    "a20_split_metrics",
    """select training_window_end, split, round(rmse, 4) as rmse, round(mae, 4) as mae, round(r2, 6) as r2, rows,
              start, "end" from candidate_scores""",
)
def _(spark, d):
    return rounded(rounded(candidate_scores(spark, d), 4, "rmse", "mae"), 6, "r2")


@query("a21_distinct_pairs", "select distinct store_nbr, family from daily_sales")
def _(spark, d):
    return retail.daily_sales(spark, d).select("store_nbr", "family").distinct()


@query("a21_distinct_kinds", "select distinct type, locale from holidays_events")
def _(spark, d):
    return retail.holidays_events(spark, d).select("type", "locale").distinct()


# -- windows -----------------------------------------------------------------


@query("w1_sales_three_months", "select * from sales_f")
def _(spark, d):
    features = trailing.sales_features(rollup.monthly_sales(retail.daily_sales(spark, d)))
    return features.drop("sales", "onpromotion_sum", "onpromotion_avg")


@query("w2_transactions_three_months", "select * from txn_f")
def _(spark, d):
    return trailing.transaction_features(rollup.monthly_transactions(retail.daily_transactions(spark, d)))


@query(
    "w3_oil_three_months",
    """select snapshot_date, round("AVG_dcoilwtico_LM", 6) as "AVG_dcoilwtico_LM",
              round("AVG_dcoilwtico_L3M", 6) as "AVG_dcoilwtico_L3M",
              round("SUM_dcoilwtico_L3M", 6) as "SUM_dcoilwtico_L3M" from oil_f""",
)
def _(spark, d):
    features = trailing.oil_features(rollup.monthly_oil(monthly.clean_inputs(spark, d).oil))
    return rounded(features, 6, *OIL_FEATURES)


@query("w_feature_store", f"select {FEATURE_SQL} from feat")
def _(spark, d):
    return rounded(monthly.feature_store(monthly.clean_inputs(spark, d)), 6, *OIL_FEATURES)


def late_batches(df):
    """The days up to a month, and those after it together with late rows of earlier ones: every day divisible by 9."""
    late = F.coalesce((F.col("date") > F.lit(ANCHOR).cast("date")) | (F.dayofmonth("date") % 9 == 0), F.lit(False))
    return df.where(~late), df.where(late)


@query("w_incremental_store", f"select {FEATURE_SQL} from feat")
def _(spark, d):
    """Two batches of days land in the state; after each, only the months that it changes are written again."""
    data = monthly.clean_inputs(spark, d)
    orders = clean.silver(retail.daily_orders(spark, d), schemas.TRANSACTION_TYPES, schemas.TRANSACTION_KEYS)
    at = jobs.Layout(raw="", root=new_table_path(spark, "incremental"))
    oil = written(data.oil, "oil")
    holiday = written(data.holiday_features, "holiday_features")
    batches = zip(late_batches(data.sales), late_batches(orders))
    for number, (sales, transactions) in enumerate(batches):
        touched = [
            incremental.land(at, table, rows, str(number))
            for table, rows in (("daily_sales", sales), ("daily_transactions", transactions))
        ]
        incremental.refresh(spark, at, touched[0].union(touched[1]).distinct(), oil, holiday)
    schema = schemas.FEATURE_STORE_SCHEMA
    stored = files.read_table(spark, at.gold("feature_store"), schema)
    return rounded_by_month(stored.select([F.col(f"`{c}`") for c in schema.names]), 6, *OIL_FEATURES)


@query(
    "s1_landed_files",
    "select * from txn_m",
)
def _(spark, d):
    """Day files land through a file stream, in two goes; the second go reads only the files that are new."""
    root = new_table_path(spark, "landing")
    at = jobs.Layout(raw=f"{root}/raw", root=f"{root}/mart")
    for rows in late_batches(written(retail.daily_transactions(spark, d), "transactions")):
        rows.write.mode("append").option("header", True).csv(f"{at.raw}/daily_transactions")
        incremental.land_new_files(spark, at, "daily_transactions")
    return incremental.rolled_up(spark, at, "daily_transactions")


@query("w_label_store", "select * from lab")
def _(spark, d):
    return monthly.label_store(monthly.clean_inputs(spark, d))


@query(
    "w4_trailing_weeks",
    """select * replace (round(weekly_sales_avg, 4) as weekly_sales_avg, round(avg_sales_14d, 4) as avg_sales_14d,
              round(avg_sales_28d, 4) as avg_sales_28d, round(sum_sales_14d, 4) as sum_sales_14d,
              round(sum_sales_28d, 4) as sum_sales_28d) from weekly_t""",
)
def _(spark, d):
    dates = holidays.holiday_dates(retail.holidays_events(spark, d))
    weeks = weekly.trailing_weeks(weekly.weekly_rollup(retail.daily_sales(spark, d), dates))
    return rounded(
        weeks, 4, "weekly_sales_avg", "avg_sales_14d", "avg_sales_28d", "sum_sales_14d", "sum_sales_28d"
    )


def daily_panel(spark, d):
    return rollup.daily_pairs(retail.daily_sales(spark, d)).select(*rollup.PAIR, "date", "sales")


BY_DAY_SQL = "partition by store_nbr, family order by date"


@query(
    "w5_daily_lags",
    f"""select store_nbr, family, date, sales, lag(sales, 1) over w as sales_lag_1, lag(sales, 7) over w as sales_lag_7
        from daily_pairs window w as ({BY_DAY_SQL})""",
)
def _(spark, d):
    return panel.lags(daily_panel(spark, d))


@query(
    "w6_rolling_seven",
    f"""select store_nbr, family, date, sales,
               case when count(*) over w = 7 then round(avg(sales) over w, 4) end as rolling_mean_7,
               case when count(*) over w = 7 then round(stddev_samp(sales) over w, 4) end as rolling_std_7
        from daily_pairs window w as ({BY_DAY_SQL} rows between 7 preceding and 1 preceding)""",
)
def _(spark, d):
    return rounded(panel.rolling(daily_panel(spark, d)), 4, "rolling_mean_7", "rolling_std_7")


@query(
    "w7_future_targets",
    "select store_nbr, family, date, sales, "
    + ", ".join(f"lead(sales, {i}) over w as y_d{i}" for i in range(1, 8))
    + f" from daily_pairs window w as ({BY_DAY_SQL})",
)
def _(spark, d):
    return panel.future_targets(daily_panel(spark, d))


@query(
    "c10_complete_rows",
    "select * from (select store_nbr, family, date, sales, (isodow(date) - 1)::int as day_of_week, "
    "month(date)::int as month, lag(sales, 1) over w as sales_lag_1, lag(sales, 7) over w as sales_lag_7, "
    + ", ".join(f"lead(sales, {i}) over w as y_d{i}" for i in range(1, 8))
    + f""", case when count(*) over p = 7 then round(avg(sales) over p, 4) end as rolling_mean_7,
            case when count(*) over p = 7 then round(stddev_samp(sales) over p, 4) end as rolling_std_7
        from daily_pairs window w as ({BY_DAY_SQL}),
             p as ({BY_DAY_SQL} rows between 7 preceding and 1 preceding)
      ) where sales_lag_7 is not null and y_d7 is not null and rolling_std_7 is not null""",
)
def _(spark, d):
    complete = clean.complete_rows(panel.daily_features(daily_panel(spark, d)))
    return rounded(complete, 4, "rolling_mean_7", "rolling_std_7")


@query("w8_weekly_lags", "select * replace (round(sales_avg_4, 4) as sales_avg_4) from weekly_l")
def _(spark, d):
    return rounded(weekly.lag_features(rollup.weekly_sales(retail.daily_sales(spark, d))), 4, "sales_avg_4")


@query(
    "w9_latest_weeks",
    """select store_nbr, family, week_start, sales_week, age from (
           select *, row_number() over (partition by store_nbr, family order by week_start desc)::int as age
           from weekly) where age <= 4""",
)
def _(spark, d):
    return weekly.latest_weeks(rollup.weekly_sales(retail.daily_sales(spark, d)))


@query(
    "w10_cumulative_pairs",
    """select first_active_month, num_new_pairs,
              (select sum(b.num_new_pairs) from starts_m b where b.first_active_month <= a.first_active_month)::bigint
                  as cumulative_pairs from starts_m a""",
)
def _(spark, d):
    return profile.running_total(late_starts_per_month(spark, d))


@query(
    "w11_next_month_alignment",
    """select count(*) as n_months, count(*) filter (not coalesce(nm = shifted, false)) as mismatches,
              count(*) - count(*) filter (not coalesce(nm = shifted, false)) as aligned
       from (select "num_holidays_total_NM" as nm, lead(num_holidays_total) over (order by snapshot_date) as shifted
             from hol)""",
)
def _(spark, d):
    events = retail.holidays_events(spark, d)
    return profile.next_month_alignment(holidays.with_next_month(holidays.monthly_holidays(events)))


# -- order and sets ----------------------------------------------------------


@query("t1_ordered_starts", "select * from starts")
def _(spark, d):
    return rollup.first_active(retail.daily_sales(spark, d), rollup.PAIR).orderBy("store_nbr", "family")


@query(
    "t2_top_features",
    f"""select feature, round(gain, 6) as gain from (
        {" union all ".join(
            f"select '{c}' as feature, abs(corr(" + f'coalesce("{c}", 0)::double, label_next_month_sales)) as gain from aligned'
            for c in schemas.NUMERIC_FEATURES
        )}) order by round(gain, 6) desc, feature limit 20""",
)
def _(spark, d):
    """Top 20 of all features by the strength of their correlation with the label."""
    g = gold(spark, d)
    rows = clean.fill_numbers(dataset.align(g.features, g.labels), schemas.NUMERIC_FEATURES)
    gains = rows.agg(
        *[F.abs(F.corr(F.col(f"`{c}`").cast("double"), schemas.LABEL)).alias(c) for c in schemas.NUMERIC_FEATURES]
    ).unpivot([], [F.col(f"`{c}`") for c in schemas.NUMERIC_FEATURES], "feature", "gain")
    return modelling.top_features(rounded(gains, 6, "gain"))


@query(
    "t3_preview",
    "select * from daily_pairs order by store_nbr, family, date limit 20",
)
def _(spark, d):
    return rollup.daily_pairs(retail.daily_sales(spark, d)).orderBy("store_nbr", "family", "date").limit(20)


@query(
    "u1_union_of_months",
    """select snapshot_date, store_nbr, family, sales from sales_m
       where snapshot_date between date '1997-07-01' and date '1997-09-01'""",
)
def _(spark, d):
    sales = rollup.monthly_sales(retail.daily_sales(spark, d)).select("snapshot_date", *rollup.PAIR, "sales")
    months = ["1997-07-01", "1997-08-01", "1997-09-01"]
    return sales.where(F.col("snapshot_date").isin([F.lit(m).cast("date") for m in months]))


@query("u2_concat_aligned", "select snapshot_date, store_nbr, family, label_next_month_sales from aligned")
def _(spark, d):
    g = gold(spark, d)
    aligned = dataset.align(g.features, g.labels).select("snapshot_date", *schemas.JOIN_KEYS, schemas.LABEL)
    early, late = (aligned.where(c) for c in (F.col("snapshot_date") < REFERENCE, F.col("snapshot_date") >= REFERENCE))
    return early.unionByName(late)


@query(
    "u3_missing_months",
    """select r.m as run_month, k.kind, k.s as snapshot_date
       from (select distinct snapshot_date as m from lab) r,
            lateral (select 'feature' as kind, (r.m - interval 1 month * (i + 1))::date as s from range(24) t(i)
                     union all select 'label', (r.m - interval 1 month * i)::date from range(24) t(i)) k
       where (k.kind = 'feature' and k.s not in (select snapshot_date from feat))
          or (k.kind = 'label' and k.s not in (select snapshot_date from lab))""",
)
def _(spark, d):
    g = gold(spark, d)
    features, labels = g.features.select("snapshot_date").distinct(), g.labels.select("snapshot_date").distinct()
    runs = labels.select(F.col("snapshot_date").alias("run_month"))
    return dataset.missing_months(runs, features, labels)


@query(
    "u4_category_union",
    f"""select variable, snapshot_date, value, coalesce(r.share, 0) as ref_share, coalesce(c.share, 0) as cur_share,
               round(coalesce(c.share, 0) - coalesce(r.share, 0), 6) as diff
        from (select variable, m.snapshot_date, value, n / sum(n) over (partition by variable, m.snapshot_date) as share
              from (select variable, value, count(*) as n from ref_values
                    where variable = 'onpromotion_LM' group by all),
                   (select distinct snapshot_date from feat) m) r
        full join (select variable, snapshot_date, value, n / sum(n) over (partition by variable, snapshot_date) as share
                   from (select variable, snapshot_date, value, count(*) as n from long_values
                         where variable = 'onpromotion_LM' group by all)) c
        using (variable, snapshot_date, value)""",
)
def _(spark, d):
    values = drift.long_values(gold(spark, d).features, ["onpromotion_LM"])
    return rounded(drift.category_shares(drift.month_of(values, REFERENCE), values), 6, "diff")

