"""Registered queries: splits and models, gates, registry, reports and promotion."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import clean, dataset, drift, holidays, lifecycle, modelling, rollup, sliding, weekly
from shelfcast.plans import monthly, training
from shelfcast.plans.candidates import fitted
from shelfcast.plans.gold import gold, input_state
from shelfcast.plans.queries_drift import DRIFT_TABLE_SQL, PREDICTION_CSI_SQL, comparison
from shelfcast.plans.queries_panel import candidate_scores, candidates, trainable_versions
from shelfcast.plans.registry import ANCHOR, DEPLOYMENT, REFERENCE, moments_sql, query, ridge_sql, rounded
from shelfcast.session import new_table_path, written
from shelfcast.sources import files, retail, schemas

# -- splits ------------------------------------------------------------------

SPLIT_CASE = f"""case when fm > date '{ANCHOR}' - interval 2 month then 'oot'
                      when fm > date '{ANCHOR}' - interval 4 month then 'test'
                      when fm > date '{ANCHOR}' - interval 6 month then 'val' else 'train' end"""
IN_WINDOW = f"fm between date '{ANCHOR}' - interval 23 month and date '{ANCHOR}'"


def split_months(spark, d) -> DataFrame:
    g = gold(spark, d)
    usable = dataset.usable_months(
        g.features.select("snapshot_date").distinct(), g.labels.select("snapshot_date").distinct()
    )
    return dataset.rolling_split(usable, ANCHOR)


@query(
    "m1_rolling_split",
    f"""select fm as snapshot_date, {SPLIT_CASE} as split
        from (select distinct f.snapshot_date as fm from feat f join lab l
              on l.snapshot_date = f.snapshot_date + interval 1 month) where {IN_WINDOW}""",
)
def _(spark, d):
    return split_months(spark, d)


def weekly_table(spark, d) -> DataFrame:
    dates = holidays.holiday_dates(retail.holidays_events(spark, d))
    return weekly.trailing_weeks(weekly.weekly_rollup(retail.daily_sales(spark, d), dates))


@query(
    "m2_day_window_split",
    """select store_nbr, family, date, sales,
              case when date >= date '1999-08-30' then 'oot' else 'train_test' end as split
       from daily_pairs where date between date '1999-08-25' and date '1999-08-31'""",
)
def _(spark, d):
    daily = rollup.daily_pairs(retail.daily_sales(spark, d)).select(*rollup.PAIR, "date", "sales")
    return dataset.day_window_split(
        daily, "1999-09-01", "date", schemas.DAY_SPLIT_TRAIN_TEST_DAYS, schemas.DAY_SPLIT_OOT_DAYS
    )


HASH_SQL = """case when ('0x' || substr(md5('88|' || store_nbr || '|' || family || '|' || week_start), 1, 8))::bigint
                     % 1000 < 800 then 'train' else 'test' end"""


@query("m3_random_split", f"select store_nbr, family, week_start, {HASH_SQL} as split from weekly")
def _(spark, d):
    weeks = rollup.weekly_sales(retail.daily_sales(spark, d)).drop("sales_week")
    keys = ["store_nbr", "family", "week_start"]
    return dataset.hash_split(weeks, keys, schemas.RANDOM_SPLIT_SHARE, schemas.RANDOM_SPLIT_SEED)


@query(
    "m4_cutoff_split",
    """select *, case when week_start <= (select max(week_start) from weekly) - interval 140 day
                      then 'train' else 'test' end as split from weekly""",
)
def _(spark, d):
    return dataset.cutoff_split(rollup.weekly_sales(retail.daily_sales(spark, d)), schemas.HOLDOUT_WEEKS)


VECTOR_COLUMNS = ["days_in_week", "any_holiday", "avg_sales_14d", "avg_sales_28d", "sum_sales_14d", "sum_sales_28d"]


@query(
    "m5_feature_vector",
    "select store_nbr, family, week_start, 6 as dims, "
    + ", ".join(f"round({c}::double, 4) as f{i}" for i, c in enumerate(VECTOR_COLUMNS))
    + " from weekly_t",
)
def _(spark, d):
    vectors = modelling.assemble(weekly_table(spark, d), VECTOR_COLUMNS)
    parts = vectors.withColumn("x", vector_to_array("features_raw"))
    return parts.select(
        "store_nbr",
        "family",
        "week_start",
        F.size("x").alias("dims"),
        *[F.round(F.get("x", F.lit(i)), 4).alias(f"f{i}") for i in range(len(VECTOR_COLUMNS))],
    )


#: Every numeric column of the weekly rows.
WEEKLY_NUMBERS = ["weekly_sales_sum", "weekly_sales_avg", *VECTOR_COLUMNS]


@query(
    "m5_feature_vector_full",
    "select store_nbr, family, week_start, "
    + ", ".join(f"round({c}::double, 3) as {c}" for c in WEEKLY_NUMBERS)
    + " from weekly_t",
)
def _(spark, d):
    table = weekly_table(spark, d)
    columns = clean.numeric_columns(table)
    x = modelling.assemble(table, columns).withColumn("x", vector_to_array("features_raw"))
    return x.select(
        "store_nbr", "family", "week_start", *[F.round(F.get("x", F.lit(i)), 3).alias(c) for i, c in enumerate(columns)]
    )


STANDARDIZED = ["sum_sales_14d", "sum_sales_28d", "days_in_week"]


def standardized_sql(columns: list[str]) -> str:
    signless = ", ".join(f"case when {c} = 0 then 0 else {c} end as {c}_scaled" for c in columns)
    scaled = ", ".join(
        f"""round(case when stddev_samp({c}) over g > 0 then ({c} - avg({c}) over g) / stddev_samp({c}) over g
            else 0 end, 4) as {c}"""
        for c in columns
    )
    return f"""select store_nbr, family, week_start, {signless}
        from (select store_nbr, family, week_start, {scaled} from weekly_t
              window g as (partition by store_nbr, family))"""


def standardized(table: DataFrame, columns: list[str]) -> DataFrame:
    scaled = modelling.standardize_by(table, rollup.PAIR, columns)
    names = [f"{c}_scaled" for c in columns]
    short = rounded(scaled.select("store_nbr", "family", "week_start", *names), 4, *names)
    return short.withColumns({c: F.when(F.col(c) == 0, 0.0).otherwise(F.col(c)) for c in names})  # no minus zero


@query("m6_standardized", standardized_sql(STANDARDIZED))
def _(spark, d):
    return standardized(weekly_table(spark, d), STANDARDIZED)


@query("m6_standardized_full", standardized_sql(WEEKLY_NUMBERS))
def _(spark, d):
    table = weekly_table(spark, d)
    return standardized(table, clean.numeric_columns(table))


@query(
    "m7_one_hot",
    """with cut as (select *, week_start <= (select max(week_start) from weekly) - interval 140 day as is_train
                    from weekly),
            ranked as (select family as category, row_number() over (order by count(*) desc, family) - 1 as position
                       from cut where is_train group by 1)
       select c.store_nbr, c.family, c.week_start, r.position::int as position,
              (r.category = c.family)::int::double as hot
       from cut c, ranked r""",
)
def _(spark, d):
    """Positions fixed by the training weeks; the extra position for unseen families is left out."""
    split = dataset.cutoff_split(rollup.weekly_sales(retail.daily_sales(spark, d)), schemas.HOLDOUT_WEEKS)
    encoder = modelling.one_hot(split.where(F.col("split") == "train"), ["family"])
    n = len(encoder.stages[0].labelsArray[0])
    encoded = encoder.transform(split).withColumn("x", F.slice(vector_to_array("family_hot"), 1, n))
    return encoded.select("store_nbr", "family", "week_start", F.posexplode("x").alias("position", "hot"))


def ranked_sql(column: str) -> str:
    return f"""select '{column}' as variable, {column}::varchar as category,
                      row_number() over (order by count(*) desc, {column}::varchar) - 1 as position
               from cut where is_train group by {column}"""


@query(
    "m7_one_hot_positions",
    f"""with cut as (select *, week_start <= (select max(week_start) from weekly) - interval 140 day as is_train
                     from weekly),
            ranked as ({ranked_sql('store_nbr')} union all {ranked_sql('family')})
       select c.store_nbr, c.family, c.week_start, r.variable, r.position::int as position
       from cut c join ranked r on r.category = case r.variable when 'family' then c.family else c.store_nbr::varchar end""",
)
def _(spark, d):
    """Both categories, two rows for each pair and week at most."""
    split = dataset.cutoff_split(rollup.weekly_sales(retail.daily_sales(spark, d)), schemas.HOLDOUT_WEEKS)
    indexer = modelling.category_indexer(rollup.PAIR).fit(split.where(F.col("split") == "train"))
    return modelling.hot_positions(indexer, split, [*rollup.PAIR, "week_start"], rollup.PAIR)


@query(
    "m8_category_index",
    """select f.snapshot_date, f.store_nbr, f.family, s.position::double as store_nbr_idx,
              r.position::double as family_idx
       from feat f
       join (select family, row_number() over (order by count(*) desc, family) - 1 as position
             from feat group by 1) r on r.family = f.family
       join (select store_nbr, row_number() over (order by count(*) desc, store_nbr::varchar) - 1 as position
             from feat group by 1) s on s.store_nbr = f.store_nbr""",
)
def _(spark, d):
    features = clean.fill_categories(gold(spark, d).features, schemas.CATEGORICAL_FEATURES)
    indexed = modelling.category_indexer(schemas.CATEGORICAL_FEATURES).fit(features).transform(features)
    return indexed.select("snapshot_date", "store_nbr", "family", "store_nbr_idx", "family_idx")


@query(
    "m8_mean_encoding",
    f"""select store_nbr, round(avg(label_next_month_sales), 4) as store_nbr_idx from aligned
        where snapshot_date <= date '{ANCHOR}' group by 1""",
)
def _(spark, d):
    g = gold(spark, d)
    train = dataset.align(g.features, g.labels).where(F.col("snapshot_date") <= F.lit(ANCHOR).cast("date"))
    return rounded(modelling.mean_encoding(train, "store_nbr", schemas.LABEL), 4, "store_nbr_idx")


@query(
    "m8_out_of_fold_encoding",
    f"""with t as (select snapshot_date, store_nbr, family, label_next_month_sales::double as y,
                      ('0x' || substr(md5('88|' || snapshot_date || '|' || store_nbr || '|' || family), 1, 8))::bigint
                      % {modelling.ENCODING_FOLDS} as fold
                   from aligned where snapshot_date <= date '{ANCHOR}'),
             c as (select store_nbr, fold, sum(y) as s, count(y) as n from t group by all),
             whole as (select store_nbr, sum(s) as s, sum(n) as n from c group by all),
             folds as (select fold, (select sum(s) from c) - sum(s) as s, (select sum(n) from c) - sum(n) as n
                       from c group by fold)
        select t.snapshot_date, t.store_nbr, t.family,
               round((w.s - c.s + {modelling.ENCODING_PRIOR}::double * f.s / f.n)
                     / (w.n - c.n + {modelling.ENCODING_PRIOR}::double), 4) as store_nbr_idx
        from t join c using (store_nbr, fold) join whole w using (store_nbr) join folds f using (fold)""",
)
def _(spark, d):
    g = gold(spark, d)
    train = dataset.align(g.features, g.labels).where(F.col("snapshot_date") <= F.lit(ANCHOR).cast("date"))
    keys = ["snapshot_date", *schemas.JOIN_KEYS]
    inside, _ = modelling.out_of_fold_encoding(train, "store_nbr", schemas.LABEL, keys)
    return rounded(inside.select(*keys, "store_nbr_idx"), 4, "store_nbr_idx")


# -- models ------------------------------------------------------------------


WEEKS_SPLIT_SQL = f"""
    with weeks_split as (
        select *, weekly_sales_sum as y, {", ".join(f"{c} as x{i}" for i, c in enumerate(training.RIDGE_COLUMNS))},
               case when week_start > (select max(week_start) from weekly_t) - interval 140 day then 'oot'
                    else {HASH_SQL} end as split
        from weekly_t),
    found as (
        select store_nbr, family, {moments_sql(len(training.RIDGE_COLUMNS))}
        from weeks_split where split = 'train' group by all),
    fitted as ({ridge_sql("found", "store_nbr, family", len(training.RIDGE_COLUMNS))})"""


@query(
    "m9_ridge_per_pair",
    WEEKS_SPLIT_SQL
    + " select store_nbr, family, n_rows, round(intercept, 2) as intercept, "
    + ", ".join(f"round(k{i}, 3) as coef_{c}" for i, c in enumerate(training.RIDGE_COLUMNS))
    + " from fitted",
)
def _(spark, d):
    models, _ = training.weekly_ridge(weekly_table(spark, d))
    return rounded(rounded(models, 2, "intercept"), 3, *[f"coef_{c}" for c in training.RIDGE_COLUMNS])


ONE_FEATURE_SQL = f"""
    with weeks_split as (
        select *, weekly_sales_sum as y, sum_sales_28d as x,
               case when week_start > (select max(week_start) from weekly_t) - interval 140 day then 'oot'
                    else {HASH_SQL} end as split
        from weekly_t),
    moments as (
        select store_nbr, family, count(*) as n_rows, avg(x) as mx, avg(y) as my, var_pop(x) as vx, var_pop(y) as vy,
               covar_pop(x, y) as c
        from weeks_split where split = 'train' group by all),
    slopes as (
        select *, case when vx = 0 or vy = 0 then 0
                       else c / sqrt(vx * vy) / (1 + 0.1 / sqrt(vy)) * sqrt(vy) / sqrt(vx) end as slope
        from moments)"""


@query(
    "m9_ridge_one_feature",
    ONE_FEATURE_SQL
    + """ select store_nbr, family, n_rows, round(my - slope * mx, 4) as intercept,
               round(slope, 6) as coef_sum_sales_28d from slopes""",
)
def _(spark, d):
    """The same job with a single feature, where the solution is a formula."""
    models, _ = training.weekly_ridge(weekly_table(spark, d), ["sum_sales_28d"])
    return rounded(rounded(models, 4, "intercept"), 6, "coef_sum_sales_28d")


@query(
    "m17_summary_one_feature",
    ONE_FEATURE_SQL
    + """, errors as (
        select w.store_nbr, w.family, w.split, sqrt(avg(e * e)) as rmse,
               case when var_pop(y) != 0 then 1 - sum(e * e) / (var_pop(y) * count(*))
                    when sum(e * e) = 0 then 1 else 0 end as r2
        from (select w.*, s.my + s.slope * (w.x - s.mx) - w.y as e
              from weeks_split w join slopes s using (store_nbr, family)) w group by all)
    select store_nbr, family, 'LinearRegression' as model_type, 0.1::double as "regParam",
           0::double as "elasticNetParam", """
    + ", ".join(
        f"round(max(case when split = '{s}' then {m} end), 4) as {s}_{m}"
        for m in ("rmse", "r2")
        for s in ("train", "test", "oot")
    )
    + " from errors group by 1, 2",
)
def _(spark, d):
    _, summary = training.weekly_ridge(weekly_table(spark, d), ["sum_sales_28d"])
    return rounded(summary, 4, *[f"{s}_{m}" for m in ("rmse", "r2") for s in ("train", "test", "oot")])


_boosted: dict = {}


def boosted(spark, d) -> training.Fitted:
    """The monthly boosted trees of the anchor's window, fitted once for the stored gold tables."""
    g = gold(spark, d)
    if g not in _boosted:
        _boosted[g] = training.monthly_boosted_trees(g.features, g.labels, ANCHOR)
    return _boosted[g]


@query("m10_boosted_trees")
def _(spark, d):
    """Metrics of a boosted model per split, beside those of the naive forecast on the same rows."""
    made = boosted(spark, d)
    naive = modelling.regression_scores(
        made.rows.withColumn(schemas.PREDICTION, F.col("sales_LM").cast("double")), "split"
    )
    return made.scores.withColumn("model", F.lit("boosted_trees")).unionByName(
        naive.withColumn("model", F.lit("naive"))
    )


@query(
    "m10_boosted_rows",
    f"""select split, store_nbr, family, fm as snapshot_date, round(y, 4) as label_next_month_sales, true as is_scored
        from (select fm, store_nbr, family, y, {SPLIT_CASE} as split from ridge_rows where {IN_WINDOW})""",
)
def _(spark, d):
    """The rows that the boosted model learnt from and is judged on, and whether each has a finite score."""
    made = boosted(spark, d)
    score = F.col(schemas.PREDICTION)
    return rounded(
        made.model.predict(made.rows).select(
            "split",
            *schemas.JOIN_KEYS,
            "snapshot_date",
            schemas.LABEL,
            (score.isNotNull() & ~F.isnan(score) & (F.abs(score) < float("inf"))).alias("is_scored"),
        ),
        4,
        schemas.LABEL,
    )


_weekly_boosted: dict = {}


def weekly_boosted(spark, d) -> training.Fitted:
    """The weekly boosted trees of one session and input folder, fitted again when the input has changed."""
    key = (spark.sparkContext.applicationId, d, input_state(spark, d))
    if key not in _weekly_boosted:
        weeks = weekly.lag_features(rollup.weekly_sales(retail.daily_sales(spark, d)))
        _weekly_boosted[key] = training.weekly_boosted_trees(weeks)
    return _weekly_boosted[key]


@query("m11_weekly_boosted_trees")
def _(spark, d):
    return weekly_boosted(spark, d).scores


@query(
    "m11_weekly_rows",
    """select split, count(*) as n_rows, round(avg(sales_week), 4) as mean_sales, min(week_start) as first_week,
              max(week_start) as last_week
       from (select *, case when week_start > (select max(week_start) from weekly_l) - interval 140 day then 'test'
                            when week_start > (select max(week_start) from weekly_l) - interval 280 day then 'val'
                            else 'train' end as split from weekly_l)
       group by 1""",
)
def _(spark, d):
    """The rows of each split that the weekly model scores, and their weeks."""
    made = weekly_boosted(spark, d)
    known = made.model.predict(made.rows).where(F.col(schemas.PREDICTION).isNotNull())
    found = known.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.avg("sales_week").alias("mean_sales"),
        F.min("week_start").alias("first_week"),
        F.max("week_start").alias("last_week"),
    )
    return rounded(found, 4, "mean_sales")


@query("m12_feature_importance")
def _(spark, d):
    return modelling.top_features(boosted(spark, d).model.gains())


@query(
    "m13_split_evaluation",
    f"""select split, round(sqrt(avg((y - p) * (y - p))), 4) as rmse, round(avg(abs(y - p)), 4) as mae,
               round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) as r2, count(*) as n_rows
        from (select fm, y, intercept{"".join(f" + k{i} * x{i}" for i in range(len(schemas.RIDGE_FEATURES)))} as p,
                     {SPLIT_CASE} as split
              from ridge_rows, ridge_models where version = date '{ANCHOR}' and {IN_WINDOW})
        group by 1""",
)
def _(spark, d):
    """The ridge model of the window, on the rows of each of its splits."""
    found = fitted(spark, d)
    at_anchor = F.col("training_window_end") == F.lit(ANCHOR).cast("date")
    own = sliding.scored(
        dataset.with_split(found.rows, split_months(spark, d)), found.models, schemas.RIDGE_FEATURES, at_anchor
    )
    return rounded(rounded(modelling.regression_scores(own, "split"), 4, "rmse", "mae"), 6, "r2")


@query("m14_batch_scoring")
def _(spark, d):
    """One month scored by the model trained on the 24 months before it."""
    month = gold(spark, d).features.where(F.col("snapshot_date") == F.add_months(F.lit(ANCHOR).cast("date"), 2))
    return modelling.prediction_rows(boosted(spark, d).model.predict(month))


@query(
    "m14_scored_pairs",
    f"""select store_nbr, family, snapshot_date, true as is_scored from feat
        where snapshot_date = date '{ANCHOR}' + interval 2 month""",
)
def _(spark, d):
    """The pairs of the month that the boosted model scores."""
    month = gold(spark, d).features.where(F.col("snapshot_date") == F.add_months(F.lit(ANCHOR).cast("date"), 2))
    found = modelling.prediction_rows(boosted(spark, d).model.predict(month))
    return found.select(*schemas.JOIN_KEYS, "snapshot_date", F.col(schemas.PREDICTION).isNotNull().alias("is_scored"))


@query(
    "m15_next_week_rows",
    """select store_nbr, family, max(case when age = 1 then sales_week end) as sales_lag_1,
              round(avg(sales_week), 4) as sales_avg_4,
              (select week(max(week_start) + interval 7 day) from weekly)::int as weekofyear
       from (select *, row_number() over (partition by store_nbr, family order by week_start desc) as age from weekly)
       where age <= 4 group by 1, 2""",
)
def _(spark, d):
    return rounded(weekly.next_week_rows(rollup.weekly_sales(retail.daily_sales(spark, d))), 4, "sales_avg_4")


@query("m15_next_week_forecast")
def _(spark, d):
    made = weekly_boosted(spark, d)
    forecast = made.model.predict(weekly.next_week_rows(made.rows))
    return forecast.select(
        *schemas.JOIN_KEYS, *training.WEEKLY_NUMERIC, F.col(schemas.PREDICTION).alias("pred_sales_next_week")
    )


SPLIT_STRUCT_SQL = ", ".join(
    f"""max(case when split = '{s}' then start end) as {s}_start, max(case when split = '{s}' then "end" end) as {s}_end,
        max(case when split = '{s}' then rows end) as {s}_rows"""
    for s in ("train", "val", "test", "oot")
)


@query(
    "m16_model_metadata",
    f"""select strftime(training_window_end, '%Y-%m-%d') as model_version, 'label_at_S_plus_1' as label_alignment,
               {len(schemas.RIDGE_FEATURES)} as n_numeric, round(max(case when split = 'oot' then r2 end), 6) as oot_r2, {SPLIT_STRUCT_SQL}
        from candidate_scores group by training_window_end""",
)
def _(spark, d):
    meta = candidates(spark, d)
    spans = [
        F.col(f"split_stats.{s}.{f}").alias(f"{s}_{f}")
        for s in ("train", "val", "test", "oot")
        for f in ("start", "end", "rows")
    ]
    return meta.select(
        "model_version",
        "label_alignment",
        F.size("numerical_features").alias("n_numeric"),
        F.round("metrics.oot.r2", 6).alias("oot_r2"),
        *spans,
    )


@query(
    "m17_training_summary",
    WEEKS_SPLIT_SQL
    + f""", errors as (
        select store_nbr, family, split, sqrt(avg(e * e)) as rmse,
               case when var_pop(y) != 0 then 1 - sum(e * e) / (var_pop(y) * count(*))
                    when sum(e * e) = 0 then 1 else 0 end as r2
        from (select w.*, intercept{"".join(f" + k{i} * x{i}" for i in range(len(training.RIDGE_COLUMNS)))} - y as e
              from weeks_split w join fitted using (store_nbr, family)) group by all)
    select store_nbr, family, 'LinearRegression' as model_type, 0.1::double as "regParam",
           0::double as "elasticNetParam", """
    + ", ".join(
        f"round(max(case when split = '{s}' then {m} end), {2 if m == 'rmse' else 4}) as {s}_{m}"
        for m in ("rmse", "r2")
        for s in ("train", "test", "oot")
    )
    + " from errors group by 1, 2",
)
def _(spark, d):
    _, summary = training.weekly_ridge(weekly_table(spark, d))
    splits = ("train", "test", "oot")
    return rounded(rounded(summary, 2, *[f"{s}_rmse" for s in splits]), 4, *[f"{s}_r2" for s in splits])


@query(
    "a22_split_statistics",
    f"""select split, min(fm) as start, max(fm) as "end", count(*) as rows
        from (select fm, {SPLIT_CASE} as split from (select snapshot_date as fm from aligned) where {IN_WINDOW})
        group by 1""",
)
def _(spark, d):
    g = gold(spark, d)
    rows = dataset.with_split(dataset.align(g.features, g.labels), split_months(spark, d))
    return dataset.split_statistics(rows)


# -- gates -------------------------------------------------------------------


@query("g1_three_months_present", "select * from ready")
def _(spark, d):
    return monthly.ready_months(retail.daily_sales(spark, d))


@query("g2_trainable_versions", "select * from versions")
def _(spark, d):
    return trainable_versions(spark, d)


@query(
    "g3_deployment_gates",
    f"""select snapshot_date, snapshot_date >= date '{DEPLOYMENT}' as can_score,
               snapshot_date >= date '{DEPLOYMENT}' + interval 1 month as can_monitor,
               snapshot_date >= date '{DEPLOYMENT}' as can_promote from ready""",
)
def _(spark, d):
    months = monthly.ready_months(retail.daily_sales(spark, d))
    start = F.lit(DEPLOYMENT).cast("date")
    return months.select(
        "snapshot_date",
        (F.col("snapshot_date") >= start).alias("can_score"),
        (F.col("snapshot_date") >= F.add_months(start, 1)).alias("can_monitor"),
        (F.col("snapshot_date") >= start).alias("can_promote"),
    )


@query(
    "g4_source_readiness",
    """select date '1997-09-15' as date, count(*) as n_rows, count(*) > 0 as ready from daily_sales
       where date = date '1997-09-15'
       union all select date '1990-01-01', count(*), count(*) > 0 from daily_sales where date = date '1990-01-01'""",
)
def _(spark, d):
    sales = retail.daily_sales(spark, d)
    return lifecycle.readiness(sales, "1997-09-15").unionByName(lifecycle.readiness(sales, "1990-01-01"))


@query("g5_output_not_empty", "select snapshot_date, count(*) as n_rows from feat group by 1")
def _(spark, d):
    features = lifecycle.require_rows(gold(spark, d).features, "feature store")
    return features.groupBy("snapshot_date").agg(F.count("*").alias("n_rows"))


# -- registry and reports ----------------------------------------------------

REGISTRY_SQL = f"""
    select strftime(training_window_end, '%Y-%m-%d') as model_version, training_window_end,
           null::varchar as timestamp_utc, training_window_end = date '{REFERENCE}' as is_deployed, """ + ", ".join(
    [
        f"round(max(case when split = '{s}' then {m} end), {6 if m == 'r2' else 4}) as {s}_{m}"
        for s in ("val", "test", "oot")
        for m in ("rmse", "mae", "r2")
    ]
    + [f"max(case when split = '{s}' then rows end) as {s}_rows" for s in ("train", "val", "test", "oot")]
) + " from candidate_scores group by training_window_end"


def round_registry(registered: DataFrame) -> DataFrame:
    for s in ("val", "test", "oot"):
        registered = rounded(rounded(registered, 4, f"{s}_rmse", f"{s}_mae"), 6, f"{s}_r2")
    return registered


@query("r1_registry", REGISTRY_SQL)
def _(spark, d):
    return round_registry(lifecycle.registry(candidates(spark, d), REFERENCE))


@query("s11_json_metadata_scan", REGISTRY_SQL)
def _(spark, d):
    """Candidate metadata written as JSON documents, scanned back and flattened."""
    path = new_table_path(spark, "candidate_metadata")
    files.write_json(candidates(spark, d), path)
    found = files.read_json(spark, path, schemas.MODEL_METADATA_SCHEMA)
    return round_registry(lifecycle.registry(found, REFERENCE))


@query(
    "x9_nested_access",
    """select strftime(training_window_end, '%Y-%m-%d') as version,
              coalesce(round(max(case when split = 'oot' then r2 end), 6), 0) as oot_r2,
              coalesce(max(case when split = 'train' then rows end), 0) as train_rows
       from candidate_scores group by training_window_end""",
)
def _(spark, d):
    return candidates(spark, d).select(
        F.coalesce("model_version", F.lit("unknown")).alias("version"),
        F.coalesce(F.round("metrics.oot.r2", 6), F.lit(0.0)).alias("oot_r2"),
        F.coalesce("split_stats.train.rows", F.lit(0)).alias("train_rows"),
    )


@query(
    "r7_candidate_comparison",
    f"""select strftime(training_window_end, '%Y-%m-%d') as model_version, round(r2, 6) as oot_r2,
               training_window_end = date '{REFERENCE}' as is_deployed
        from candidate_scores where split = 'oot' and r2 is not null""",
)
def _(spark, d):
    return rounded(lifecycle.candidate_comparison(lifecycle.registry(candidates(spark, d), REFERENCE)), 6, "oot_r2")


@query(
    "w13_best_candidate",
    """select arg_min(strftime(training_window_end, '%Y-%m-%d'), (-r2, training_window_end)) as model_version,
              round(max(r2), 6) as oot_r2 from candidate_scores where split = 'oot' and r2 is not null""",
)
def _(spark, d):
    return rounded(lifecycle.best_candidate(lifecycle.registry(candidates(spark, d), REFERENCE)), 6, "oot_r2")


def offers(spark, d) -> DataFrame:
    """Candidate versions with their out-of-time metrics."""
    return (
        candidate_scores(spark, d)
        .where(F.col("split") == "oot")
        .select(F.col("training_window_end").alias("model_version"), "rmse", "mae", "r2")
    )


def breaches(spark, d) -> DataFrame:
    """Scores of the first deployed candidate in every monitored month against its own baseline."""
    first = F.col("model_version") == F.lit(REFERENCE).cast("date")
    live = fitted(spark, d).scores_of(REFERENCE)
    monitored = lifecycle.from_month(live, DEPLOYMENT, months_later=1)
    return lifecycle.with_breaches(monitored, offers(spark, d).where(first))


BREACH_SQL = f"""
    select s.snapshot_date, s.rmse, s.mae, s.r2, b.rmse as base_rmse, b.mae as base_mae, b.r2 as base_r2,
           b.r2 - s.r2 > 0.10 as r2_breach, s.rmse / b.rmse > 1.25 as rmse_breach, s.mae / b.mae > 1.25 as mae_breach
    from (select * from live_scores where version = date '{REFERENCE}') s
    left join (select * from candidate_scores where split = 'oot' and training_window_end = date '{REFERENCE}') b on true
    where s.snapshot_date >= date '{DEPLOYMENT}' + interval 1 month"""


@query("r2_breaches", f"select snapshot_date, r2_breach, rmse_breach, mae_breach from ({BREACH_SQL})")
def _(spark, d):
    return breaches(spark, d).select("snapshot_date", "r2_breach", "rmse_breach", "mae_breach")


ANY_SQL = "coalesce(r2_breach, false) or coalesce(rmse_breach, false) or coalesce(mae_breach, false)"


@query("r3a_any_breach", f"select snapshot_date, {ANY_SQL} as breach_flag from ({BREACH_SQL})")
def _(spark, d):
    return lifecycle.with_breach_flag(breaches(spark, d), "any").select("snapshot_date", "breach_flag")


@query(
    "r3b_persistent_breach",
    f"""with x as ({BREACH_SQL})
        select a.snapshot_date, coalesce(a.r2_breach, false)
               or (coalesce(a.rmse_breach, false) and coalesce(b.rmse_breach, false))
               or (coalesce(a.mae_breach, false) and coalesce(b.mae_breach, false)) as breach_flag
        from x a left join x b on b.snapshot_date = a.snapshot_date - interval 1 month""",
)
def _(spark, d):
    return lifecycle.with_breach_flag(breaches(spark, d), "persistent").select("snapshot_date", "breach_flag")


def reports(spark, d) -> DataFrame:
    flagged = lifecycle.with_breach_flag(breaches(spark, d), "any")
    stores = gold(spark, d)
    return lifecycle.report_rows(
        flagged,
        drift.drift_table(comparison(spark, d)),
        REFERENCE,
        drift.missing_variables(stores.features, schemas.DRIFT_VARIABLES),
        drift.prediction_drift(stores.predictions, REFERENCE),
    )


MISSING_SQL = f"""
    select m.snapshot_date, coalesce(string_agg(v.variable, ',' order by v.place) filter (l.variable is null), '') as names
    from (select distinct snapshot_date from feat) m
    cross join (values {", ".join(f"('{v}', {i})" for i, v in enumerate(schemas.DRIFT_VARIABLES))}) v(variable, place)
    left join (select distinct variable, snapshot_date from long_values) l
         on l.variable = v.variable and l.snapshot_date = m.snapshot_date
    group by 1"""

REPORT_SQL = f"""
    select x.snapshot_date, (x.snapshot_date - interval 1 month)::date as prediction_snapshot,
           date '{REFERENCE}' as reference_snapshot_for_drift, round(rmse, 4) as rmse, round(base_r2, 6) as base_r2,
           r2_breach, {ANY_SQL} as breach_flag, t.variable, t.psi, t.psi_severity, t.csi, t.csi_severity,
           (select names from ({MISSING_SQL}) where snapshot_date = date '{REFERENCE}') as missing_in_reference,
           n.names as missing_in_current, p.csi as prediction_csi, p.csi_severity as prediction_csi_severity
    from ({BREACH_SQL}) x
    left join ({MISSING_SQL}) n on n.snapshot_date = x.snapshot_date - interval 1 month
    left join ({PREDICTION_CSI_SQL}) p on p.snapshot_date = x.snapshot_date - interval 1 month
    left join ({DRIFT_TABLE_SQL}) t on t.snapshot_date = x.snapshot_date - interval 1 month"""


def flat_reports(nested: DataFrame) -> DataFrame:
    return nested.select("*", F.inline_outer("psi_csi_summary")).select(
        "snapshot_date",
        "prediction_snapshot",
        "reference_snapshot_for_drift",
        F.round("metrics.rmse", 4).alias("rmse"),
        F.round("baseline_metrics.oot.r2", 6).alias("base_r2"),
        F.col("breaches.r2_breach").alias("r2_breach"),
        "breach_flag",
        "variable",
        "psi",
        "psi_severity",
        "csi",
        "csi_severity",
        *[F.concat_ws(",", c).alias(c) for c in ("missing_in_reference", "missing_in_current")],
        F.col("prediction_csi.value").alias("prediction_csi"),
        F.col("prediction_csi.severity").alias("prediction_csi_severity"),
    )


@query("r6_monitoring_reports", REPORT_SQL)
def _(spark, d):
    return flat_reports(reports(spark, d))


@query("s10_json_report_sink", REPORT_SQL)
def _(spark, d):
    path = new_table_path(spark, "reports")
    files.write_json(reports(spark, d), path)
    return flat_reports(files.read_json(spark, path, schemas.REPORT_SCHEMA))


@query(
    "w12_latest_report",
    f"""select snapshot_date, {ANY_SQL} as breach_flag from ({BREACH_SQL})
        where snapshot_date <= date '{ANCHOR}' order by snapshot_date desc limit 1""",
)
def _(spark, d):
    flagged = lifecycle.with_breach_flag(breaches(spark, d), "any")
    return lifecycle.latest_report(flagged, ANCHOR)


# -- promotion ---------------------------------------------------------------


def timeline_sql(flag: str) -> str:
    """The month-by-month replay as a recursive query."""
    return f"""
    with recursive offers as (select * from candidate_scores where split = 'oot' and r2 is not null),
    runs as (
        select s.snapshot_date as m,
               (select arg_min(o.training_window_end, (-o.r2, o.training_window_end)) from offers o
                where o.training_window_end <= s.snapshot_date - interval 2 month) as best
        from (select distinct snapshot_date from live_scores) s where s.snapshot_date >= date '{DEPLOYMENT}'),
    step as (
        select m, best as live, best is not null as promoted, null::date as triggered_by, null::double as rmse,
               null::double as mae, null::double as r2, false as r2_b, false as rmse_b, false as mae_b, false as flag
        from runs where m = date '{DEPLOYMENT}'
        union all
        select m, live, promoted, triggered_by, rmse, mae, r2, r2_b, rmse_b, mae_b, {flag} as flag from (
            select n.*, o.r2 - n.r2 > 0.10 as r2_b, n.rmse / o.rmse > 1.25 as rmse_b, n.mae / o.mae > 1.25 as mae_b
            from (select r.m, x.rmse, x.mae, x.r2, case when p.flag then r.best else p.live end as live,
                         p.flag as promoted, case when p.flag then p.m end as triggered_by, p.rmse_b as p_rmse_b,
                         p.mae_b as p_mae_b
                  from step p join runs r on r.m = p.m + interval 1 month
                  join live_scores x on x.snapshot_date = r.m and x.version = p.live) n
            join offers o on o.training_window_end = n.live)
    )
    select m as snapshot_date, live as deployed_version, promoted, triggered_by, round(rmse, 4) as rmse,
           round(mae, 4) as mae, round(r2, 6) as r2, r2_b as r2_breach, rmse_b as rmse_breach,
           mae_b as mae_breach, flag as breach_flag
    from step"""


def timeline(spark, d, rule: str) -> DataFrame:
    replay = lifecycle.deployment_timeline(fitted(spark, d).live_scores, offers(spark, d), DEPLOYMENT, rule)
    return rounded(rounded(replay, 4, "rmse", "mae"), 6, "r2")


@query("r4_promotion_any_rule", timeline_sql("(r2_b or rmse_b or mae_b)"))
def _(spark, d):
    return timeline(spark, d, "any")


@query(
    "r4_promotion_persistent_rule", timeline_sql("(r2_b or (rmse_b and p_rmse_b) or (mae_b and p_mae_b))")
)
def _(spark, d):
    return timeline(spark, d, "persistent")


@query(
    "m14_as_of_scoring",
    f"""with t as ({timeline_sql("(r2_b or rmse_b or mae_b)").strip()})
        select r.store_nbr, r.family, r.snapshot_date, t.deployed_version as training_window_end, round(
               intercept{"".join(f' + k{i} * coalesce("{c}", 0)::double' for i, c in enumerate(schemas.RIDGE_FEATURES))}, 1
               ) as predicted_sales
        from t join feat r on r.snapshot_date = t.snapshot_date join ridge_models m on m.version = t.deployed_version""",
)
def _(spark, d):
    """Every month from the first deployment on, scored by the model that was live then."""
    found, g = fitted(spark, d), gold(spark, d)
    replay = lifecycle.deployment_timeline(found.live_scores, offers(spark, d), DEPLOYMENT, "any")
    months = F.col("snapshot_date").between(F.lit(DEPLOYMENT).cast("date"), replay.agg(F.max("snapshot_date")).scalar())
    features = clean.fill_numbers(g.features.where(months), schemas.RIDGE_FEATURES)
    return rounded(
        sliding.as_of_predictions(features, found.models, replay, schemas.RIDGE_FEATURES), 1, schemas.PREDICTION
    )


EVENTS_SQL = f"""
    with t as ({timeline_sql("(r2_b or rmse_b or mae_b)").strip()})
    select strftime(t.deployed_version, '%Y-%m-%d') as promoted_model, round(o.r2, 6) as oot_r2, t.triggered_by,
           'monitoring_breach' as reason
    from t join (select * from candidate_scores where split = 'oot') o on o.training_window_end = t.deployed_version
    where t.promoted and t.triggered_by is not null"""


@query("r5_promotion_events", EVENTS_SQL)
def _(spark, d):
    offered = offers(spark, d)
    replay = lifecycle.deployment_timeline(fitted(spark, d).live_scores, offered, DEPLOYMENT, "any")
    return rounded(lifecycle.promotion_events(replay, offered), 6, "oot_r2")


@query("u5_event_log", EVENTS_SQL)
def _(spark, d):
    """Events appended to a log in two runs, split at a month."""
    offered = offers(spark, d)
    replay = lifecycle.deployment_timeline(fitted(spark, d).live_scores, offered, DEPLOYMENT, "any")
    events = written(lifecycle.promotion_events(replay, offered), "events")
    path = new_table_path(spark, "promotion_log")
    early = F.col("triggered_by") < F.lit(ANCHOR).cast("date")
    files.append_events(events.where(early), path)
    files.append_events(events.where(~early), path)
    return rounded(files.read_table(spark, path, events.schema), 6, "oot_r2")
