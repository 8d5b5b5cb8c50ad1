"""Registered queries: scans and sinks, cleaning, projections and filters, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions import dates, text
from shelfcast.operators import clean, holidays, profile, rollup, weekly
from shelfcast.plans import monthly
from shelfcast.plans.gold import gold
from shelfcast.plans.registry import MONTH, query, quoted, rounded
from shelfcast.session import new_table_path
from shelfcast.sources import files, retail, schemas

OIL_FEATURES = ["AVG_dcoilwtico_LM", "AVG_dcoilwtico_L3M", "SUM_dcoilwtico_L3M"]
OIL_SQL = ", ".join(f'round("{c}", 6) as "{c}"' for c in OIL_FEATURES)
FEATURE_SQL = (
    "snapshot_date, store_nbr, family, "
    + quoted([c for c in schemas.NUMERIC_FEATURES if c not in OIL_FEATURES])
    + ", "
    + OIL_SQL
)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# -- scans and sinks ---------------------------------------------------------


@query("s1_csv_scan", "select * from daily_sales")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = new_table_path(spark, "sales_csv")
    sales = retail.daily_sales(spark, d)
    files.write_csv(sales, path)
    return files.read_csv(spark, path, sales.schema)


def five_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "daily_sales": retail.daily_sales(spark, d),
        "daily_transactions": retail.daily_transactions(spark, d),
        "oil_prices": retail.oil_prices(spark, d),
        "holidays_events": retail.holidays_events(spark, d),
        "stores": retail.table(spark, d, "supplier"),
    }


@query(
    "s2_profile_scan",
    """select 'daily_sales' as table_name, count(*) as n_rows from daily_sales
       union all select 'daily_transactions', count(*) from daily_transactions
       union all select 'oil_prices', count(*) from oil_prices
       union all select 'holidays_events', count(*) from holidays_events
       union all select 'stores', count(*) from supplier""",
)
def _(spark, d):
    scanned = {}
    for name, t in five_tables(spark, d).items():
        path = new_table_path(spark, f"{name}_csv")
        files.write_csv(t, path)
        scanned[name] = files.read_csv(spark, path, t.schema)
    return profile.row_counts(scanned)


def stored_sales(spark: SparkSession, d: str) -> str:
    path = new_table_path(spark, "daily_sales")
    files.write_months(clean.silver(retail.daily_sales(spark, d), schemas.SALES_TYPES, schemas.SALES_KEYS), path)
    return path


SILVER_SALES_SQL = """id, date, store_nbr, family, sales, onpromotion, year(date)::int as year,
       month(date)::int as month, date_trunc('month', date)::date as snapshot_date"""


@query(
    "s3_month_scan",
    f"select {SILVER_SALES_SQL} from daily_sales where date_trunc('month', date) = date '{MONTH}'",
)
def _(spark, d):
    return files.read_month(spark, stored_sales(spark, d), MONTH)


@query(
    "s4_multi_month_scan",
    f"""select {SILVER_SALES_SQL} from daily_sales
        where date_trunc('month', date) between date '{MONTH}' - interval 2 month and date '{MONTH}'""",
)
def _(spark, d):
    return files.read_months(spark, stored_sales(spark, d), "1997-07-01", MONTH)


@query("s5_snapshot_discovery", "select distinct snapshot_date from sales_m")
def _(spark, d):
    months = files.snapshots(files.read_table(spark, stored_sales(spark, d)))
    tags = months.select(dates.snapshot_tag("snapshot_date").alias("tag")).unionByName(
        months.select(F.date_format("snapshot_date", "yyyy-MM-dd").alias("tag"))
    )
    return files.snapshots_from_tags(tags, "tag")


@query("s6_month_sink", f"select {SILVER_SALES_SQL} from daily_sales")
def _(spark, d):
    path = stored_sales(spark, d)
    again = clean.silver(retail.daily_sales(spark, d), schemas.SALES_TYPES, schemas.SALES_KEYS)
    files.write_months(again.where(F.col("snapshot_date") == F.lit(MONTH).cast("date")), path)
    return files.read_table(spark, path)


@query("s7_reference_sink", "select * from hol")
def _(spark, d):
    path = new_table_path(spark, "holiday_features")
    reference = holidays.with_next_month(holidays.monthly_holidays(retail.holidays_events(spark, d)))
    files.write_reference(reference, path)
    return files.read_table(spark, path)


@query(
    "s8_pair_sink",
    """select store_nbr, lower(family) as family_key, count(*) as n_rows, sum(sales) as sales
       from daily_sales group by all""",
)
def _(spark, d):
    path = new_table_path(spark, "sales_by_pair")
    keyed = retail.daily_sales(spark, d).withColumn("family_key", text.family_key("family"))
    files.write_by_pair(keyed, path, ["store_nbr", "family_key"])
    read = spark.read.schema(keyed.schema).parquet(path)
    return read.groupBy("store_nbr", "family_key").agg(F.count("*").alias("n_rows"), F.sum("sales").alias("sales"))


@query("s9_csv_sink", "select * from pred")
def _(spark, d):
    path = new_table_path(spark, "predictions_csv")
    predictions = gold(spark, d).predictions
    files.write_csv(predictions, path)
    return files.read_csv(spark, path, predictions.schema)


# -- cleaning ----------------------------------------------------------------


@query("c1_parse_date", "select id, date from daily_sales")
def _(spark, d):
    raw = as_text(retail.daily_sales(spark, d).select("id", "date"))
    return raw.select("id", dates.tolerant_date("date").alias("date"))


@query(
    "c2_month_columns",
    """select date, store_nbr, transactions, date_trunc('month', date)::date as snapshot_date,
              year(date)::int as year, month(date)::int as month from daily_transactions""",
)
def _(spark, d):
    return clean.add_month_columns(retail.daily_transactions(spark, d))


@query(
    "c3_configured_cast",
    """select try_cast(n_name as int) as store_nbr, o_orderdate::date as date,
              case when o_orderstatus = 'P' then null else o_totalprice::float end as sales,
              try_cast(o_orderpriority as date) as snapshot_date, c_mktsegment as family
       from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
)
def _(spark, d):
    """Text columns with unusable values: words for numbers and dates become null, not errors."""
    orders = retail.table(spark, d, "orders")
    customer = retail.table(spark, d, "customer")
    nation = retail.table(spark, d, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    raw = joined.select(
        F.col("n_name").alias("store_nbr"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        price.alias("sales"),
        F.col("o_orderpriority").alias("snapshot_date"),
        F.col("c_mktsegment").alias("family"),
    )
    types = {**schemas.SALES_TYPES, "store_nbr": "int"}
    return clean.cast_columns(raw, types)


@query(
    "c4_boolean_words",
    """select date, type, locale, transferred,
              (lower(coalesce(transferred, '')) in ('true','1','t','yes','y'))::int as flag from holidays_events""",
)
def _(spark, d):
    return retail.holidays_events(spark, d).select(
        "date", "type", "locale", "transferred", text.truth_flag("transferred").alias("flag")
    )


@query("c5_drop_null_keys", "select date, dcoilwtico from oil_prices where date is not null and dcoilwtico is not null")
def _(spark, d):
    return clean.drop_null_keys(retail.oil_prices(spark, d), ["date", "dcoilwtico"])


@query(
    "c6_required_columns",
    "select date, store_nbr, transactions from daily_transactions",
)
def _(spark, d):
    return clean.require_columns(retail.daily_transactions(spark, d), ["date", "store_nbr", "transactions"])


@query("c7_impute_month_mean", "select * from oil_silver")
def _(spark, d):
    silver = clean.silver_oil(retail.oil_prices(spark, d), schemas.OIL_TYPES, schemas.OIL_KEYS)
    return silver.select("date", "dcoilwtico", "snapshot_date")


@query(
    "c8_fill_numbers",
    "select snapshot_date, store_nbr, family, "
    + ", ".join(
        (f'round(coalesce("{c}", 0), 6)' if c in OIL_FEATURES else f'coalesce("{c}", 0)') + f' as "{c}"'
        for c in schemas.NUMERIC_FEATURES
    )
    + " from feat",
)
def _(spark, d):
    filled = clean.fill_numbers(gold(spark, d).features, schemas.NUMERIC_FEATURES)
    return rounded(filled, 6, *OIL_FEATURES)


@query(
    "c9_fill_categories",
    """select date, type, coalesce(transferred, 'Unknown') as transferred from holidays_events""",
)
def _(spark, d):
    return clean.fill_categories(
        retail.holidays_events(spark, d).select("date", "type", "transferred"), ["type", "transferred"]
    )


@query(
    "c11_key_text",
    """select name, lower(replace(replace(name, '/', ''), ' ', '')) as key, count(*) as n
       from (select family as name from daily_sales union all select type from holidays_events
             union all select description from holidays_events) group by all""",
)
def _(spark, d):
    events = retail.holidays_events(spark, d)
    names = (
        retail.daily_sales(spark, d)
        .select(F.col("family").alias("name"))
        .unionByName(events.select(F.col("type").alias("name")))
        .unionByName(events.select(F.col("description").alias("name")))
    )
    return names.groupBy("name", text.family_key("name").alias("key")).agg(F.count("*").alias("n"))


@query(
    "c12_tolerant_date",
    """select o_orderkey, case when day(o_orderdate) = 13 then null else o_orderdate::date end as day from orders""",
)
def _(spark, d):
    """Text dates where every thirteenth of a month has an impossible month."""
    raw = retail.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.dayofmonth("o_orderdate") == 13, "2015-13-01")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date_text"),
    )
    return raw.select("o_orderkey", dates.tolerant_date(clean.date_column(raw)).alias("day"))


# -- projections and filters -------------------------------------------------


@query(
    "f1_month_range",
    f"select * from daily_sales where date between date '{MONTH}' and date '{MONTH}' + interval 1 month - interval 1 day",
)
def _(spark, d):
    first = F.lit(MONTH).cast("date")
    return retail.daily_sales(spark, d).where(F.col("date").between(first, F.last_day(first)))


@query("f2_exact_day", "select * from daily_sales where date = date '1997-09-15'")
def _(spark, d):
    return retail.daily_sales(spark, d).where(F.col("date") == F.lit("1997-09-15").cast("date"))


@query(
    "f3_in_list",
    """select * from daily_sales where store_nbr in ('3', '7', '9') and family in ('PROMO', 'SMALL', 'LARGE')""",
)
def _(spark, d):
    return retail.daily_sales(spark, d).where(
        F.col("store_nbr").isin("3", "7", "9") & F.col("family").isin("PROMO", "SMALL", "LARGE")
    )


@query("f4_equality", "select date, type, locale_name from holidays_events where locale = 'National'")
def _(spark, d):
    return retail.holidays_events(spark, d).where(F.col("locale") == "National").select("date", "type", "locale_name")


@query("f5_active_sales", "select id, date, store_nbr, family, sales from daily_sales where sales > 0")
def _(spark, d):
    return retail.daily_sales(spark, d).where(F.col("sales") > 0).drop("onpromotion")


@query(
    "f6_positive_totals",
    """select store_nbr, date_trunc('month', date)::date as snapshot_date, sum(sales) as sales
       from daily_sales group by all having sum(sales) > 0""",
)
def _(spark, d):
    return rollup.active_months(retail.daily_sales(spark, d), ["store_nbr"])


@query(
    "f7_between_splits",
    """select store_nbr, family, week_start, sales_week,
              case when week_start between date '2001-10-22' and date '2001-11-04' then 'oot' else 'train_test' end
                  as split
       from weekly where week_start between date '2001-09-01' and date '2001-11-04'""",
)
def _(spark, d):
    weeks = rollup.weekly_sales(retail.daily_sales(spark, d))
    oot = F.col("week_start").between(F.lit("2001-10-22").cast("date"), F.lit("2001-11-04").cast("date"))
    either = F.col("week_start").between(F.lit("2001-09-01").cast("date"), F.lit("2001-11-04").cast("date"))
    return weeks.where(either).withColumn("split", F.when(oot, "oot").otherwise("train_test"))


@query("f8_single_month_features", f"select {FEATURE_SQL} from feat where snapshot_date = date '{MONTH}'")
def _(spark, d):
    return rounded(monthly.feature_store(monthly.clean_inputs(spark, d), MONTH), 6, *OIL_FEATURES)


@query("f9_late_starters", "select * from starts where first_active_month > date '1995-01-01'")
def _(spark, d):
    starts = rollup.first_active(retail.daily_sales(spark, d), rollup.PAIR)
    return rollup.late_starters(starts, "1995-01-01")


@query(
    "f10_months_without_value",
    """select date_trunc('month', date)::date as snapshot_date, count(dcoilwtico) as non_null_count
       from oil_prices group by 1 having count(dcoilwtico) = 0""",
)
def _(spark, d):
    return profile.months_without_value(retail.oil_prices(spark, d), "dcoilwtico")


@query("f11_constant_and_alias", f"select * from lab where snapshot_date = date '{MONTH}'")
def _(spark, d):
    return monthly.label_store(monthly.clean_inputs(spark, d), MONTH)


@query(
    "f12_present_columns",
    f"""select store_nbr, family, "sales_LM", num_holidays_total, 'no_such_feature' as missing from feat""",
)
def _(spark, d):
    wanted = ["store_nbr", "family", "sales_LM", "no_such_feature", "num_holidays_total"]
    present, missing = clean.select_present(gold(spark, d).features, wanted)
    return present.withColumn("missing", F.lit(",".join(missing)))


@query(
    "f13_numeric_columns",
    "select sales_week, sales_lag_1, sales_avg_4, weekofyear from (select * replace (round(sales_avg_4, 4) as sales_avg_4) from weekly_l)",
)
def _(spark, d):
    frame = weekly.lag_features(rollup.weekly_sales(retail.daily_sales(spark, d)))
    present, _ = clean.select_present(frame, clean.numeric_columns(frame))
    return rounded(present, 4, "sales_avg_4")


@query(
    "f14_pass_through",
    """select f.snapshot_date, f.store_nbr, f.family, m.sales as "sales_LM", m.onpromotion_sum as "onpromotion_LM",
              t.transactions as "transactions_LM", round(o.avg_dcoilwtico, 6) as "AVG_dcoilwtico_LM"
       from feat f join sales_m m using (snapshot_date, store_nbr, family)
            left join txn_m t on t.snapshot_date = f.snapshot_date and t.store_nbr = f.store_nbr
            left join oil_m o on o.snapshot_date = f.snapshot_date""",
)
def _(spark, d):
    features = monthly.feature_store(monthly.clean_inputs(spark, d))
    return rounded(
        features.select(
            "snapshot_date", "store_nbr", "family", "sales_LM", "onpromotion_LM", "transactions_LM", "AVG_dcoilwtico_LM"
        ),
        6,
        "AVG_dcoilwtico_LM",
    )


# -- scalar functions --------------------------------------------------------


@query(
    "x1_month_and_week",
    """select distinct date, date_trunc('month', date)::date as month_start, date_trunc('week', date)::date as week_start,
              year(date)::int as year, month(date)::int as month, (date + interval 1 month)::date as month_later,
              (date - interval 1 month)::date as month_before
       from daily_transactions""",
)
def _(spark, d):
    days = retail.daily_transactions(spark, d).select("date").distinct()
    return days.select(
        "date",
        dates.month_start("date").alias("month_start"),
        dates.week_start("date").alias("week_start"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        dates.shift_months("date", 1).alias("month_later"),
        dates.shift_months("date", -1).alias("month_before"),
    )


@query(
    "x2_date_offsets",
    """select distinct date, last_day(date) as month_end, (date - interval 5 day)::date as five_days_before,
              (date + interval 7 day)::date as next_week
       from daily_transactions""",
)
def _(spark, d):
    days = retail.daily_transactions(spark, d).select("date").distinct()
    return days.select(
        "date",
        dates.month_end("date").alias("month_end"),
        F.date_sub("date", 5).alias("five_days_before"),
        F.date_add("date", 7).alias("next_week"),
    )


@query(
    "x3_calendar_numbers",
    """select distinct date, (isodow(date) - 1)::int as day_of_week, month(date)::int as month,
              week(date)::int as weekofyear from daily_transactions""",
)
def _(spark, d):
    days = retail.daily_transactions(spark, d).select("date").distinct()
    return days.select(
        "date",
        dates.weekday_monday0("date").alias("day_of_week"),
        F.month("date").alias("month"),
        dates.iso_week("date").alias("weekofyear"),
    )


@query(
    "x4_year_month",
    "select strftime(date, '%Y-%m') as year_month, count(*) as n_rows from daily_sales group by 1",
)
def _(spark, d):
    return (
        retail.daily_sales(spark, d).groupBy(F.date_format("date", "yyyy-MM").alias("year_month")).agg(
            F.count("*").alias("n_rows")
        )
    )


@query(
    "x5_conditionals",
    """select date, case when dcoilwtico is null then 0 else 1 end as has_price, coalesce(dcoilwtico, 0::float) as price,
              dayname(date) in ('Saturday', 'Sunday') as weekend from oil_prices""",
)
def _(spark, d):
    return retail.oil_prices(spark, d).select(
        "date",
        F.when(F.col("dcoilwtico").isNotNull(), 1).otherwise(0).alias("has_price"),
        F.coalesce("dcoilwtico", F.lit(0).cast("float")).alias("price"),
        F.date_format("date", "EEEE").isin("Saturday", "Sunday").alias("weekend"),
    )


@query(
    "x6_text_parts",
    """select distinct lower(type) as lowered, replace(type, ' ', '_') as replaced,
              split_part('silver_store' || locale || '_' || lower(type), '_', 2) as store_part
       from holidays_events""",
)
def _(spark, d):
    pairs = retail.holidays_events(spark, d).select("type", "locale").distinct()
    tag = F.concat(F.lit("silver_store"), F.col("locale"), F.lit("_"), F.lower("type"))
    return pairs.select(
        F.lower("type").alias("lowered"),
        F.regexp_replace("type", " ", "_").alias("replaced"),
        F.get(F.split(tag, "_"), F.lit(1)).alias("store_part"),
    ).distinct()


@query(
    "x7_try_cast",
    """select o_orderkey, try_cast(left(o_orderpriority, 1) as int) as level, try_cast(o_orderpriority as int) as bad,
              o_totalprice::float as price from orders""",
)
def _(spark, d):
    return retail.table(spark, d, "orders").select(
        "o_orderkey",
        F.left("o_orderpriority", F.lit(1)).try_cast("int").alias("level"),
        F.col("o_orderpriority").try_cast("int").alias("bad"),
        F.col("o_totalprice").cast("float").alias("price"),
    )


@query(
    "x8_math",
    """select snapshot_date, store_nbr, family, round(ln(sales), 6) as ln_sales,
              round(sqrt(sales), 6) as sqrt_sales, abs(onpromotion_sum - 3) as promo_distance,
              round(onpromotion_sum / sales, 6) as ratio
       from sales_m where sales > 0""",
)
def _(spark, d):
    monthly_sales = rollup.monthly_sales(retail.daily_sales(spark, d)).where(F.col("sales") > 0)
    return monthly_sales.select(
        "snapshot_date",
        "store_nbr",
        "family",
        F.round(F.ln("sales"), 6).alias("ln_sales"),
        F.round(F.sqrt("sales"), 6).alias("sqrt_sales"),
        F.abs(F.col("onpromotion_sum") - 3).alias("promo_distance"),
        F.round(F.col("onpromotion_sum") / F.col("sales"), 6).alias("ratio"),
    )
