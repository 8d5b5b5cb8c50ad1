"""Registered queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.calendar import join_calendar
from shelfcast.sources import schemas

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Months the example data is run with: first deployment, the candidate live at that time, one report
# month, and the month before the data begins.
DEPLOYMENT = "1997-06-01"
REFERENCE = "1997-04-01"
MONTH = "1997-09-01"
ANCHOR = "1999-06-01"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return f

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Sums of inexact doubles differ in the last bits between engines; compare them rounded."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def rounded_by_month(stored: DataFrame, digits: int, *columns: str) -> DataFrame:
    """``rounded`` for columns of a stored table that a whole month shares: once a month, since rounding a row is slow."""
    months = rounded(stored.select("snapshot_date", *columns).distinct(), digits, *columns)
    return join_calendar(stored.drop(*columns), months, how="inner").select(*[F.col(f"`{c}`") for c in stored.columns])


def quoted(columns: list[str], prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{c}"' for c in columns)


def _count_if(column: str, value: str, suffix: str) -> str:
    return f"count(*) filter (where {column} = '{value}') as \"num_holidays_{suffix}_{value}\""


_HOLIDAY_COUNTS = ",\n".join(
    [_count_if("type", v, "type") for v in schemas.HOLIDAY_TYPE_VALUES]
    + [_count_if("locale", v, "locale") for v in schemas.HOLIDAY_LOCALE_VALUES]
)

METRICS_SQL = """sqrt(avg((y - p) * (y - p))) as rmse, avg(abs(y - p)) as mae,
               1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) as r2"""


def moments_sql(p: int) -> str:
    """Moments of y and x0, x1, ..."""
    means = [f"avg(x{i}) as m{i}" for i in range(p)] + [f"covar_pop(x{i}, y) as b{i}" for i in range(p)]
    pairs = [f"covar_pop(x{i}, x{j}) as c{i}_{j}" for i in range(p) for j in range(i, p)]
    return ", ".join(["count(*) as n_rows", "avg(y) as my", "var_pop(y) as vy", *means, *pairs])


def ridge_sql(source: str, keys: str, p: int, penalty: float = schemas.RIDGE_PENALTY) -> str:
    """``keys, n_rows, intercept, k0, k1, ...`` by Gauss-Jordan elimination, a nested select for each column."""

    def entry(i: int, j: int) -> str:
        own = f"{int(i == j)}" + (f" + case when sy > 0 then {penalty} / sy else 0 end" if i == j else "")
        cross = f"c{min(i, j)}_{max(i, j)} / (s{i} * s{j})"
        return f"case when s{i} > 0 and s{j} > 0 and {i} <> {j} then {cross} else {own} end as a{i}_{j}"

    every = range(p)
    roots = ", ".join(f"sqrt(c{i}_{i}) as s{i}" for i in every)
    at = f"(select *, {roots}, sqrt(vy) as sy from {source})"
    right = ", ".join(f"case when s{i} > 0 and sy > 0 then b{i} / (s{i} * sy) else 0 end as t{i}" for i in every)
    at = f"(select *, {', '.join(entry(i, j) for i in every for j in every)}, {right} from {at})"
    for k in every:
        others = [i for i in every if i != k]
        cells = [f"a{i}_{j} - a{i}_{k} / a{k}_{k} * a{k}_{j} as a{i}_{j}" for i in others for j in every if j > k]
        cells += [f"t{i} - a{i}_{k} / a{k}_{k} * t{k} as t{i}" for i in others]
        at = f"(select * replace ({', '.join(cells)}) from {at})" if cells else at
    slopes = ", ".join(f"case when s{i} > 0 then t{i} / a{i}_{i} * sy / s{i} else 0 end as k{i}" for i in every)
    shift = "".join(f" - k{i} * m{i}" for i in every)
    names = ", ".join(f"k{i}" for i in every)
    return f"select {keys}, n_rows, my{shift} as intercept, {names} from (select *, {slopes} from {at})"


VIEWS: dict[str, str] = {
    "daily_sales": """
        select l_orderkey || '-' || l_linenumber as id, l_shipdate::date as date, l_suppkey::varchar as store_nbr,
               p_type as family, (l_extendedprice * (1 - l_discount))::float as sales,
               (l_discount >= 0.05)::int as onpromotion
        from lineitem left join part on l_partkey = p_partkey""",
    "daily_transactions": """
        select l_shipdate::date as date, l_suppkey::varchar as store_nbr,
               count(distinct l_orderkey)::int as transactions
        from lineitem group by all""",
    "oil_prices": """
        select o_orderdate::date as date,
               case when day(o_orderdate) % 5 = 0 or date_trunc('month', o_orderdate) = date '1997-02-01' then null
                    else avg(o_totalprice) / 1000 end::float as dcoilwtico
        from orders group by o_orderdate""",
    "holidays_events": """
        select o_orderdate::date as date,
               ['Holiday','Event','Additional','Transfer','Bridge','Work Day'][1 + o_orderkey % 6] as type,
               case o_orderstatus when 'F' then 'National' when 'O' then 'Regional' else 'Local' end as locale,
               n_name as locale_name, o_orderpriority as description,
               ['True','False','yes','0',null][1 + o_orderkey % 5] as transferred
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "oil_silver": """
        select o.date, coalesce(o.dcoilwtico::double, m.mean_price)::float as dcoilwtico,
               date_trunc('month', o.date)::date as snapshot_date
        from oil_prices o left join (
            select date_trunc('month', date) as month, avg(dcoilwtico) as mean_price from oil_prices group by 1
        ) m on date_trunc('month', o.date) = m.month""",
    "sales_m": """
        select date_trunc('month', date)::date as snapshot_date, store_nbr, family, sum(sales) as sales,
               sum(onpromotion::float) as onpromotion_sum, avg(onpromotion::float) as onpromotion_avg
        from daily_sales group by all""",
    "txn_m": """
        select date_trunc('month', date)::date as snapshot_date, store_nbr, sum(transactions)::bigint as transactions
        from daily_transactions group by all""",
    "oil_m": """
        select snapshot_date, avg(dcoilwtico) as avg_dcoilwtico from oil_silver group by all""",
    "hol_m": f"""
        select date_trunc('month', date)::date as snapshot_date, count(*) as num_holidays_total,
               sum(case when lower(transferred) in ('true','1','t','yes','y') then 1 else 0 end)::bigint
                   as num_transferred,
               {_HOLIDAY_COUNTS}
        from holidays_events group by 1""",
    "hol": "select a.*, "
    + ", ".join(f'b."{c}" as "{c}_NM"' for c in schemas.HOLIDAY_COLUMNS)
    + " from hol_m a left join hol_m b on b.snapshot_date = a.snapshot_date + interval 1 month",
    "sales_f": """
        select a.snapshot_date, a.store_nbr, a.family, any_value(a.sales) as "sales_LM",
               avg(b.sales) as "AVG_sales_L3M", sum(b.sales) as "SUM_sales_L3M",
               any_value(a.onpromotion_sum) as "onpromotion_LM", avg(b.onpromotion_sum) as "AVG_onpromotion_L3M",
               sum(b.onpromotion_sum) as "SUM_onpromotion_L3M"
        from sales_m a join sales_m b on a.store_nbr = b.store_nbr and a.family = b.family
             and b.snapshot_date between a.snapshot_date - interval 2 month and a.snapshot_date
        group by a.snapshot_date, a.store_nbr, a.family""",
    "txn_f": """
        select a.snapshot_date, a.store_nbr, any_value(a.transactions) as "transactions_LM",
               avg(b.transactions) as "AVG_transactions_L3M", sum(b.transactions)::bigint as "SUM_transactions_L3M"
        from txn_m a join txn_m b on a.store_nbr = b.store_nbr
             and b.snapshot_date between a.snapshot_date - interval 2 month and a.snapshot_date
        group by a.snapshot_date, a.store_nbr""",
    "oil_f": """
        select a.snapshot_date, any_value(a.avg_dcoilwtico) as "AVG_dcoilwtico_LM",
               avg(b.avg_dcoilwtico) as "AVG_dcoilwtico_L3M", sum(b.avg_dcoilwtico) as "SUM_dcoilwtico_L3M"
        from oil_m a join oil_m b
             on b.snapshot_date between a.snapshot_date - interval 2 month and a.snapshot_date
        group by a.snapshot_date""",
    "sales_months": "select distinct snapshot_date from sales_m",
    "ready": """
        select a.snapshot_date from sales_months a
        where (select count(*) from sales_months b
               where b.snapshot_date between a.snapshot_date - interval 2 month and a.snapshot_date) = 3""",
    "feat": f"""
        select snapshot_date, store_nbr, family, {quoted(schemas.NUMERIC_FEATURES)}
        from sales_f join ready using (snapshot_date)
             left join txn_f using (snapshot_date, store_nbr)
             left join oil_f using (snapshot_date)
             left join hol using (snapshot_date)""",
    "lab": """
        select snapshot_date, store_nbr, family, sales as label_next_month_sales
        from sales_m join ready using (snapshot_date)""",
    "aligned": """
        select f.*, l.label_next_month_sales
        from feat f join lab l on l.snapshot_date = f.snapshot_date + interval 1 month
             and l.store_nbr = f.store_nbr and l.family = f.family""",
    "pred": 'select store_nbr, family, snapshot_date, "sales_LM" as predicted_sales from feat',
    "scored": """
        select l.snapshot_date, l.store_nbr, l.family, l.label_next_month_sales as y, p.predicted_sales as p
        from lab l join pred p on l.snapshot_date = p.snapshot_date + interval 1 month
             and l.store_nbr = p.store_nbr and l.family = p.family""",
    "scores": """
        select snapshot_date, count(*) as n_rows, sqrt(avg((y - p) * (y - p))) as rmse, avg(abs(y - p)) as mae,
               1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) as r2
        from scored group by all""",
    "month_table": """
        select unnest(generate_series(date '1994-01-01', date '2003-01-01', interval 1 month))::date as m""",
    "trainable": """
        select t.m as run_month from month_table t
        where (select count(*) from (select distinct snapshot_date from feat) f
               where f.snapshot_date between t.m - interval 24 month and t.m - interval 1 month) = 24
          and (select count(*) from (select distinct snapshot_date from lab) l
               where l.snapshot_date between t.m - interval 23 month and t.m) = 24""",
    "versions": "select (run_month - interval 1 month)::date as training_window_end from trainable",
    "ridge_rows": f"""
        select snapshot_date as fm, store_nbr, family, label_next_month_sales as y,
               {", ".join(f'coalesce("{c}", 0)::double as x{i}' for i, c in enumerate(schemas.RIDGE_FEATURES))}
        from aligned""",
    "ridge_moments": f"""
        select v.training_window_end as version, {moments_sql(len(schemas.RIDGE_FEATURES))}
        from versions v join ridge_rows r
             on r.fm between v.training_window_end - interval 23 month and v.training_window_end - interval 6 month
        group by 1""",
    "ridge_models": ridge_sql("ridge_moments", "version", len(schemas.RIDGE_FEATURES)),
    "ridge_scored": f"""
        select m.version, r.fm, r.store_nbr, r.family, r.y,
               intercept{"".join(f" + k{i} * x{i}" for i in range(len(schemas.RIDGE_FEATURES)))} as p
        from ridge_models m join ridge_rows r on r.fm > m.version - interval 6 month
             and (r.fm <= m.version or r.fm >= m.version + interval 2 month)""",
    "candidate_scores": f"""
        select version as training_window_end,
               case when fm > version - interval 2 month then 'oot' when fm > version - interval 4 month then 'test'
                    else 'val' end as split,
               {METRICS_SQL}, count(*) as rows, min(fm) as start, max(fm) as "end"
        from ridge_scored where fm <= version group by all
        union all
        select v.training_window_end, 'train', null, null, null, count(*), min(fm), max(fm)
        from versions v join ridge_rows r
             on r.fm between v.training_window_end - interval 23 month and v.training_window_end - interval 6 month
        group by 1""",
    "live_scores": f"""
        select version, (fm + interval 1 month)::date as snapshot_date, {METRICS_SQL}
        from ridge_scored where fm > version group by all""",
    "daily_pairs": """
        select store_nbr, family, date, sum(sales) as sales, count(sales) as n_sales,
               sum(onpromotion)::bigint as onpromotion
        from daily_sales group by all""",
    "weekly": """
        select store_nbr, family, date_trunc('week', date)::date as week_start, sum(sales) as sales_week
        from daily_sales group by all""",
    "national": "select distinct date from holidays_events where locale = 'National'",
    "weekly_r": """
        select store_nbr, family, date_trunc('week', d.date)::date as week_start, sum(sales) as weekly_sales_sum,
               avg(sales) as weekly_sales_avg, count(distinct d.date) as days_in_week,
               max(case when n.date is null then 0 else 1 end) as any_holiday
        from daily_sales d left join national n on d.date = n.date
        group by 1, 2, 3""",
    "weekly_t": """
        select *, coalesce(avg(weekly_sales_avg) over two, 0) as avg_sales_14d,
               coalesce(avg(weekly_sales_avg) over three, 0) as avg_sales_28d,
               coalesce(sum(weekly_sales_sum) over two, 0) as sum_sales_14d,
               coalesce(sum(weekly_sales_sum) over three, 0) as sum_sales_28d
        from weekly_r
        window two as (partition by store_nbr, family order by week_start rows between 2 preceding and 1 preceding),
             three as (partition by store_nbr, family order by week_start rows between 3 preceding and 1 preceding)""",
    "weekly_l": """
        select *, lag(sales_week) over w as sales_lag_1,
               case when count(*) over four = 4 then avg(sales_week) over four end as sales_avg_4,
               week(week_start)::int as weekofyear
        from weekly
        window w as (partition by store_nbr, family order by week_start),
             four as (partition by store_nbr, family order by week_start rows between 4 preceding and 1 preceding)""",
    "starts": """
        select store_nbr, family, min(date_trunc('month', date))::date as first_active_month
        from daily_sales where sales > 0 group by 1, 2""",
    "starts_m": """
        select first_active_month, count(*) as num_new_pairs from starts
        where first_active_month > date '1995-01-01' group by 1""",
    "long_values": " union all ".join(
        f"select '{v}' as variable, snapshot_date, \"{v}\"::double as value from feat where \"{v}\" is not null"
        for v in schemas.DRIFT_VARIABLES
    ),
    "ref_values": f"select variable, value from long_values where snapshot_date = date '{REFERENCE}'",
    "ref_ranked": """
        select variable, value, row_number() over (partition by variable order by value) - 1 as rk,
               count(*) over (partition by variable) as n
        from ref_values""",
    "quantiles": """
        select variable, i, case when t >= 0.5 then hi - (hi - lo) * (1 - t) else lo + (hi - lo) * t end as q
        from (
            select k.variable, k.i, k.pos - floor(k.pos) as t, a.value as lo, b.value as hi
            from (select variable, i, (case when i = 10 then 1::double else i * 0.1::double end) * (n - 1) as pos
                  from (select distinct variable, n from ref_ranked), (select unnest(range(11)) as i)) k
            join ref_ranked a on a.variable = k.variable and a.rk = floor(k.pos)
            join ref_ranked b on b.variable = k.variable and b.rk = ceil(k.pos))""",
    "edges": """
        select variable, row_number() over (partition by variable order by edge) - 1 as i, edge from (
            select distinct q.variable, q.q as edge from quantiles q
            where (select count(distinct r.q) from quantiles r where r.variable = q.variable) > 1
            union all
            select variable, min(q) - 1e-9 from quantiles group by 1 having count(distinct q) = 1
            union all
            select variable, max(q) + 1e-9 from quantiles group by 1 having count(distinct q) = 1)""",
    "bins": """
        select a.variable, a.i as bin, a.edge as lower, b.edge as upper,
               b.i = max(b.i) over (partition by a.variable) as is_last
        from edges a join edges b on a.variable = b.variable and b.i = a.i + 1""",
    "counts": """
        select g.variable, g.snapshot_date, g.bin, g.lower, count(v.value) as n
        from (select b.*, m.snapshot_date from bins b, (select distinct snapshot_date from feat) m) g
        left join long_values v on v.variable = g.variable and v.snapshot_date = g.snapshot_date
             and v.value >= g.lower and (v.value < g.upper or (g.is_last and v.value <= g.upper))
        group by all""",
    "shares": """
        select *, (n + 1e-6::double) / sum(n + 1e-6::double) over (partition by variable, snapshot_date) as share
        from counts""",
    "compared": f"""
        select c.variable, c.snapshot_date, c.bin, c.lower, r.n as ref_n, c.n as cur_n, r.share as ref_share,
               c.share as cur_share
        from shares c join shares r on r.variable = c.variable and r.bin = c.bin
             and r.snapshot_date = date '{REFERENCE}'""",
    "drift": """
        select variable, snapshot_date, sum((ref_share - cur_share) * ln(ref_share / cur_share)) as psi,
               sum(abs(ref_share - cur_share)) as csi
        from compared group by all""",
}


def _used(sql: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"(?<![\w.'\"]){v}(?![\w'\"])", sql)]


def with_views(sql: str) -> str:
    """The query with the views it needs, directly or not, spelled out in front."""
    needed: list[str] = []

    def visit(text: str, above: tuple[str, ...]) -> None:
        for v in _used(text):
            if v in above:
                continue
            visit(VIEWS[v], (*above, v))
            if v not in needed:
                needed.append(v)

    visit(sql, ())
    if not needed:
        return sql.strip()
    parts = ",\n".join(f"{v} as ({VIEWS[v].strip()})" for v in needed)
    body = sql.strip()
    if body.startswith("with "):
        own = body.removeprefix("with ").removeprefix("recursive ")
        recursive = "recursive " if body.startswith("with recursive ") else ""
        return f"with {recursive}{parts},\n{own}"
    return f"with {parts}\n{body}"
