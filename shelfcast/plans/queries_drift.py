"""Registered queries: drift of the monitored features and of predictions.

The reference is the month of the model live at first deployment; every month of the feature store is
compared with it in one plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import join_calendar
from shelfcast.operators import drift
from shelfcast.plans import drift_store
from shelfcast.plans.gold import gold
from shelfcast.plans.jobs import Layout
from shelfcast.plans.registry import REFERENCE, query, rounded
from shelfcast.session import new_table_path
from shelfcast.sources.schemas import DRIFT_VARIABLES


def values(spark, d) -> tuple[DataFrame, DataFrame]:
    """Reference month and all months as long tables."""
    every = drift.long_values(gold(spark, d).features, DRIFT_VARIABLES)
    return drift.month_of(every, REFERENCE), every


def comparison(spark, d, method: str = "quantile") -> DataFrame:
    return drift.binned_comparison(gold(spark, d).features, REFERENCE, DRIFT_VARIABLES, method=method)


def edge_rows(edges: DataFrame) -> DataFrame:
    exploded = edges.select("variable", F.posexplode("edges").alias("i", "edge"))
    return rounded(exploded, 6, "edge")


@query("d1_quantile_edges", "select variable, i::int as i, round(edge, 6) as edge from edges")
def _(spark, d):
    ref, _ = values(spark, d)
    return edge_rows(drift.bin_edges(ref, DRIFT_VARIABLES))


UNIFORM = """
    select variable, i::int as i, case when i = 10 then hi else lo + i * ((hi - lo) / 10) end as edge
    from (select variable, case when min(value) = max(value) then min(value) - 1e-9 else min(value) end as lo,
                 case when min(value) = max(value) then max(value) + 1e-9 else max(value) end as hi
          from ref_values group by 1), (select unnest(range(11)) as i)"""


@query("d2_uniform_edges", f"select variable, i, round(edge, 6) as edge from ({UNIFORM})")
def _(spark, d):
    ref, _ = values(spark, d)
    return edge_rows(drift.bin_edges(ref, DRIFT_VARIABLES, method="uniform"))


@query(
    "d3_smoothed_shares",
    """select variable, snapshot_date, bin::int as bin, cur_n, round(cur_share, 9) as cur_share, ref_n,
              round(ref_share, 9) as ref_share from compared""",
)
def _(spark, d):
    return rounded(comparison(spark, d).drop("lower"), 9, "cur_share", "ref_share")


@query("d4_psi", "select variable, snapshot_date, round(psi, 6) as psi from drift")
def _(spark, d):
    return comparison(spark, d).groupBy("variable", "snapshot_date").agg(F.round(drift.psi(), 6).alias("psi"))


@query("d5_csi", "select variable, snapshot_date, round(csi, 6) as csi from drift")
def _(spark, d):
    return comparison(spark, d).groupBy("variable", "snapshot_date").agg(F.round(drift.csi(), 6).alias("csi"))


@query(
    "d5_csi_uniform_bins",
    f"""with e as (select variable, i, edge from ({UNIFORM})),
         b as (select a.variable, a.i as bin, a.edge as lower, c.edge as upper from e a
               join e c on a.variable = c.variable and c.i = a.i + 1),
         h as (select g.variable, g.snapshot_date, g.bin, count(v.value) as n
               from (select b.*, m.snapshot_date from b, (select distinct snapshot_date from feat) m) g
               left join long_values v on v.variable = g.variable and v.snapshot_date = g.snapshot_date
                    and v.value >= g.lower and (v.value < g.upper or (g.bin = 9 and v.value <= g.upper))
               group by all),
         s as (select *, (n + 1e-6::double) / sum(n + 1e-6::double) over (partition by variable, snapshot_date) as share
               from h)
        select c.variable, c.snapshot_date, round(sum(abs(r.share - c.share)), 6) as csi
        from s c join s r on r.variable = c.variable and r.bin = c.bin and r.snapshot_date = date '{REFERENCE}'
        group by all""",
)
def _(spark, d):
    compared = comparison(spark, d, "uniform")
    return compared.groupBy("variable", "snapshot_date").agg(F.round(drift.csi(), 6).alias("csi"))


def _severity_sql(c: str) -> str:
    return f"case when abs({c}) < 0.10 then 'stable' when abs({c}) < 0.25 then 'moderate' else 'significant' end"


@query(
    "d6_severity",
    f"""select variable, snapshot_date, {_severity_sql('psi')} as psi_severity, {_severity_sql('csi')} as csi_severity
        from drift""",
)
def _(spark, d):
    scored = comparison(spark, d).groupBy("variable", "snapshot_date").agg(
        drift.psi().alias("psi"), drift.csi().alias("csi")
    )
    return scored.select(
        "variable",
        "snapshot_date",
        drift.severity(F.col("psi")).alias("psi_severity"),
        drift.severity(F.col("csi")).alias("csi_severity"),
    )


DRIFT_TABLE_SQL = f"""
    select variable, snapshot_date, round(psi, 6) as psi, {_severity_sql('psi')} as psi_severity, round(csi, 6) as csi,
           {_severity_sql('csi')} as csi_severity,
           case when abs(psi) >= 0.25 or abs(csi) >= 0.25 then 'significant'
                when abs(psi) >= 0.10 or abs(csi) >= 0.10 then 'moderate' else 'stable' end as severity
    from drift"""


@query("d7_drift_table", DRIFT_TABLE_SQL)
def _(spark, d):
    return drift.drift_table(comparison(spark, d))


@query("d7_stored_histograms", DRIFT_TABLE_SQL)
def _(spark, d):
    """The drift table from counts that are stored by reference and month."""
    at, features = Layout(raw=d, root=new_table_path(spark, "drift")), gold(spark, d).features
    drift_store.fix_edges(features, at, REFERENCE, DRIFT_VARIABLES)
    drift_store.count_months(features, at, REFERENCE)
    return drift.drift_table(drift_store.comparison(spark, at, REFERENCE))


PREDICTION_CSI_SQL = f"""with both_m as (select c.snapshot_date, r.predicted_sales as rv, c.predicted_sales as cv
                        from pred r join pred c on r.store_nbr = c.store_nbr and r.family = c.family
                        where r.snapshot_date = date '{REFERENCE}'),
         rr as (select *, row_number() over (partition by snapshot_date order by rv) - 1 as rk,
                       count(*) over (partition by snapshot_date) as n from both_m),
         k as (select m.snapshot_date, i, (case when i = 10 then 1::double else i * 0.1::double end) * (n - 1) as pos
               from (select distinct snapshot_date, n from rr) m, (select unnest(range(11)) as i)),
         q as (select k.snapshot_date, case when pos - floor(pos) >= 0.5
                      then b.rv - (b.rv - a.rv) * (1 - (pos - floor(pos)))
                      else a.rv + (b.rv - a.rv) * (pos - floor(pos)) end as q
               from k join rr a on a.snapshot_date = k.snapshot_date and a.rk = floor(pos)
                      join rr b on b.snapshot_date = k.snapshot_date and b.rk = ceil(pos)),
         e as (select snapshot_date, edge, row_number() over (partition by snapshot_date order by edge) as i from (
                   select distinct snapshot_date, q as edge from q
                   where snapshot_date in (select snapshot_date from q group by 1 having count(distinct q) > 1)
                   union all select snapshot_date, min(q) - 1e-9 from q group by 1 having count(distinct q) = 1
                   union all select snapshot_date, max(q) + 1e-9 from q group by 1 having count(distinct q) = 1)),
         b as (select x.snapshot_date, x.i, x.edge as lo, y.edge as hi,
                      y.i = max(y.i) over (partition by x.snapshot_date) as is_last
               from e x join e y on x.snapshot_date = y.snapshot_date and y.i = x.i + 1),
         h as (select b.snapshot_date, b.i,
                      count(*) filter (rv >= lo and (rv < hi or (is_last and rv <= hi))) as rn,
                      count(*) filter (cv >= lo and (cv < hi or (is_last and cv <= hi))) as cn
               from b join both_m on b.snapshot_date = both_m.snapshot_date group by all),
         s as (select snapshot_date, (rn + 1e-6::double) / sum(rn + 1e-6::double) over (partition by snapshot_date) as p,
                      (cn + 1e-6::double) / sum(cn + 1e-6::double) over (partition by snapshot_date) as c from h),
         t as (select snapshot_date, sum(abs(p - c)) as csi from s group by 1)
        select m.snapshot_date, round(csi, 6) as csi,
               case when csi is null then null else {_severity_sql('csi')} end as csi_severity
        from (select distinct snapshot_date from pred) m left join t on m.snapshot_date = t.snapshot_date"""


@query("d8_prediction_csi", PREDICTION_CSI_SQL)
def _(spark, d):
    return drift.prediction_drift(gold(spark, d).predictions, REFERENCE)


DISTINCT_SQL = f"""
    select c.variable, c.snapshot_date, c.n as cur_n, r.n as ref_n from
        (select variable, snapshot_date, count(distinct value) as n from long_values group by all) c
        join (select variable, count(distinct value) as n from ref_values group by all) r on r.variable = c.variable"""


@query(
    "d9_chart_histograms",
    f"""select c.variable, c.snapshot_date, c.bin::int as bin, round(c.lower, 6) as lower, c.ref_n, c.cur_n
        from compared c join ({DISTINCT_SQL}) k on k.variable = c.variable and k.snapshot_date = c.snapshot_date
        where k.cur_n > 10 or k.ref_n > 10""",
)
def _(spark, d):
    ref, every = values(spark, d)
    kinds = drift.chart_kinds(ref, every)
    chosen = kinds.where(F.col("kind") == "histogram").drop("kind")
    bars = join_calendar(comparison(spark, d), chosen, ["variable", "snapshot_date"], "left_semi")
    return rounded(bars.drop("ref_share", "cur_share"), 6, "lower")


@query(
    "d9_chart_categories",
    f"""with k as (select variable, snapshot_date from ({DISTINCT_SQL})
                   where cur_n <= 10 and ref_n <= 10 and not (cur_n <= 1 and ref_n <= 1)),
         r as (select variable, value, n / sum(n) over (partition by variable) as share
               from (select variable, value, count(*) as n from ref_values group by all)),
         c as (select variable, snapshot_date, value, n / sum(n) over (partition by variable, snapshot_date) as share
               from (select variable, snapshot_date, value, count(*) as n from long_values group by all)),
         v as (select k.*, r.value from k join r on r.variable = k.variable
               union select c.variable, c.snapshot_date, c.value from c join k using (variable, snapshot_date))
        select v.variable, v.snapshot_date, v.value, round(coalesce(r.share, 0), 6) as ref_share,
               round(coalesce(c.share, 0), 6) as cur_share, round(coalesce(c.share, 0) - coalesce(r.share, 0), 6) as diff
        from v left join r on r.variable = v.variable and r.value = v.value
             left join c on c.variable = v.variable and c.value = v.value and c.snapshot_date = v.snapshot_date""",
)
def _(spark, d):
    ref, every = values(spark, d)
    chosen = drift.chart_kinds(ref, every).where(F.col("kind") == "category").drop("kind")
    cur = join_calendar(every, chosen, ["variable", "snapshot_date"], "left_semi")
    ref = join_calendar(ref, chosen.select("variable").distinct(), "variable", "left_semi")
    return rounded(drift.category_shares(ref, cur), 6, "ref_share", "cur_share", "diff")


@query(
    "d9_chart_kinds",
    f"""select variable, snapshot_date, case when cur_n <= 1 and ref_n <= 1 then 'skipped'
               when cur_n <= 10 and ref_n <= 10 then 'category' else 'histogram' end as kind
        from ({DISTINCT_SQL})""",
)
def _(spark, d):
    ref, every = values(spark, d)
    return drift.chart_kinds(ref, every)


def few_valued_sql(few: int) -> str:
    return f"select variable from ref_values group by 1 having count(distinct value) <= {few}"


def category_shares_sql(few: int) -> str:
    return f"""with n as (select variable, snapshot_date, value, count(*) as n
                   from long_values where variable in ({few_valued_sql(few)}) group by all),
             c as (select variable, snapshot_date, value,
                          n / sum(n) over (partition by variable, snapshot_date) as share from n),
             m as (select distinct variable, snapshot_date from c),
             r as (select variable, m.snapshot_date, value, share from m
                   join (select variable, value, share from c where snapshot_date = date '{REFERENCE}') using (variable))
        select variable, snapshot_date, value, round(coalesce(r.share, 0), 6) as ref_share,
               round(coalesce(c.share, 0), 6) as cur_share,
               round(coalesce(c.share, 0) - coalesce(r.share, 0), 6) as diff
        from r full join c using (variable, snapshot_date, value)"""


@query("u4_all_category_unions", category_shares_sql(10))
def _(spark, d):
    """All variables of at most ten reference values: no value of a continuous one meets every month."""
    ref, every = values(spark, d)
    kinds = drift.charted(ref, 10)
    shares = drift.category_shares(*(drift.of_kind(v, kinds, "category") for v in (ref, every)))
    return rounded(shares, 6, "ref_share", "cur_share", "diff")


@query("d10_category_shares", category_shares_sql(2))
def _(spark, d):
    """Reference values meet every month, at most two for each variable."""
    ref, every = values(spark, d)
    kinds = drift.charted(ref)
    shares = drift.category_shares(*(drift.of_kind(v, kinds, "category") for v in (ref, every)))
    return rounded(shares, 6, "ref_share", "cur_share", "diff")


@query(
    "d10_clipped_density",
    """with clipped as (select variable, snapshot_date, least(value, top) as value
                        from long_values join (select variable, snapshot_date, quantile_cont(value, 0.99) as top
                                               from long_values group by all) using (variable, snapshot_date)),
         h as (select b.variable, c.snapshot_date, b.bin, b.lower, b.upper, count(*) as n from bins b
               join clipped c on c.variable = b.variable and c.value >= b.lower
                    and (c.value < b.upper or (b.is_last and c.value <= b.upper)) group by all)
        select variable, snapshot_date, bin::int as bin, round(lower, 4) as lower, round(upper, 4) as upper, n,
               round(n / sum(n) over (partition by variable, snapshot_date), 6) as area
        from h""",
)
def _(spark, d):
    """Density times bin width, so that all bars of a month add up to 1; every variable, few-valued ones included."""
    ref, every = values(spark, d)
    bars = drift.densities(drift.clip_at_p99(every), drift.bin_edges(ref, DRIFT_VARIABLES))
    with_area = bars.withColumn("area", F.col("density") * (F.col("upper") - F.col("lower"))).drop("density")
    return rounded(rounded(with_area, 4, "lower", "upper"), 6, "area")


@query(
    "d11_combined_severity",
    f"select variable, snapshot_date, severity from ({DRIFT_TABLE_SQL})",
)
def _(spark, d):
    return drift.drift_table(comparison(spark, d)).select("variable", "snapshot_date", "severity")
