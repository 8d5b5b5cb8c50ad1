"""Distribution drift between a reference month and current months.

A long table (variable, month, value) goes through one grouped plan for all variables and months.
Only bin edges (variables x bins) and histograms (variables x months x bins) are ever joined by
broadcast; both are bounded by configuration and the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.functions.calendar import join_calendar
from shelfcast.functions.quantiles import even_probabilities, exact_quantiles
from shelfcast.session import written
from shelfcast.sources.schemas import (
    DRIFT_BINS,
    EDGE_PADDING,
    MODERATE_BELOW,
    SMOOTHING,
    STABLE_BELOW,
)

SEVERITIES = ["stable", "moderate", "significant"]


def long_values(features: DataFrame, variables: list[str]) -> DataFrame:
    """(variable, snapshot_date, value) for the variables present; nulls and NaN dropped."""
    present = [v for v in variables if v in features.columns]
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(v).alias("variable"), F.col(f"`{v}`").cast("double").alias("value")) for v in present]
        )
    )
    return (
        features.select("snapshot_date", pairs.alias("p"))
        .select("p.variable", "snapshot_date", "p.value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def missing_variables(features: DataFrame, variables: list[str]) -> DataFrame:
    """``snapshot_date, missing``: the variables without any value in a month, in the order given.

    A month file that lacks a column reads as nulls; a column that no month has counts as missing in all.
    """
    present = [v for v in variables if v in features.columns]
    value = {v: F.col(f"`{v}`").cast("double") for v in present}
    counted = features.groupBy("snapshot_date").agg(
        *[F.count(F.when(~F.isnan(c), c)).alias(f"n{variables.index(v)}") for v, c in value.items()]
    )
    empty = [
        F.when(F.col(f"n{i}") == 0, v) if v in value else F.lit(v) for i, v in enumerate(variables)
    ]
    return counted.select("snapshot_date", F.array_compact(F.array(*empty)).alias("missing"))


def quantile_edges(reference: DataFrame, n_bins: int = DRIFT_BINS) -> DataFrame:
    """Distinct quantiles of the reference; a constant reference gets one narrow bin around its value."""
    found = exact_quantiles(reference, "variable", "value", even_probabilities(n_bins))
    edges = F.array_distinct("quantiles")
    low, high = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(n_bins))
    padded = F.array(low - EDGE_PADDING, high + EDGE_PADDING)
    return found.select("variable", F.when(F.size(edges) < 2, padded).otherwise(edges).alias("edges"))


def uniform_edges(reference: DataFrame, n_bins: int = DRIFT_BINS) -> DataFrame:
    """Equal-width edges between the extremes of the reference."""
    span = reference.groupBy("variable").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = span.select(
        "variable",
        F.when(flat, F.col("lo") - EDGE_PADDING).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + EDGE_PADDING).otherwise(F.col("hi")).alias("hi"),
    )
    step = (F.col("hi") - F.col("lo")) / n_bins
    inner = [F.col("lo") + F.lit(float(i)) * step for i in range(n_bins)]
    return span.select("variable", F.array(*inner, F.col("hi")).alias("edges"))


def bin_edges(reference: DataFrame, variables: list[str], n_bins: int = DRIFT_BINS, method: str = "quantile"):
    """Edges for every variable asked for; one without any reference value gets a single open bin."""
    if method not in ("quantile", "uniform"):
        raise ValueError("method must be quantile or uniform")
    edges = (quantile_edges if method == "quantile" else uniform_edges)(reference, n_bins)
    spark = reference.sparkSession
    names = spark.createDataFrame([(v,) for v in variables], "variable string")
    everything = F.array(F.lit(float("-inf")), F.lit(float("inf")))
    return names.join(F.broadcast(edges), "variable", "left").select(
        "variable", F.coalesce("edges", everything).alias("edges")
    )


def _bin_of(value: Column, edges: Column, n_bins: int) -> Column:
    """Index of the half-open bin, the last one closed; written out per edge to stay in generated code."""
    passed = [F.coalesce((value >= F.get(edges, F.lit(i))).cast("int"), F.lit(0)) for i in range(n_bins + 1)]
    total = passed[0]
    for p in passed[1:]:
        total = total + p
    return F.least(total - 1, F.size(edges) - 2)


def histogram(values: DataFrame, edges: DataFrame, n_bins: int = DRIFT_BINS) -> DataFrame:
    """Counts per variable, month and bin; values outside the edges are not counted."""
    e = F.col("edges")
    inside = (F.col("value") >= F.get(e, F.lit(0))) & (F.col("value") <= F.element_at(e, -1))
    return (
        values.join(F.broadcast(edges), "variable")
        .where(inside)
        .select("variable", "snapshot_date", _bin_of(F.col("value"), e, n_bins).alias("bin"))
        .groupBy("variable", "snapshot_date", "bin")
        .agg(F.count("*").alias("n"))
    )


def filled_counts(counts: DataFrame, edges: DataFrame, months: DataFrame) -> DataFrame:
    """Counts of every bin of every variable and month, empty bins included.

    ``months`` lists the months, for all variables or per variable. Everything here has at most
    variables x bins x months rows, bounded by configuration and calendar.
    """
    bins = edges.select("variable", F.posexplode("edges").alias("bin", "lower"), F.size("edges").alias("k"))
    bins = bins.where(F.col("bin") < F.col("k") - 1).drop("k")
    if "variable" in months.columns:
        grid = bins.join(F.broadcast(months), "variable")
    else:
        every_month = months.agg(F.collect_set("snapshot_date")).scalar()
        grid = bins.select("*", F.explode(every_month).alias("snapshot_date"))
    joined = grid.join(F.broadcast(counts), ["variable", "snapshot_date", "bin"], "left")
    return joined.withColumn("n", F.coalesce("n", F.lit(0)))


def with_shares(filled: DataFrame) -> DataFrame:
    """Smoothed share of every bin of a variable and month."""
    smoothed = F.col("n") + F.lit(SMOOTHING)
    return filled.withColumn("share", smoothed / F.sum(smoothed).over(Window.partitionBy("variable", "snapshot_date")))


def proportions(counts: DataFrame, edges: DataFrame, months: DataFrame) -> DataFrame:
    """Smoothed share of every bin of every variable and month, empty bins included."""
    return with_shares(filled_counts(counts, edges, months))


def beside_reference(shares: DataFrame, reference_month: str) -> DataFrame:
    """Current and reference count and share per variable, month and bin; the reference is one of the months."""
    bin_of_all_months = Window.partitionBy("variable", "bin")
    is_ref = F.col("snapshot_date") == F.lit(reference_month).cast("date")

    def of_reference(c: str) -> Column:
        return F.max(F.when(is_ref, F.col(c))).over(bin_of_all_months)

    return shares.select(
        "variable",
        "snapshot_date",
        "bin",
        "lower",
        of_reference("n").alias("ref_n"),
        F.col("n").alias("cur_n"),
        of_reference("share").alias("ref_share"),
        F.col("share").alias("cur_share"),
    )


def psi() -> Column:
    p, q = F.col("ref_share"), F.col("cur_share")
    return F.sum((p - q) * F.ln(p / q))


def csi() -> Column:
    return F.sum(F.abs(F.col("ref_share") - F.col("cur_share")))


def severity(value: Column, stable: float = STABLE_BELOW, moderate: float = MODERATE_BELOW) -> Column:
    size = F.abs(value)
    return F.when(size < stable, "stable").when(size < moderate, "moderate").otherwise("significant")


def worst(*severities: str) -> Column:
    order = F.array(*[F.lit(s) for s in SEVERITIES])
    return F.element_at(order, F.greatest(*[F.array_position(order, F.col(s)) for s in severities]).cast("int"))


def reference_edges(
    features: DataFrame,
    reference_month: str,
    variables: list[str],
    n_bins: int = DRIFT_BINS,
    method: str = "quantile",
) -> DataFrame:
    return bin_edges(long_values(month_of(features, reference_month), variables), variables, n_bins, method)


def binned_comparison(
    features: DataFrame,
    reference_month: str,
    variables: list[str],
    n_bins: int = DRIFT_BINS,
    method: str = "quantile",
) -> DataFrame:
    """Shares per variable, month and bin for all months of a feature table, the reference month included."""
    edges = reference_edges(features, reference_month, variables, n_bins, method)
    counts = histogram(long_values(features, variables), edges, n_bins)
    months = features.select("snapshot_date").distinct()
    return beside_reference(proportions(counts, edges, months), reference_month)


def drift_table(compared: DataFrame) -> DataFrame:
    """PSI, CSI and severities per variable and current month."""
    scored = compared.groupBy("variable", "snapshot_date").agg(psi().alias("psi"), csi().alias("csi"))
    return scored.select(
        "variable",
        "snapshot_date",
        F.round("psi", 6).alias("psi"),
        severity(F.col("psi")).alias("psi_severity"),
        F.round("csi", 6).alias("csi"),
        severity(F.col("csi")).alias("csi_severity"),
    ).withColumn("severity", worst("psi_severity", "csi_severity"))


def distinct_values(values: DataFrame, side: str) -> DataFrame:
    return values.groupBy("variable", "snapshot_date").agg(F.count_distinct("value").alias(f"{side}_distinct"))


def chart_kinds(reference: DataFrame, current: DataFrame, few: int = 10) -> DataFrame:
    """How a variable is charted per current month: skipped, category or histogram."""
    ref = distinct_values(reference, "ref").drop("snapshot_date")
    cur = distinct_values(current, "cur")
    both_at_most = lambda n: (F.col("ref_distinct") <= n) & (F.col("cur_distinct") <= n)
    return cur.join(F.broadcast(ref), "variable").select(
        "variable",
        "snapshot_date",
        F.when(both_at_most(1), "skipped").when(both_at_most(few), "category").otherwise("histogram").alias("kind"),
    )


def charted(reference: DataFrame, few: int = 2) -> DataFrame:
    """``variable, kind``: a histogram where the reference month has more than ``few`` values, else categories."""
    found = distinct_values(reference, "ref")
    return found.select("variable", F.when(F.col("ref_distinct") > few, "histogram").otherwise("category").alias("kind"))


def of_kind(values: DataFrame, kinds: DataFrame, kind: str) -> DataFrame:
    """The values of the variables charted so; ``kinds`` has one row per variable."""
    return values.join(F.broadcast(kinds.where(F.col("kind") == kind)), "variable", "left_semi")


def category_shares(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Share of every value seen on either side, 0 where a side lacks it; with their difference.

    ``reference`` holds one month. Each current month is compared with the union of both value sets. Either side is read
    once, into stored counts by value; totals and months follow from these.
    """

    counted = {
        "ref": written(reference.groupBy("variable", "value").agg(F.count("*").alias("n")), "reference_values"),
        "cur": written(current.groupBy("variable", "snapshot_date", "value").agg(F.count("*").alias("n")), "current_values"),
    }

    def shares(side: str, keys: list[str]) -> DataFrame:
        whole = counted[side].groupBy(*keys).agg(F.sum("n").alias("total"))
        share = (F.col("n") / F.col("total")).alias(f"{side}_share")
        return counted[side].join(whole, keys).select(*keys, "value", share)

    ref = shares("ref", ["variable"])
    cur = shares("cur", ["variable", "snapshot_date"])
    months = counted["cur"].select("variable", "snapshot_date").distinct()
    ref_by_month = ref.join(F.broadcast(months), "variable")
    return (
        ref_by_month.join(cur, ["variable", "snapshot_date", "value"], "full")
        .fillna(0.0, ["ref_share", "cur_share"])
        .withColumn("diff", F.col("cur_share") - F.col("ref_share"))
    )


def clip_at_p99(values: DataFrame) -> DataFrame:
    """Values above the 99th percentile of their own variable and month lowered to it."""
    keyed = values.withColumn("_group", F.concat_ws("@", "variable", F.col("snapshot_date").cast("string")))
    top = exact_quantiles(keyed, "_group", "value", [0.99]).select(
        "_group", F.get("quantiles", F.lit(0)).alias("_top")
    )
    # one row per variable and month
    return (
        keyed.join(F.broadcast(top), "_group")
        .withColumn("value", F.least("value", "_top"))
        .drop("_group", "_top")
    )


def densities(values: DataFrame, edges: DataFrame, n_bins: int = DRIFT_BINS) -> DataFrame:
    """Histogram as a density: bar areas of a variable and month add up to 1."""
    counts = histogram(values, edges, n_bins)
    each = Window.partitionBy("variable", "snapshot_date")
    placed = counts.join(F.broadcast(edges), "variable")
    lower = F.get("edges", F.col("bin"))
    upper = F.get("edges", F.col("bin") + 1)
    return placed.select(
        "variable",
        "snapshot_date",
        "bin",
        lower.alias("lower"),
        upper.alias("upper"),
        "n",
        (F.col("n") / F.sum("n").over(each) / (upper - lower)).alias("density"),
    )


def month_of(df: DataFrame, month: str) -> DataFrame:
    return df.where(F.col("snapshot_date") == F.lit(month).cast("date"))


def paired_predictions(predictions: DataFrame, reference_month: str) -> DataFrame:
    """Predictions of the reference month beside those of every month, for pairs scored in both."""
    keys = ["store_nbr", "family"]
    ref = month_of(predictions, reference_month).select(
        *keys, F.col("predicted_sales").alias("predicted_sales_ref")
    )
    cur = predictions.select("snapshot_date", *keys, F.col("predicted_sales").alias("predicted_sales_cur"))
    return cur.join(ref, keys)


def prediction_drift(predictions: DataFrame, reference_month: str, n_bins: int = DRIFT_BINS, method: str = "quantile"):
    """CSI between the reference month's and each month's predictions.

    Every month has its own matched pairs, hence its own reference distribution and edges: the month
    itself serves as the variable name in the grouped drift plan. A month without matches has no value.
    """
    both = written(paired_predictions(predictions, reference_month), "paired_predictions")

    def side(column: str) -> DataFrame:
        return both.select(
            F.col("snapshot_date").cast("string").alias("variable"),
            "snapshot_date",
            F.col(column).cast("double").alias("value"),
        ).where(F.col("value").isNotNull() & ~F.isnan("value"))

    ref, cur = side("predicted_sales_ref"), side("predicted_sales_cur")
    edges = (quantile_edges if method == "quantile" else uniform_edges)(ref, n_bins)
    own_month = edges.select("variable", F.col("variable").cast("date").alias("snapshot_date"))

    def shares(values: DataFrame, name: str) -> DataFrame:
        filled = proportions(histogram(values, edges, n_bins), edges, own_month)
        return filled.select("snapshot_date", "bin", F.col("share").alias(name))

    compared = join_calendar(shares(cur, "cur_share"), shares(ref, "ref_share"), ["snapshot_date", "bin"], "inner")
    scored = compared.groupBy("snapshot_date").agg(csi().alias("csi"))
    months = predictions.select("snapshot_date").distinct()
    return join_calendar(months, scored).select(
        "snapshot_date",
        F.round("csi", 6).alias("csi"),
        F.when(F.col("csi").isNotNull(), severity(F.col("csi"))).alias("csi_severity"),
    )
