"""Ridge regression from moments: grouped aggregates, then a Cholesky solution in column expressions.

A group's rows become one row of means, variances and covariances, combined before the shuffle. The normal equations are
solved beside them, level by level, each level one projection over the former; nothing leaves the JVM and no group
is gathered. Errors of a model on any set of rows follow from the moments of these rows alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.metrics import r2_from

#: A pivot of the correlation matrix (diagonal 1) that small is a column that the others already give.
LEAST_PIVOT = 1e-12


def _of(name: str) -> Column:
    return F.col(f"`{name}`").cast("double")


def moments(columns: list[str], label: str) -> list[Column]:
    """``n_rows, my, vy``, means ``m{i}``, covariances ``c{i}_{j}`` and, with the label, ``b{i}``."""
    p = range(len(columns))
    return [
        F.count("*").alias("n_rows"),
        F.avg(_of(label)).alias("my"),
        F.var_pop(_of(label)).alias("vy"),
        *(F.avg(_of(c)).alias(f"m{i}") for i, c in enumerate(columns)),
        *(F.covar_pop(_of(columns[i]), _of(columns[j])).alias(f"c{i}_{j}") for i in p for j in p if i <= j),
        *(F.covar_pop(_of(c), _of(label)).alias(f"b{i}") for i, c in enumerate(columns)),
    ]


def solved(found: DataFrame, columns: list[str], penalty: float) -> DataFrame:
    """``found`` (any keys beside ``moments``) with ``intercept`` and ``coef_{c}`` per column; the moments go.

    Features and label are standardised for the penalty, as Spark's own ``LinearRegression`` does. A feature
    without spread has coefficient 0, and so have all where the label has none. Without a penalty, a column that the
    ones before it already give has coefficient 0.
    """
    p = range(len(columns))
    keys = [c for c in found.columns if c not in _moment_names(len(columns)) or c == "n_rows"]

    def total(terms: list[Column]) -> Column:
        out = F.lit(0.0)
        for term in terms:
            out = out + term
        return out

    def zero_unless(good: Column, value: Column) -> Column:
        return F.when(good, value).otherwise(F.lit(0.0))

    now = found.withColumns({**{f"s{i}": F.sqrt(f"c{i}_{i}") for i in p}, "sy": F.sqrt("vy")})
    spread = [F.col(f"s{i}") > 0 for i in p]
    scaled = {
        f"r{i}_{j}": zero_unless(spread[i] & spread[j], F.col(f"c{j}_{i}") / (F.col(f"s{i}") * F.col(f"s{j}")))
        for i in p
        for j in range(i)
    }
    both = [s & (F.col("sy") > 0) for s in spread]
    scaled |= {f"t{i}": zero_unless(both[i], F.col(f"b{i}") / (F.col(f"s{i}") * F.col("sy"))) for i in p}
    scaled["diagonal"] = F.lit(1.0) + zero_unless(F.col("sy") > 0, F.lit(float(penalty)) / F.col("sy"))
    now = now.withColumns(scaled)
    for k in p:
        pivot = F.col("diagonal") - total([F.col(f"l{k}_{j}") * F.col(f"l{k}_{j}") for j in range(k)])
        now = now.withColumn(f"d{k}", pivot)
        now = now.withColumn(f"l{k}_{k}", F.when(F.col(f"d{k}") > LEAST_PIVOT, F.sqrt(f"d{k}")))
        good, root = F.col(f"l{k}_{k}").isNotNull(), F.col(f"l{k}_{k}")
        below = {}
        for i in range(k + 1, len(columns)):
            known = total([F.col(f"l{i}_{j}") * F.col(f"l{k}_{j}") for j in range(k)])
            below[f"l{i}_{k}"] = (F.col(f"r{i}_{k}") - known) / root
        below[f"z{k}"] = (F.col(f"t{k}") - total([F.col(f"l{k}_{j}") * F.col(f"z{j}") for j in range(k)])) / root
        now = now.withColumns({name: zero_unless(good, value) for name, value in below.items()})
    for k in reversed(p):
        rest = F.col(f"z{k}") - total([F.col(f"l{i}_{k}") * F.col(f"x{i}") for i in p if i > k])
        now = now.withColumn(f"x{k}", zero_unless(F.col(f"l{k}_{k}").isNotNull(), rest / F.col(f"l{k}_{k}")))
    slopes = [zero_unless(spread[i], F.col(f"x{i}") * F.col("sy") / F.col(f"s{i}")) for i in p]
    now = now.withColumns({f"coef_{c}": slope for c, slope in zip(columns, slopes)})
    shift = total([F.col(f"`coef_{c}`") * F.col(f"m{i}") for i, c in enumerate(columns)])
    return now.select(
        *keys, (F.col("my") - shift).alias("intercept"), *(F.col(f"`coef_{c}`") for c in columns)
    )


def _moment_names(p: int) -> set[str]:
    names = {"n_rows", "my", "vy"} | {f"{x}{i}" for x in "mb" for i in range(p)}
    return names | {f"c{i}_{j}" for i in range(p) for j in range(i, p)}


def fitted(df: DataFrame, keys: list[str], columns: list[str], label: str, penalty: float) -> DataFrame:
    """``keys, n_rows, intercept, coef_{c}`` of every group of ``df``."""
    return solved(df.groupBy(*keys).agg(*moments(columns, label)), columns, penalty)


def prediction(columns: list[str]) -> Column:
    """The model's value for a row that has ``columns``, ``intercept`` and ``coef_{c}``."""
    out = F.col("intercept")
    for c in columns:
        out = out + F.col(f"`coef_{c}`") * _of(c)
    return out


def errors(columns: list[str]) -> tuple[Column, Column]:
    """Residual and total sums of squares from a row with ``moments`` and a model's coefficients."""
    p = range(len(columns))
    own = [F.col(f"`coef_{c}`") for c in columns]
    bias, spread = F.col("my") - F.col("intercept"), F.col("vy")
    for i in p:
        bias = bias - own[i] * F.col(f"m{i}")
        spread = spread - 2 * own[i] * F.col(f"b{i}") + own[i] * own[i] * F.col(f"c{i}_{i}")
        for j in range(i + 1, len(columns)):
            spread = spread + 2 * own[i] * own[j] * F.col(f"c{i}_{j}")
    residual = F.col("n_rows") * (F.greatest(spread, F.lit(0.0)) + bias * bias)
    return residual, F.col("n_rows") * F.col("vy")


def summary_by(found: DataFrame, models: DataFrame, keys: list[str], columns: list[str], penalty: float) -> DataFrame:
    """One training-summary row per group: rmse and R2 of every split, from the moments by group and ``split``."""
    residual, total = errors(columns)
    per_split = found.join(models.drop("n_rows"), keys).select(
        *keys,
        "split",
        F.sqrt(residual / F.col("n_rows")).alias("rmse"),
        r2_from(residual, total).alias("r2"),
    )
    return per_split.groupBy(*keys).agg(
        F.lit("LinearRegression").alias("model_type"),
        F.lit(penalty).alias("regParam"),
        F.lit(0.0).alias("elasticNetParam"),
        *[
            F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}")
            for m in ("rmse", "r2")
            for s in ("train", "test", "oot")
        ],
    )
