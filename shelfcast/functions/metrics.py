"""Regression metrics as plain aggregate columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rmse(actual: str, predicted: str) -> Column:
    error = F.col(predicted) - F.col(actual)
    return F.sqrt(F.avg(error * error))


def mae(actual: str, predicted: str) -> Column:
    return F.avg(F.abs(F.col(predicted) - F.col(actual)))


def r2_from(residual: Column, total: Column) -> Column:
    """1 - residual/total; a constant target scores 1 when met exactly and 0 otherwise."""
    return F.when(total != 0, 1 - residual / total).otherwise(F.when(residual == 0, 1.0).otherwise(0.0))


def r2(actual: str, predicted: str) -> Column:
    error = F.col(predicted) - F.col(actual)
    return r2_from(F.sum(error * error), F.var_pop(actual) * F.count(actual))


def all_metrics(actual: str, predicted: str) -> list[Column]:
    return [
        rmse(actual, predicted).alias("rmse"),
        mae(actual, predicted).alias("mae"),
        r2(actual, predicted).alias("r2"),
    ]
