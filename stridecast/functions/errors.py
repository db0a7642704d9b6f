"""Forecast errors of one row, all doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def percentage_error(target: Column | str, prediction: Column | str) -> Column:
    """Absolute error in percent of the target; null for a null or zero target."""
    t, p = _double(target), _double(prediction)
    return F.abs(F.try_divide(t - p, t) * 100)


def absolute_error(target: Column | str, prediction: Column | str) -> Column:
    return F.abs(_double(target) - _double(prediction))


def squared_error(target: Column | str, prediction: Column | str) -> Column:
    return F.pow(_double(target) - _double(prediction), F.lit(2.0))


def outlier_percent(error: Column | str, threshold: float) -> Column:
    """Aggregate: share of rows whose error exceeds ``threshold``, in percent.

    Rows without an error stay in the denominator.
    """
    over = F.count_if(_double(error) > F.lit(float(threshold)))
    return F.try_divide(over * F.lit(100.0), F.count(F.lit(1)).cast("double"))
