"""Errors of past executions as a table of sums that grows by execution.

For each execution the table holds one row per day and combination of levels, with sums
and counts of errors. Recording an execution reads that one alone; recording it again
replaces its rows in one step. Back-tests, levels and summaries of any executions and days
are added up from these rows, and equal those of all predictions read anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridecast.config import PREDICTION
from stridecast.functions.dates import Day, day_column
from stridecast.functions.errors import absolute_error, percentage_error, squared_error
from stridecast.operators.evaluate import levels_of, partial_sums, summary_of
from stridecast.plans.backtest import LAST_DAYS, OUTLIER
from stridecast.sources.results import read_executions, replace_executions

DAY = "_day"


def history_path(root: str, target: str) -> str:
    return f"{root.rstrip('/')}/{target}_history"


def execution_sums(
    predictions: DataFrame,
    actuals: DataFrame,
    ids: Sequence[str],
    target: str,
    date: str,
    levels: Sequence[str] = (),
    outlier: float = OUTLIER,
) -> DataFrame:
    """Sums of errors by execution, day and levels.

    Predictions meet the actual values on the ids, and on the day where they carry it;
    ``levels`` are columns of ``actuals``. Rows without actual value have no part in the
    errors of rows. Sums ``_kept_...`` leave out the rows whose percentage error exceeds
    ``outlier``.
    """
    prediction = target + PREDICTION
    keys = list(dict.fromkeys([*ids, date] if date in predictions.columns else ids))
    if date in predictions.columns:
        predictions = predictions.withColumn(date, F.to_date(date))
    known = actuals.withColumn(date, F.to_date(date)).select(*dict.fromkeys([*keys, date, target, *levels]))
    rows = predictions.select(*keys, "dt_execution", prediction).join(known, keys)
    rows = rows.withColumnRenamed(date, DAY)
    errors = {
        "ape": percentage_error(target, prediction),
        "ae": absolute_error(target, prediction),
        "se": squared_error(target, prediction),
    }
    is_outlier = F.coalesce(errors["ape"] > F.lit(float(outlier)), F.lit(False))
    kept = {f"_kept_{name}": F.when(~is_outlier, error) for name, error in errors.items()}
    more = [F.sum(errors["se"]).alias("_se"), F.count(errors["se"]).alias("_se_rows")]
    for name, error in kept.items():
        more += [F.sum(error).alias(name), F.count(error).alias(f"{name}_rows")]
    more += [F.count_if(~is_outlier).alias("_kept_rows"), F.count_if(is_outlier).alias("_outliers")]
    return partial_sums(rows, target, prediction, ["dt_execution", DAY, *levels], more=more)


def record(
    predictions: DataFrame,
    actuals: DataFrame,
    root: str,
    ids: Sequence[str],
    target: str,
    date: str,
    levels: Sequence[str] = (),
    outlier: float = OUTLIER,
    execution: Day = None,
) -> str:
    """Puts the sums of the executions in ``predictions`` into the history below ``root``.

    Executions recorded before are replaced, others stay. ``execution`` names the only
    one, which then is replaced also if nothing of it can be judged yet.
    """
    if execution is not None:
        predictions = predictions.where(F.col("dt_execution") == day_column(execution))
    path = history_path(root, target)
    sums = execution_sums(predictions, actuals, ids, target, date, levels, outlier)
    replace_executions(sums, path, gather=execution is None, execution=execution)
    return path


def history(
    spark: SparkSession,
    root: str,
    target: str,
    executions: Sequence[Day] | None = None,
    first_day: Day = None,
    last_day: Day = None,
) -> DataFrame:
    """The recorded sums of the given executions (None: all) and days, both ends included."""
    found = read_executions(spark, history_path(root, target), executions)
    if first_day is not None:
        found = found.where(F.col(DAY) >= day_column(first_day))
    if last_day is not None:
        found = found.where(F.col(DAY) <= day_column(last_day))
    return found


def recorded_backtest(
    sums: DataFrame, days: int = LAST_DAYS, until: Day = None, remove_outliers: bool = True
) -> DataFrame:
    """What ``backtest`` gives, from recorded sums: MAPE, MAE and MSE per execution over
    the ``days`` days up to ``until`` (None: the last day recorded)."""
    end = sums.agg(F.max(DAY)).scalar() if until is None else day_column(until)
    rows = sums.where((F.col(DAY) >= F.date_sub(end, days - 1)) & (F.col(DAY) <= end))

    def mean(error: str):
        return F.try_divide(F.sum(f"_{error}"), F.sum(f"_{error}_rows"))

    prefix = "kept_" if remove_outliers else ""
    return rows.groupBy("dt_execution").agg(
        mean(f"{prefix}ape").alias("mape"),
        mean(f"{prefix}ae").alias("mae"),
        mean(f"{prefix}se").alias("mse"),
        F.sum("_kept_rows" if remove_outliers else "_rows").alias("row_count"),
        F.sum("_outliers").alias("outlier_count"),
    )


def recorded_levels(sums: DataFrame, levels: Sequence[str], full: bool = True) -> DataFrame:
    """``level_errors`` of the recorded rows; levels may be ``dt_execution`` and the day too."""
    return levels_of(sums, levels, full)


def recorded_summary(sums: DataFrame, levels: Sequence[str], full: bool = True) -> DataFrame:
    """``error_summary`` of the recorded rows."""
    return summary_of(sums, levels, full)
