"""Back-test: how good past executions were, now that the actual values are known."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.config import APE, MONTHS_AHEAD, PREDICTION
from stridecast.functions.dates import Day, as_date, day_column, on_or_after, through, typed
from stridecast.functions.errors import absolute_error, percentage_error, squared_error

# Days looked back on, and the percentage error that makes an outlier.
LAST_DAYS = 90
OUTLIER = 100

#: Of the horizon of past executions nothing is known but the days they carry.
BY_DAY = "by day"


def _last_day(df: DataFrame, date: str, until: Day) -> Column:
    if until is None:
        return df.agg(F.max(F.to_date(date))).scalar()
    return day_column(until)


def _within(df: DataFrame, date: str, end: Column, days: int) -> DataFrame:
    date = typed(df, date)
    return df.where(on_or_after(date, F.date_sub(end, days - 1)) & through(date, end))


def last_days(df: DataFrame, date: str, days: int = LAST_DAYS, until: Day = None) -> DataFrame:
    """Rows of the ``days`` days up to ``until``, or up to the last date of ``df``."""
    return _within(df, date, _last_day(df, date, until), days)


def matched(
    predictions: DataFrame,
    actuals: DataFrame,
    ids: Sequence[str],
    target: str,
    date: str,
    days: int = LAST_DAYS,
    until: Day = None,
    months_ahead: int | str | None = None,
) -> DataFrame:
    """Predictions for the last ``days`` days of actual values, with these values.

    Rows meet on the ids, and on the day where the predictions carry it. Then both
    sides are cut to those days before the join. An execution reaches from its day to
    the end of the month ``months_ahead`` later; where that is given, executions that
    cannot reach those days are not read. ``BY_DAY`` leaves it to the days that the
    predictions carry, whatever their horizon was; if they carry none it is ``MONTHS_AHEAD``.
    """
    end = _last_day(actuals, date, until)
    if months_ahead == BY_DAY:
        months_ahead = None if date in predictions.columns else MONTHS_AHEAD
    if months_ahead is not None:
        earliest = F.add_months(F.trunc(F.date_sub(end, days - 1), "month"), -months_ahead)
        made_on = F.col("dt_execution")
        predictions = predictions.where((made_on >= earliest) & (made_on <= end))
    known = _within(actuals, date, end, days)
    keys = list(dict.fromkeys(ids))
    if date in predictions.columns:
        predictions = _within(predictions, date, end, days).withColumn(date, F.to_date(date))
        keys = list(dict.fromkeys([*ids, date]))
    known = known.withColumn(date, F.to_date(date)).select(*dict.fromkeys([*keys, date, target]))
    made = predictions.select(*dict.fromkeys([*keys, "dt_execution", target + PREDICTION]))
    return made.join(known, keys)


def backtest(
    predictions: DataFrame,
    actuals: DataFrame,
    ids: Sequence[str],
    target: str,
    date: str,
    days: int = LAST_DAYS,
    until: Day = None,
    executions: Sequence[Day] | None = None,
    last_execution: Day = None,
    remove_outliers: bool = True,
    outlier: float = OUTLIER,
    months_ahead: int | str | None = BY_DAY,
) -> DataFrame:
    """MAPE, MAE and MSE per execution over the last ``days`` days of actual values.

    With ``remove_outliers``, rows whose percentage error exceeds ``outlier`` are
    left out of the means and counted apart. ``months_ahead`` is the longest horizon of
    the executions; None reads them all. By default predictions that carry the day are
    judged whatever their horizon was, and others up to ``MONTHS_AHEAD``.
    """
    if executions is not None:
        wanted = [as_date(d) for d in executions]
        predictions = predictions.where(F.col("dt_execution").isin(wanted))
    if last_execution is not None:
        predictions = predictions.where(F.col("dt_execution") <= day_column(last_execution))
    rows = matched(predictions, actuals, ids, target, date, days, until, months_ahead)
    prediction = target + PREDICTION
    rows = rows.withColumn(target + APE, percentage_error(target, prediction))
    is_outlier = F.coalesce(F.col(target + APE) > F.lit(float(outlier)), F.lit(False))
    kept = ~is_outlier if remove_outliers else F.lit(True)
    return rows.groupBy("dt_execution").agg(
        F.avg(F.when(kept, F.col(target + APE))).alias("mape"),
        F.avg(F.when(kept, absolute_error(target, prediction))).alias("mae"),
        F.avg(F.when(kept, squared_error(target, prediction))).alias("mse"),
        F.count_if(kept).alias("row_count"),
        F.count_if(is_outlier).alias("outlier_count"),
    )
