"""Walk-forward calendar and the fold of each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.config import FOLD_START_DAYS, MONTHS_AHEAD
from stridecast.functions.dates import (
    Day,
    TextDate,
    before,
    fold_end,
    fold_start,
    on_or_after,
    through,
    typed,
)
from stridecast.operators.lookup import BROADCAST_BYTES, ROWS_PER_TASK, attach, measured_bytes
from stridecast.sources.shared import written


def fold_calendar(
    splits: DataFrame,
    split: str,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> DataFrame:
    """First and last day of every fold, for each split date in ``splits``."""
    day = F.col(split)
    folds = [
        F.struct(
            F.lit(i).alias("fold"),
            fold_start(day, i, starts).alias("start_date"),
            fold_end(day, i, starts, months_ahead).alias("end_date"),
        )
        for i in range(len(starts))
    ]
    return splits.select("*", F.inline(F.array(*folds)))


def in_fold(
    date: str,
    split: Day,
    fold: int,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> Column:
    """True on the days of one fold, both ends included."""
    return on_or_after(date, fold_start(split, fold, starts)) & through(
        date, fold_end(split, fold, starts, months_ahead)
    )


def fold_rows(
    df: DataFrame,
    date: str,
    split: Day,
    fold: int,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> DataFrame:
    """Test rows of one fold."""
    return df.where(in_fold(typed(df, date), split, fold, starts, months_ahead))


def fold_number(
    date: str, split: Day, starts: tuple[int, ...] = FOLD_START_DAYS
) -> Column:
    """Fold of a test row: folds are adjacent, so the later starts decide."""
    number = F.lit(len(starts) - 1)
    for i in range(len(starts) - 1, 0, -1):
        number = F.when(before(date, fold_start(split, i, starts)), F.lit(i - 1)).otherwise(number)
    return number


def in_horizon(
    date: str,
    split: Day,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> Column:
    """True from the first day of the first fold to the last day of the last one."""
    last = fold_end(split, len(starts) - 1, starts, months_ahead)
    return on_or_after(date, fold_start(split, 0, starts)) & through(date, last)


def assign_fold(
    df: DataFrame,
    date: str,
    split: Day,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> DataFrame:
    """Test rows of all folds in one pass, with their ``fold``; other rows are left out."""
    date = typed(df, date)
    rows = df.where(in_horizon(date, split, starts, months_ahead))
    return rows.withColumn("fold", fold_number(date, split, starts))


def fold_days(
    splits: DataFrame,
    split: str,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> DataFrame:
    """Every day of any horizon, once, with the executions that test it: ``day`` and
    ``tests``, an array of ``(split, fold)``. Repeated and null split dates count once
    and not at all."""
    days = splits.select(F.to_date(split).alias("split")).where("split is not null").distinct()
    calendar = fold_calendar(days, "split", starts, months_ahead).where("start_date <= end_date")
    each = calendar.select("split", "fold", F.explode(F.sequence("start_date", "end_date")).alias("day"))
    return each.groupBy("day").agg(F.sort_array(F.collect_list(F.struct("split", "fold"))).alias("tests"))


def assign_folds(
    df: DataFrame,
    date: str,
    splits: DataFrame,
    split: str,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The test rows of every execution day in ``splits``, with its day in the column
    ``split`` and their ``fold``; a row comes once for each execution that tests it.

    The intervals are laid out as days, so that a row meets its executions by an equal
    day, and not by comparing it with each interval. The table of days is made at once; it
    has a row per calendar day, whatever the number of rows, and is broadcast up to
    ``broadcast_bytes``. Beyond, the rows are joined by their day, and a day with more than
    ``rows_per_task`` rows is split (see ``lookup.attach``). Its first and last day bound
    the scan. Rows without a date belong to no fold.
    """
    date = typed(df, date)
    rows = df.drop(split, "fold")
    days = written(fold_days(splits, split, starts, months_ahead), "fold-days")
    first, last = days.agg(F.min("day"), F.max("day")).first()
    if first is None:
        bounds, day = F.lit(False), F.lit(None).cast("date")
    else:
        bounds = on_or_after(date, first) & through(date, last)
        text = isinstance(date, TextDate)
        day = F.to_date(F.substring(date, 1, 10)) if text else F.to_date(date)
    keyed = rows.where(bounds).withColumn("_day", day)
    tests = days.select(F.col("day").alias("_day"), F.col("tests").alias("_tests"))
    if measured_bytes(tests) <= broadcast_bytes:
        found = keyed.join(F.broadcast(tests), "_day")
    else:
        weights = keyed.groupBy("_day").agg(F.count(F.lit(1)).alias("_rows"))
        table = written(tests.join(weights, "_day"), "fold-days")
        found = attach(keyed, table, ["_day"], "_rows", -1, rows_per_task)
    test = F.inline("_tests").alias(split, "fold")
    return found.select(*rows.columns, test)
