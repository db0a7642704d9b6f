"""Day arithmetic as Column expressions.

Bounds are built from literals, so Catalyst folds them to constants, and the date
column itself is never wrapped: the predicates reach the Parquet scan and prune
partitions. They hold for DATE and TIMESTAMP columns, and for ``yyyy-MM-dd`` text, with
or without a time after it, where ``typed`` names the column: text is compared as text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridecast.config import FOLD_START_DAYS, MONTHS_AHEAD

Day = Column | str | dt.date | None


def as_date(day: str | dt.date | None = None) -> dt.date:
    """A calendar day from a date or an ISO string; today when none is given."""
    if day is None:
        return dt.date.today()
    if isinstance(day, dt.datetime):
        return day.date()
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def day_column(day: Day) -> Column:
    return F.to_date(day) if isinstance(day, Column) else F.lit(as_date(day))


class TextDate(str):
    """Name of a date column that holds text."""


def typed(df: DataFrame, date: str) -> str:
    """The name of the date column, as a ``TextDate`` if ``df`` has text there."""
    return TextDate(date) if isinstance(df.schema[date].dataType, T.StringType) else date


def _bound(date: str, day: Column) -> Column:
    return day.cast("string") if isinstance(date, TextDate) else day


def before(date: str, day: Day) -> Column:
    return F.col(date) < _bound(date, day_column(day))


def on_or_after(date: str, day: Day) -> Column:
    return F.col(date) >= _bound(date, day_column(day))


def through(date: str, day: Day) -> Column:
    """On or before ``day``, the whole last day included for timestamps too."""
    return F.col(date) < _bound(date, F.date_add(day_column(day), 1))


def fold_start(split: Day, fold: int, starts: tuple[int, ...] = FOLD_START_DAYS) -> Column:
    return F.date_add(day_column(split), starts[fold])


def fold_end(
    split: Day,
    fold: int,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> Column:
    """Last day of a fold: before the next one starts, or the horizon's month end.

    With a short horizon a fold may end before it starts; it then has no day.
    """
    horizon = F.last_day(F.add_months(day_column(split), months_ahead))
    if fold + 1 < len(starts):
        return F.least(F.date_add(day_column(split), starts[fold + 1] - 1), horizon)
    return horizon


def month_of(date: str) -> Column:
    return F.date_format(F.col(date), "yyyy-MM")
