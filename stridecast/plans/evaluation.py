"""Evaluation of a forecast whose actual values are known."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stridecast.functions.dates import Day
from stridecast.operators.evaluate import error_summary, evaluation_rows, level_errors


@dataclass(frozen=True)
class Evaluation:
    rows: DataFrame
    levels: DataFrame
    summary: DataFrame


def evaluate(
    results: DataFrame,
    target: str,
    prediction: str,
    date: str,
    start: Day,
    levels: Sequence[str],
    full: bool = True,
) -> Evaluation:
    """Errors of the rows from ``start`` on (None: all), of the groups, and overall. Lazy.

    ``full`` looks at each level alone too, besides all levels together.
    """
    rows = evaluation_rows(results, target, prediction, date, start)
    return Evaluation(
        rows,
        level_errors(rows, target, prediction, levels, full),
        error_summary(rows, target, prediction, levels, full),
    )
