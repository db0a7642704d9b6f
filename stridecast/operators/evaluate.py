"""How good a forecast is: per row, per group, and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridecast.config import AE, APE, OUTLIER_PERCENT, SE
from stridecast.functions.dates import Day, on_or_after, typed
from stridecast.functions.errors import (
    absolute_error,
    outlier_percent,
    percentage_error,
    squared_error,
)


def error_columns(
    df: DataFrame, target: str, prediction: str, squared: bool = True
) -> DataFrame:
    """Adds percentage, absolute and, if wanted, squared error of each row."""
    errors = {
        target + APE: percentage_error(target, prediction),
        target + AE: absolute_error(target, prediction),
    }
    if squared:
        errors[target + SE] = squared_error(target, prediction)
    return df.withColumns(errors)


def evaluation_rows(
    df: DataFrame, target: str, prediction: str, date: str, start: Day
) -> DataFrame:
    """Rows from ``start`` on (all of them without one) with percentage and absolute error."""
    rows = df if start is None else df.where(on_or_after(typed(df, date), start))
    return error_columns(rows, target, prediction, squared=False)


def _grouping_sets(levels: Sequence[str], full: bool) -> list[list[str]]:
    """All levels together and, in full, each level alone."""
    alone = [[c] for c in levels] if full and len(levels) > 1 else []
    return [list(levels), *alone]


def _grouping_id(levels: Sequence[str], kept: Sequence[str]) -> int:
    return sum(1 << i for i, c in enumerate(reversed(levels)) if c not in kept)


def _finest(df: DataFrame, target: str, prediction: str, levels: Sequence[str], *more) -> DataFrame:
    """One row per combination of levels: the only pass over the rows.

    Coarser levels add these up, so grouping sets multiply the groups and not
    the rows.
    """
    return df.groupBy(*levels).agg(
        F.sum(target).alias("_target"),
        F.sum(prediction).alias("_prediction"),
        F.count(F.lit(1)).alias("_rows"),
        *more,
    )


def partial_sums(
    df: DataFrame,
    target: str,
    prediction: str,
    levels: Sequence[str],
    outliers: Sequence[int] = OUTLIER_PERCENT,
    more: Sequence[Column] = (),
) -> DataFrame:
    """One row per combination of levels, with all that errors are made of.

    The columns behind the levels are sums and counts (``more`` of them can be given):
    those of several tables can be put together, and ``levels_of`` and ``summary_of`` add
    them up.
    """
    ape, ae = percentage_error(target, prediction), absolute_error(target, prediction)
    return _finest(
        df,
        target,
        prediction,
        levels,
        F.sum(ape).alias("_ape"),
        F.count(ape).alias("_ape_rows"),
        F.sum(ae).alias("_ae"),
        F.count(ae).alias("_ae_rows"),
        *(F.count_if(ape > float(k)).alias(f"_over_{k}") for k in outliers),
        *more,
    )


def level_errors(
    df: DataFrame, target: str, prediction: str, levels: Sequence[str], full: bool = True
) -> DataFrame:
    """Errors of the summed forecast, at all levels together and at each alone.

    ``level`` is the grouping id: it tells a total from a null group.
    """
    return levels_of(_finest(df, target, prediction, levels), levels, full)


def levels_of(sums: DataFrame, levels: Sequence[str], full: bool = True) -> DataFrame:
    """``level_errors`` from partial sums."""
    found = sums.groupingSets(_grouping_sets(levels, full), *levels).agg(
        F.grouping_id().alias("level"),
        F.sum("_target").cast("double").alias("sum_target"),
        F.sum("_prediction").cast("double").alias("sum_prediction"),
        F.sum("_rows").alias("row_count"),
    )
    return found.withColumns(
        {
            "abs_error": absolute_error("sum_target", "sum_prediction"),
            "abs_perc_error": percentage_error("sum_target", "sum_prediction"),
        }
    )


def error_summary(
    df: DataFrame,
    target: str,
    prediction: str,
    levels: Sequence[str],
    full: bool = True,
    outliers: Sequence[int] = OUTLIER_PERCENT,
) -> DataFrame:
    """MAE and MAPE of the rows and of each level, and the share of outlier rows.

    Long form ``(scope, metric, value)``; the scope is ``rows`` or the names of
    the grouped columns. Level values are unweighted means over the groups, null
    errors left out. An empty input gives null values.
    """
    return summary_of(partial_sums(df, target, prediction, levels, outliers), levels, full, outliers)


def summary_of(
    sums: DataFrame,
    levels: Sequence[str],
    full: bool = True,
    outliers: Sequence[int] = OUTLIER_PERCENT,
) -> DataFrame:
    """``error_summary`` from partial sums."""
    sets = _grouping_sets(levels, full)
    added = ["_target", "_prediction", "_rows", "_ape", "_ape_rows", "_ae", "_ae_rows"]
    sums = sums.groupingSets([*sets, []], *levels).agg(
        F.grouping_id().alias("level"),
        *(F.sum(c).alias(c) for c in [*added, *(f"_over_{k}" for k in outliers)]),
    )
    sums = sums.withColumns(
        {
            "_group_ae": absolute_error("_target", "_prediction"),
            "_group_ape": percentage_error("_target", "_prediction"),
        }
    )

    def total(column: str):
        return F.max(F.when(F.col("level") == _grouping_id(levels, []), F.col(column)))

    def over_groups(column: str, kept: Sequence[str]):
        return F.avg(F.when(F.col("level") == _grouping_id(levels, kept), F.col(column)))

    metrics = [
        ("rows", "mape", F.try_divide(total("_ape"), total("_ape_rows"))),
        ("rows", "mae", F.try_divide(total("_ae"), total("_ae_rows"))),
    ]
    for k in outliers:
        share = F.try_divide(total(f"_over_{k}") * F.lit(100.0), total("_rows").cast("double"))
        metrics.append(("rows", f"outliers_{k}", share))
    for kept in sets:
        metrics.append((",".join(kept), "mape", over_groups("_group_ape", kept)))
        metrics.append((",".join(kept), "mae", over_groups("_group_ae", kept)))
    entries = [
        F.struct(F.lit(s).alias("scope"), F.lit(m).alias("metric"), v.alias("value"))
        for s, m, v in metrics
    ]
    return sums.agg(F.array(*entries).alias("m")).select(F.inline("m"))


def outlier_share(
    df: DataFrame, target: str, prediction: str, thresholds: Sequence[int] = OUTLIER_PERCENT
) -> DataFrame:
    """Percent of all rows whose percentage error exceeds each threshold."""
    ape = percentage_error(target, prediction)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *(outlier_percent(ape, k).alias(f"outliers_{k}") for k in thresholds),
    )


def error_means(
    df: DataFrame, target: str, prediction: str, first_id: str, by: Sequence[str]
) -> DataFrame:
    """MAPE, MAE and number of rows with an id, per group of ``by``."""
    return df.groupBy(*by).agg(
        F.avg(percentage_error(target, prediction)).alias("mape"),
        F.avg(absolute_error(target, prediction)).alias("mae"),
        F.count(first_id).alias("row_count"),
    )
