"""Prediction: every test row scored by the model of its fold and variant."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.config import BASIC, FOLD_START_DAYS, FULL, MONTHS_AHEAD, UNSCORED, FeatureSpec
from stridecast.functions.dates import Day, as_date, before, typed
from stridecast.operators.folds import assign_fold, fold_number, in_horizon
from stridecast.operators.forest import FoldModel, importance_report, score_routed
from stridecast.operators.reports import Seen, month_report, prediction_metrics, tag_execution
from stridecast.operators.split import lacks
from stridecast.plans.backtest import backtest as run_backtest
from stridecast.sources.artifacts import execution_path, load_models
from stridecast.sources.results import csv_path, read_predictions, write_csv, write_predictions


@dataclass(frozen=True)
class Prediction:
    results: DataFrame
    importances: DataFrame
    metrics: DataFrame | None
    months: DataFrame | None
    backtest: DataFrame | None


def _columns(spec: FeatureSpec) -> list[str]:
    return list(dict.fromkeys([*spec.ids, spec.date]))


def union_results(parts: Sequence[DataFrame]) -> DataFrame:
    """Results of all models in one table, columns matched by name."""
    table, *others = parts
    for part in others:
        table = table.unionByName(part)
    return table


def horizon_rows(
    data: DataFrame,
    spec: FeatureSpec,
    split: Day,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> DataFrame:
    """The rows of any fold, with the columns any model needs."""
    columns = dict.fromkeys([*_columns(spec), *spec.inputs()])
    date = typed(data, spec.date)
    return data.select(*columns).where(in_horizon(date, split, starts, months_ahead))


def rows_to_score(
    data: DataFrame,
    spec: FeatureSpec,
    split: Day,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> DataFrame:
    """The rows of any fold as they come in, with ``fold`` and ``is_basic``: whether they
    lack a feature of their fold's full model."""
    rows = assign_fold(data, spec.date, split, starts, months_ahead)
    is_basic = F.lit(False)
    for fold in spec.folds:
        is_basic = F.when(F.col("fold") == fold, lacks(rows, spec.numeric(fold))).otherwise(is_basic)
    return rows.withColumn("is_basic", is_basic)


def predictions(
    data: DataFrame,
    spec: FeatureSpec,
    models: Sequence[FoldModel],
    split: Day,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
    seen: Seen | None = None,
) -> DataFrame:
    """Ids, date and prediction of every test row, with its fold and variant. Lazy.

    One scan and one projection, whatever the number of models: a row's fold and the
    features it lacks tell its model, and only that one is computed for it. Rows that lack
    a feature go to the basic model. Rows it cannot score either, or all of them where
    there is none, keep their place with a null prediction. ``seen`` counts the rows while
    they pass.
    """
    if len(starts) != len(spec.features):
        raise ValueError("the calendar and the spec differ in their number of folds")
    of = {(m.fold, m.variant): m for m in models}
    for fold in spec.folds:
        if (fold, FULL) not in of:
            raise ValueError(f"fold {fold} has no model")
    rows = horizon_rows(data, spec, split, starts, months_ahead)
    rows = rows.withColumn("fold", fold_number(typed(rows, spec.date), split, starts))
    variant = F.lit(UNSCORED)
    for fold in spec.folds:
        own = F.when(~lacks(rows, spec.numeric(fold, FULL)), FULL)
        if (fold, BASIC) in of:
            own = own.when(~lacks(rows, spec.numeric(fold, BASIC)), BASIC)
        variant = F.when(F.col("fold") == fold, own.otherwise(UNSCORED)).otherwise(variant)
    branches = [
        ((F.col("fold") == fold) & (F.col("variant") == kind), model)
        for (fold, kind), model in of.items()
        if fold in spec.folds
    ]
    rows = rows.withColumn("variant", variant)
    if seen is not None:
        rows = seen.tests(rows, F.col("variant") != FULL)
    scored = score_routed(rows, branches, spec.prediction)
    results = scored.select(*_columns(spec), spec.prediction, "fold", "variant")
    results = tag_execution(results, split, spec.date)
    return results if seen is None else seen.scored(results, spec.date)


def predict(
    data: DataFrame,
    spec: FeatureSpec,
    first_day: Day = None,
    models: Sequence[FoldModel] | None = None,
    root: str | None = None,
    dt_execution: Day = None,
    keys: Sequence[str] | None = None,
    checks: bool = False,
    csv: bool = False,
    starts: tuple[int, ...] = FOLD_START_DAYS,
    months_ahead: int = MONTHS_AHEAD,
) -> Prediction:
    """Scores the days from ``first_day`` (today if not given) to the horizon's end.

    Uses the given models, or those saved below ``root`` by the training of
    ``dt_execution`` (``first_day`` if not given). With ``root``, predictions are
    written below it as a partition of the execution and the importances as CSV.
    ``results`` then reads what was written, so that the reports of ``checks`` do not
    score again; rows are counted while they are written, and ``data`` is not read again.
    ``csv`` writes the predictions as CSV as well. Without ``root`` all is lazy.
    ``keys`` identify a row for the duplicate check. With ``checks``, ``root`` and the
    target in ``data``, the executions before ``first_day`` that are below ``root`` are
    judged too, on the rows of ``data`` before that day that have the target, whatever
    horizon they were made with.
    """
    spark = data.sparkSession
    first_day = as_date(first_day)
    if models is None:
        if root is None:
            raise ValueError("predict needs models, or the root folder they are saved in")
        trained = first_day if dt_execution is None else dt_execution
        models = load_models(spark, execution_path(root, spec.target, trained), spec)
    report = importance_report(models, data, spec.target, first_day)
    seen = Seen() if checks and root is not None else None
    if root is None:
        results = predictions(data, spec, models, first_day, starts, months_ahead)
    else:
        scored = predictions(data, spec, models, first_day, starts, months_ahead, seen)
        write_predictions(scored, root, spec.target, execution=first_day)
        results = read_predictions(spark, root, spec.target, [first_day], schema=scored.schema)
        write_csv(report, csv_path(root, spec.target, "feat_importance", first_day))
        if csv:
            write_csv(results, csv_path(root, spec.target, "results", first_day))
    metrics = months = past_errors = None
    if checks:
        if seen is not None:
            metrics = seen.metrics(results, keys or spec.ids)
        else:
            tests = rows_to_score(data, spec, first_day, starts, months_ahead)
            metrics = prediction_metrics(results, tests, keys or spec.ids, spec.date)
        months = month_report(results, spec.date, spec.ids[0], spec.prediction)
        if root is not None and spec.target in data.columns:
            past = read_predictions(spark, root, spec.target, schema=results.schema)
            known = data.where(before(typed(data, spec.date), first_day) & F.col(spec.target).isNotNull())
            past_errors = run_backtest(
                past.where(before("dt_execution", first_day)), known, spec.ids, spec.target, spec.date
            )
    return Prediction(results, report, metrics, months, past_errors)
