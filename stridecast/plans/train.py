"""Training: one preparation and one forest per fold and variant."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stridecast.config import BASIC, FULL, FeatureSpec, ForestParams
from stridecast.functions.dates import Day, as_date
from stridecast.functions.parallel import run_all
from stridecast.operators.evaluate import error_means
from stridecast.operators.forest import FoldModel, regressor, score_routed, with_vectors
from stridecast.operators.prep import fold_preparation
from stridecast.operators.reports import date_range
from stridecast.operators.split import (
    fold_variant,
    lacks,
    project_fold,
    sample_training,
    train_rows,
)
from stridecast.sources.artifacts import execution_path, save_models
from stridecast.sources.shared import staged


@dataclass(frozen=True)
class Training:
    models: list[FoldModel]
    metrics: DataFrame
    errors: DataFrame | None
    path: str | None


def training_set(
    data: DataFrame,
    spec: FeatureSpec,
    split: Day,
    training_sample: float = 1.0,
    sample_keys: Sequence[str] = (),
) -> DataFrame:
    """The sampled rows before the split, with the columns any fold needs."""
    columns = dict.fromkeys([*spec.ids, spec.date, spec.target, *spec.inputs()])
    rows = train_rows(data.select(*columns), spec.date, split)
    return sample_training(rows, training_sample, sample_keys)


def spread_evenly(
    rows: DataFrame, ids: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Partitions of like size, in the order of the ids.

    The forest draws its bags row by row, so with rows placed and ordered by id a
    second run draws the same ones.
    """
    if partitions:
        placed = rows.repartition(partitions, *ids)
    else:
        placed = rows.hint("rebalance", *ids)
    return placed.sortWithinPartitions(*ids)


def training_frame(rows: DataFrame, spec: FeatureSpec, fold: int, variant: str) -> DataFrame:
    """Training rows of one model.

    A basic model learns from all rows that have its own, fewer features, however many
    of them lack another; so scoring always finds a basic model.
    """
    if variant == BASIC:
        frame = project_fold(rows, spec, fold, BASIC)
        return frame.where(~lacks(frame, spec.numeric(fold, BASIC)))
    return fold_variant(rows, spec, fold, variant)


def fit_preparation(
    rows: DataFrame, spec: FeatureSpec, fold: int, variant: str = FULL
) -> PipelineModel:
    return fold_preparation(spec, fold, variant).fit(training_frame(rows, spec, fold, variant))


def fit_fold(
    rows: DataFrame, spec: FeatureSpec, params: ForestParams, fold: int, variant: str = FULL
) -> FoldModel:
    """One model alone; ``train`` prepares the rows of all models in one pass instead."""
    prep = fit_preparation(rows, spec, fold, variant)
    frame = prep.transform(training_frame(rows, spec, fold, variant))
    return FoldModel(fold, variant, prep, regressor(spec, params).fit(frame))


@dataclass(frozen=True)
class Prepared:
    """The preparations of all models by their numeric inputs, and the rows in vectors.

    Models with the same inputs learn from the same rows with the same seed, so they are
    equal, whatever their folds and variants: they share one preparation and one fit.
    ``vectors`` names each preparation's column of ``rows``, by its uid.
    """

    preps: dict[tuple[str, ...], PipelineModel]
    vectors: dict[str, str]
    rows: DataFrame

    def on(self, rows: DataFrame) -> Prepared:
        return replace(self, rows=rows)


def prepare_all(rows: DataFrame, spec: FeatureSpec, parallelism: int) -> Prepared:
    """Fits the preparations. The rows have what fits and training errors need: first id,
    target, numeric inputs and one vector per preparation. They are lazy."""
    first_with: dict[tuple[str, ...], tuple[int, str]] = {}
    for fold in spec.folds:
        for variant in spec.variants:
            first_with.setdefault(tuple(spec.numeric(fold, variant)), (fold, variant))
    distinct = list(first_with)
    fitted = run_all(
        rows.sparkSession,
        lambda inputs: fit_preparation(rows, spec, *first_with[inputs]),
        distinct,
        parallelism,
    )
    vectors = {p.uid: f"_features_{i}" for i, p in enumerate(fitted)}
    needed = dict.fromkeys([spec.ids[0], spec.target, *(c for inputs in distinct for c in inputs)])
    frame = with_vectors(rows, fitted, list(vectors.values())).select(*needed, *vectors.values())
    return Prepared(dict(zip(distinct, fitted, strict=True)), vectors, frame)


def fit_all(
    prepared: Prepared, spec: FeatureSpec, params: ForestParams, parallelism: int
) -> list[FoldModel]:
    """Every fold's models, from rows that are prepared: a fit reads its target and vector."""
    rows = prepared.rows

    def grown(inputs: tuple[str, ...]) -> RandomForestRegressionModel:
        vector = F.col(prepared.vectors[prepared.preps[inputs].uid]).alias("features")
        known = rows.where(~lacks(rows, inputs))
        return regressor(spec, params).fit(known.select(spec.target, vector))

    distinct = list(prepared.preps)
    forests = run_all(rows.sparkSession, grown, distinct, parallelism)
    forest_of = dict(zip(distinct, forests, strict=True))
    models = []
    for fold in spec.folds:
        for variant in spec.variants:
            inputs = tuple(spec.numeric(fold, variant))
            models.append(FoldModel(fold, variant, prepared.preps[inputs], forest_of[inputs]))
    return models


def training_error(
    models: Sequence[FoldModel],
    rows: DataFrame,
    spec: FeatureSpec,
    folds: Sequence[int] | None = None,
    vectors: Mapping[str, str] | None = None,
) -> DataFrame:
    """MAPE, MAE and row count on the training rows, by fold and variant.

    For the first and last fold unless others are asked for. The rows are read once:
    each is scored by its model of every judged fold. A model without rows has count 0
    and null errors. Rows no model can score are left out. ``vectors`` tells the columns
    of rows that are prepared, see ``Prepared``; else the rows are prepared here.
    """
    folds = {spec.folds[0], spec.folds[-1]} if folds is None else set(folds)
    judged = [m for m in models if m.fold in folds]
    names = rows.sparkSession.createDataFrame(
        [(m.fold, m.variant) for m in judged], "fold int, variant string"
    )
    inputs = [c for m in judged for c in spec.numeric(m.fold, m.variant)]
    lacking = {f: lacks(rows, spec.numeric(f, FULL)) for f in folds}
    if vectors is None:
        inputs += spec.categorical
    else:
        inputs += [vectors[m.prep.uid] for m in judged]
    scored = rows.select(*dict.fromkeys([spec.ids[0], spec.target, *inputs]))
    parts = []
    for fold in sorted({m.fold for m in judged}):
        routes = {}
        for m in (m for m in judged if m.fold == fold):
            able = ~lacks(rows, spec.numeric(fold, m.variant))
            routes[m.variant] = able & (lacking[fold] if m.variant == BASIC else ~lacking[fold])
        name = f"_predicted_{fold}"
        branches = [(routes[m.variant], m) for m in judged if m.fold == fold]
        scored = score_routed(scored, branches, name, vectors)
        for variant, route in routes.items():
            part = F.struct(
                F.lit(fold).alias("fold"), F.lit(variant).alias("variant"), F.col(name).alias("value")
            )
            parts.append(F.when(route, part))
    found = scored.select(
        *dict.fromkeys([spec.ids[0], spec.target]), F.explode(F.array_compact(F.array(*parts))).alias("part")
    ).select(
        *dict.fromkeys([spec.ids[0], spec.target]), "part.fold", "part.variant", F.col("part.value").alias(spec.prediction)
    )
    report = error_means(found, spec.target, spec.prediction, spec.ids[0], ["fold", "variant"])
    return names.join(report, ["fold", "variant"], "left").fillna(0, ["row_count"])


def training_metrics(
    rows: DataFrame, spec: FeatureSpec, params: ForestParams, training_sample: float
) -> DataFrame:
    """The settings of the run and the date range it learned from, in one row."""
    # The names of the settings and metrics.
    return date_range(rows, spec.date).select(
        F.lit(spec.target).alias("col_target"),
        F.lit(params.num_trees).alias("num_trees"),
        F.lit(params.max_depth).alias("max_depth"),
        F.lit(str(params.max_features)).alias("max_features"),
        F.lit(float(params.subsampling_rate)).alias("subsampling_rate"),
        F.lit(params.min_samples_leaf).alias("min_samples_leaf"),
        F.lit(float(training_sample)).alias("training_sample"),
        F.col("date_min").alias("train_date_min"),
        F.col("date_max").alias("train_date_max"),
    )


def _gathered(df: DataFrame) -> DataFrame:
    """A report of a few rows as a local table, free of the plan that made it."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def train(
    data: DataFrame,
    spec: FeatureSpec,
    split: Day = None,
    params: ForestParams = ForestParams(),
    training_sample: float = 1.0,
    sample_keys: Sequence[str] = (),
    root: str | None = None,
    checks: bool = False,
    parallelism: int = 4,
    fit_partitions: int | None = None,
    spread: bool = True,
) -> Training:
    """Fits every fold's models on the rows before ``split`` (today if not given).

    All folds share their training rows, so these are prepared once: spread
    evenly and written to the shared folder, with the columns that some fold needs. Rows
    without target and the days of the rest are noted while it is written. The vectors of
    all models are then made in one pass and written too; each fit reads its own column of
    that table, and nothing is cached beside it. ``parallelism`` models are fitted at a time to keep the cluster busy
    while one of them grows its last tree levels. ``fit_partitions`` fixes the
    number of partitions, which otherwise follows the size of the rows; with
    ``spread`` off, rows that are even already are not shuffled. Models are saved
    below ``root`` if given. Training rows without the target are an error.
    """
    split = as_date(split)
    spark = data.sparkSession
    rows = training_set(data, spec, split, training_sample, sample_keys)
    if spread:
        rows = spread_evenly(rows, spec.ids, fit_partitions)
    seen, day = Observation(), F.to_date(spec.date)
    rows = rows.observe(
        seen,
        F.coalesce(F.count_if(lacks(rows, [spec.target])), F.lit(0)).alias("lost"),
        F.min(day).alias("first"),
        F.max(day).alias("last"),
    )
    with staged(rows, "training") as rows:
        if seen.get["lost"]:
            raise ValueError(f"{seen.get['lost']} training rows have no {spec.target}")
        prepared = prepare_all(rows, spec, parallelism)
        with staged(prepared.rows, "prepared") as known:
            models = fit_all(prepared.on(known), spec, params, parallelism)
            errors = None
            if checks:
                errors = _gathered(training_error(models, known, spec, vectors=prepared.vectors))
        days = [(seen.get["first"],), (seen.get["last"],)]
        days = spark.createDataFrame(days, f"`{spec.date}` date")
        metrics = _gathered(training_metrics(days, spec, params, training_sample))
    path = None
    if root is not None:
        path = execution_path(root, spec.target, split)
        save_models(spark, models, path)
    return Training(models, metrics, errors, path)
