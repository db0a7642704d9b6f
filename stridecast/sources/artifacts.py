"""Where the models of one execution live."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import SparkSession

from stridecast.config import BASIC, FULL, FeatureSpec
from stridecast.functions.dates import Day, as_date
from stridecast.functions.parallel import run_all
from stridecast.operators.forest import FoldModel

# The folder layout of saved models.
MODELS_FOLDER = "pipelines"
EXECUTION_FOLDER = "dt-execution="
PREP_NAME = {FULL: "data_prep_pipeline", BASIC: "data_prep_basic_pipeline"}
MODEL_NAME = {FULL: "model_pipeline", BASIC: "model_basic_pipeline"}

# A model is many small files; saving or loading them is all latency.
FILES_AT_A_TIME = 8


def execution_path(root: str, target: str, execution: Day) -> str:
    day = as_date(execution).isoformat()
    return "/".join([root.rstrip("/"), MODELS_FOLDER, target, EXECUTION_FOLDER + day])


def save_models(spark: SparkSession, models: Iterable[FoldModel], path: str) -> None:
    def save(m: FoldModel) -> None:
        m.prep.write().overwrite().save(f"{path}/{PREP_NAME[m.variant]}{m.fold}")
        m.forest.write().overwrite().save(f"{path}/{MODEL_NAME[m.variant]}{m.fold}")

    run_all(spark, save, models, FILES_AT_A_TIME)


def load_models(spark: SparkSession, path: str, spec: FeatureSpec) -> list[FoldModel]:
    """The models of every fold and variant the spec names."""

    def load(fold_variant: tuple[int, str]) -> FoldModel:
        fold, variant = fold_variant
        return FoldModel(
            fold,
            variant,
            PipelineModel.load(f"{path}/{PREP_NAME[variant]}{fold}"),
            RandomForestRegressionModel.load(f"{path}/{MODEL_NAME[variant]}{fold}"),
        )

    wanted = [(fold, variant) for fold in spec.folds for variant in spec.variants]
    return run_all(spark, load, wanted, FILES_AT_A_TIME)
