"""Random-forest regression per fold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridecast.config import FULL, FeatureSpec, ForestParams
from stridecast.functions.dates import Day
from stridecast.operators.indexing import TableIndexerModel
from stridecast.operators.reports import tag_execution


@dataclass(frozen=True)
class FoldModel:
    """What one fold's full or basic forecast needs."""

    fold: int
    variant: str
    prep: PipelineModel
    forest: RandomForestRegressionModel


def subset_strategy(max_features: str | int | float) -> str:
    """Features tried per split: a named rule, a number of them, or a share.

    Spark reads "1" as one feature and "1.0" as all, so the type decides here.
    """
    named = {"auto", "all", "sqrt", "log2", "onethird"}
    if isinstance(max_features, str):
        text = max_features.strip()
        if text in named:
            return text
        max_features = int(text) if text.isdigit() else float(text)
    if isinstance(max_features, int):
        if max_features < 1:
            raise ValueError("the number of features must be positive")
        return str(max_features)
    if not 0 < max_features <= 1:
        raise ValueError("the share of features must lie in (0, 1]")
    return f"{max_features:.10f}"


def regressor(spec: FeatureSpec, params: ForestParams) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=spec.target,
        featuresCol="features",
        predictionCol=spec.prediction,
        numTrees=params.num_trees,
        maxDepth=params.max_depth,
        featureSubsetStrategy=subset_strategy(params.max_features),
        subsamplingRate=params.subsampling_rate,
        minInstancesPerNode=params.min_samples_leaf,
        seed=params.seed,
        maxMemoryInMB=params.max_memory_mb,
        cacheNodeIds=params.cache_node_ids,
        bootstrap=params.bootstrap,
    )


def score(model: FoldModel, frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns of the frame with the model's prediction. Lazy."""
    scored = model.forest.transform(model.prep.transform(frame))
    return scored.select(
        *columns,
        model.forest.getPredictionCol(),
        F.lit(model.fold).alias("fold"),
        F.lit(model.variant).alias("variant"),
    )


class SharedEncodings:
    """Categories of several preparations: equal label lists give one index and one encoding."""

    def __init__(self, frame: DataFrame):
        self.frame = frame
        self._numbers: dict[tuple, int] = {}

    def inputs(self, prep: PipelineModel) -> list[str]:
        """The columns that the vector is made of; encodes the categories if new."""
        *encoders, assembler = prep.stages
        inputs = assembler.getInputCols()
        if not encoders:
            return inputs
        indexer, one_hot = encoders
        in_tables = isinstance(indexer, TableIndexerModel)
        labels = indexer.identity if in_tables else tuple(map(tuple, indexer.labelsArray))
        key = (tuple(indexer.getInputCols()), labels)
        number = self._numbers.get(key)
        if number is None:
            number = self._numbers[key] = len(self._numbers)
            named = {"index": indexer.getOutputCols(), "slots": one_hot.getOutputCols()}
            named = {kind: [f"_{c}_{kind}_{number}" for c in cols] for kind, cols in named.items()}
            indexed = indexer.copy().setOutputCols(named["index"]).transform(self.frame)
            encoder = one_hot.copy().setInputCols(named["index"]).setOutputCols(named["slots"])
            self.frame = encoder.transform(indexed).drop(*named["index"])
        encoded = set(one_hot.getOutputCols())
        return [f"_{c}_slots_{number}" if c in encoded else c for c in inputs]


def with_vectors(
    rows: DataFrame, preps: Sequence[PipelineModel], names: Sequence[str]
) -> DataFrame:
    """``rows`` with the features of each preparation, one vector column each. Lazy.

    Every row gets all vectors; a feature that it lacks is NaN there. Preparations are
    those of ``prep.preparation``.
    """
    encodings = SharedEncodings(rows)
    inputs = [encodings.inputs(p) for p in preps]
    frame = encodings.frame
    for name, columns in zip(names, inputs, strict=True):
        assembler = VectorAssembler(inputCols=columns, outputCol=name, handleInvalid="keep")
        frame = assembler.transform(frame)
    return frame.select(*rows.columns, *names)


class SharedPreparation:
    """The inputs of several models in one vector, so that a row is prepared once.

    Numeric columns are taken once; equal label lists give one index and one encoding.
    ``slots`` tells which entries of the vector are one model's features.
    """

    VECTOR = "_all_features"

    def __init__(self, frame: DataFrame, models: Sequence[FoldModel]):
        self._places: dict[str, range] = {}
        encodings = SharedEncodings(frame)
        own = [encodings.inputs(m.prep) for m in models]
        self.frame = encodings.frame
        columns = list(dict.fromkeys(c for inputs in own for c in inputs))
        at = 0
        for c in columns:
            attributes = self.frame.schema[c].metadata.get("ml_attr", {})
            size = attributes.get("num_attrs", 1) if c not in frame.columns else 1
            self._places[c] = range(at, at + size)
            at += size
        # A row may lack a feature of another model than its own.
        assembler = VectorAssembler(inputCols=columns, outputCol=self.VECTOR, handleInvalid="keep")
        self.frame = assembler.transform(self.frame).select(*frame.columns, self.VECTOR)
        self._own = {id(m.prep): inputs for m, inputs in zip(models, own, strict=True)}

    def slots(self, model: FoldModel) -> list[int]:
        return [i for c in self._own[id(model.prep)] for i in self._places[c]]


def score_routed(
    rows: DataFrame,
    branches: Sequence[tuple[Column, FoldModel]],
    output: str,
    vectors: Mapping[str, str] | None = None,
) -> DataFrame:
    """``rows`` with the prediction of the model whose condition holds; null if none does.

    One scan and one projection for all models. Each prediction is used in one branch of
    a CASE and nowhere else, so the optimizer moves it there, and a row passes through
    its own model's trees alone. Conditions should exclude each other; models that are
    the same object share a branch. Preparations are those of ``prep.preparation``; rows
    that hold their vectors already are told by ``vectors``, the column of each by its uid.
    """
    merged: dict[tuple[int, int], tuple[Column, FoldModel]] = {}
    for condition, model in branches:
        key = (id(model.prep), id(model.forest))
        known = merged.get(key)
        merged[key] = (known[0] | condition if known else condition, model)
    if not merged:
        return rows.withColumn(output, F.lit(None).cast("double"))
    frame, shared = rows, None
    if vectors is None:
        shared = SharedPreparation(rows, [model for _, model in merged.values()])
        frame = shared.frame
    chosen, kept = F.lit(None).cast("double"), list(frame.columns)
    for i, (condition, model) in enumerate(reversed(merged.values())):
        name = f"_{output}_{i}"
        if shared is None:
            vector = vectors[model.prep.uid]
        else:
            vector, slots = f"_{output}_features", shared.slots(model)
            slicer = VectorSlicer(inputCol=shared.VECTOR, outputCol=vector, indices=slots)
            frame = slicer.transform(frame)
        forest = model.forest.copy().setFeaturesCol(vector)
        done = forest.transform(frame)
        frame = done.select(*kept, F.col(forest.getPredictionCol()).alias(name))
        kept.append(name)
        chosen = F.when(condition, F.col(name)).otherwise(chosen)
    return frame.select(*rows.columns, chosen.alias(output))


def feature_names(transformed: DataFrame, vector: str = "features") -> list[tuple[int, str]]:
    """Slot number and name of each vector entry, from whatever attribute groups exist."""
    groups = transformed.schema[vector].metadata["ml_attr"]["attrs"].values()
    named = ((a["idx"], a.get("name", f"{vector}_{a['idx']}")) for g in groups for a in g)
    return sorted(named)


def importance_rows(model: FoldModel, frame: DataFrame) -> list[tuple[int, int, int, str, float]]:
    """Fold, rank, slot, name and importance of every feature slot, most important first.

    Needs the schema of ``frame`` and the fitted model, not the data.
    """
    values = model.forest.featureImportances.toArray()
    empty = frame.sparkSession.createDataFrame([], frame.schema)
    named = feature_names(model.prep.transform(empty))
    ranked = sorted(named, key=lambda slot_name: (-values[slot_name[0]], slot_name[0]))
    return [
        (model.fold, rank, slot, name, float(values[slot]))
        for rank, (slot, name) in enumerate(ranked, 1)
    ]


def importances(model: FoldModel, frame: DataFrame) -> DataFrame:
    """One row per feature slot of one model, most important first."""
    return _importance_table(frame.sparkSession, importance_rows(model, frame)).drop("fold")


def importance_report(
    models: Sequence[FoldModel], frame: DataFrame, target: str, execution: Day
) -> DataFrame:
    """Importances of every full model, with ``model`` telling the first and last fold."""
    full = sorted((m for m in models if m.variant == FULL), key=lambda m: m.fold)
    rows = [r for m in full for r in importance_rows(m, frame)]
    fold = F.col("fold")
    table = _importance_table(frame.sparkSession, rows).withColumns(
        {
            "model": F.when(fold == full[0].fold, "first").when(fold == full[-1].fold, "last"),
            "target_variable": F.lit(target),
        }
    )
    return tag_execution(table, execution)


def _importance_table(
    spark: SparkSession, rows: Sequence[tuple[int, int, int, str, float]]
) -> DataFrame:
    schema = "fold int, rank int, idx int, variable string, importance double"
    return spark.createDataFrame(list(rows), schema).orderBy("fold", "rank")
