"""A string index whose labels are a table, for columns with more labels than a driver holds.

``TableIndexer`` gives the index that ``StringIndexer`` gives: most frequent label first,
ties in label order, null and anything unseen last. Its model holds the path of a Parquet
table ``label, place, _rows``, which it attaches to the rows by a join. The table goes
where the model is saved, so the model can be a stage of a saved ``PipelineModel``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.operators.features import numbered
from stridecast.operators.lookup import BROADCAST_BYTES, ROWS_PER_TASK, attach
from stridecast.sources.shared import shared_folder


class _Columns(HasInputCols, HasOutputCols):
    def setInputCols(self, value: Sequence[str]):
        return self._set(inputCols=list(value))

    def setOutputCols(self, value: Sequence[str]):
        return self._set(outputCols=list(value))


class TableIndexer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Counts the labels of each column and writes their table to the shared folder.

    Labels are ranked by ranges of (rows, label), so neither the driver nor one task has
    all of them. Values are compared as text, as ``StringIndexer`` does.
    """

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TableIndexerModel:
        tables, sizes = [], []
        for column in self.getInputCols():
            label = F.col(column).cast("string").alias("label")
            counts = dataset.select(label).where("label is not null").groupBy("label")
            labels = counts.agg(F.count(F.lit(1)).alias("_rows"))
            ranked = numbered(labels, [F.desc("_rows"), F.asc("label")], "place")
            path = shared_folder(dataset.sparkSession, "labels")
            ranked.select("label", "place", "_rows").write.parquet(path)
            tables.append(path)
            sizes.append(ranked.count())
        model = TableIndexerModel(tables=tables, sizes=sizes)
        return self._copyValues(model)


class TableIndexerModel(Model, _Columns, MLReadable, MLWritable):
    """Adds the index of each column: a double, with the number of indices as metadata."""

    tables = Param(Params._dummy(), "tables", "path of each column's labels", TypeConverters.toListString)
    sizes = Param(Params._dummy(), "sizes", "labels of each column", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, tables: list[str] | None = None, sizes: list[int] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def identity(self) -> tuple:
        """Equal for models that give equal indices."""
        return tuple(self.getOrDefault(self.tables))

    def _transform(
        self, dataset: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, rows_per_task: int = ROWS_PER_TASK
    ) -> DataFrame:
        spark, found = dataset.sparkSession, dataset
        tables, sizes = self.getOrDefault(self.tables), self.getOrDefault(self.sizes)
        for own, name, path, size in zip(self.getInputCols(), self.getOutputCols(), tables, sizes, strict=True):
            schema = "label string, place bigint, _rows bigint"
            labels = spark.read.schema(schema).parquet(path).withColumnsRenamed({"label": "_label", "place": "_place"})
            keyed = found.withColumn("_label", F.col(own).cast("string"))
            placed = attach(keyed, labels, ["_label"], "_rows", broadcast_bytes, rows_per_task, "left")
            index = F.coalesce("_place", F.lit(size)).cast("double")
            # The last index is that of null and of anything unseen.
            attributes = {"ml_attr": {"type": "nominal", "name": name, "num_vals": size + 1}}
            found = placed.withColumn(name, index.alias(name, metadata=attributes)).drop("_label", "_place")
        return found

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, instance: TableIndexerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        for i, table in enumerate(self.instance.getOrDefault(self.instance.tables)):
            spark.read.parquet(table).write.parquet(f"{path}/labels-{i}")


class _ModelReader(MLReader):
    def load(self, path: str) -> Any:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TableIndexerModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        tables = [f"{path}/labels-{i}" for i in range(len(model.getOrDefault(model.tables)))]
        return model._set(tables=tables)
