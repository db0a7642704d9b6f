"""Model inputs: string index, one-hot, feature vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.config import FULL, INDEX, ONE_HOT, FeatureSpec
from stridecast.operators.indexing import TableIndexer


def string_indexer(columns: Sequence[str]) -> StringIndexer:
    """Most frequent label first, ties in label order; anything unseen or null last."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[c + INDEX for c in columns], handleInvalid="keep"
    )


def table_indexer(columns: Sequence[str]) -> TableIndexer:
    """The same index from a table of labels, for columns with very many of them."""
    return TableIndexer(inputCols=list(columns), outputCols=[c + INDEX for c in columns])


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """One slot per label of the string index, and one for unseen or null."""
    return OneHotEncoder(
        inputCols=[c + INDEX for c in columns],
        outputCols=[c + ONE_HOT for c in columns],
        dropLast=True,
        handleInvalid="keep",
    )


def preparation(
    numeric: Sequence[str], categorical: Sequence[str] = (), label_tables: bool = False
) -> Pipeline:
    """Unfitted stages from raw columns to ``features``.

    With ``label_tables`` the labels of the categories stay in tables, and neither the
    driver nor the tasks hold a list of them.
    """
    stages = []
    if categorical:
        indexer = table_indexer if label_tables else string_indexer
        stages = [indexer(categorical), one_hot_encoder(categorical)]
    inputs = [*numeric, *(c + ONE_HOT for c in categorical)]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features")])


def fold_preparation(spec: FeatureSpec, fold: int, variant: str = FULL) -> Pipeline:
    return preparation(spec.numeric(fold, variant), spec.categorical, spec.label_tables)


def slots(df: DataFrame, vector: str, prefix: str) -> DataFrame:
    """Replaces a vector column by one double column per slot, as many as its metadata says."""
    size = df.schema[vector].metadata["ml_attr"]["num_attrs"]
    values = vector_to_array(F.col(vector))
    return df.withColumns({f"{prefix}{i}": values[i] for i in range(size)}).drop(vector)
