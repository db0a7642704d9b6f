import pytest
from helpers import rows
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array

from stridecast.operators.prep import one_hot_encoder, preparation, slots, string_indexer


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([("b",), ("b",), ("a",), ("a",), ("c",)], "c string")


def test_most_frequent_label_first_ties_in_order(labels):
    model = string_indexer(["c"]).fit(labels)
    assert list(model.labelsArray[0]) == ["a", "b", "c"]
    assert set(rows(model.transform(labels))) == {("a", 0.0), ("b", 1.0), ("c", 2.0)}


def test_unseen_and_null_share_the_last_index_and_slot(spark, labels):
    model = Pipeline(stages=[string_indexer(["c"]), one_hot_encoder(["c"])]).fit(labels)
    new = spark.createDataFrame([("b",), ("zz",), (None,), ("c",)], "c string")
    out = model.transform(new)
    got = {r.c: (r.c_tmp, r.v) for r in out.withColumn("v", vector_to_array("c_catVec")).collect()}
    assert got == {
        "b": (1.0, [0, 1, 0, 0]),
        "zz": (3.0, [0, 0, 0, 1]),
        None: (3.0, [0, 0, 0, 1]),
        "c": (2.0, [0, 0, 1, 0]),
    }


def test_features_keep_their_order(spark, labels):
    df = labels.selectExpr("c", "2.5D as x", "1 as y")
    out = preparation(["y", "x"], ["c"]).fit(df).transform(df)
    out = slots(out.where("c = 'c'").select("c", "features"), "features", "f")
    assert tuple(out.first()) == ("c", 1.0, 2.5, 0.0, 0.0, 1.0, 0.0)


def test_without_categories_there_is_no_indexer(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert preparation(["x", "y"]).fit(df).transform(df).first().features.toArray().tolist() == [1, 2]


def test_a_null_feature_fails(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with pytest.raises(Exception, match="[Nn]ull"):
        preparation(["x"]).fit(df).transform(df).collect()
