"""The index from a table of labels, against the one with a list of labels."""

from functools import partial

import pytest
from helpers import plan, rows
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from stridecast.config import FeatureSpec, ForestParams
from stridecast.operators import indexing
from stridecast.operators.indexing import TableIndexer
from stridecast.operators.prep import one_hot_encoder, preparation, string_indexer, table_indexer
from stridecast.plans.predict import predictions
from stridecast.plans.train import train
from stridecast.sources.artifacts import execution_path, load_models


@pytest.fixture(scope="module")
def data(spark):
    """A hot label, ties, nulls, an empty label, numbers as labels."""
    return spark.range(3000).selectExpr(
        "id",
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null when id % 50 = 2 then '' else concat('k', id % 97) end as k",
        "cast(id % 700 as int) as n",
        "`id` as place",
    ).cache()


@pytest.fixture(scope="module")
def new(spark, data):
    more = spark.sql("select 5000L as id, 'unseen' as k, -1 as n, 1L as place union all select null, null, null, null")
    return data.unionByName(more).cache()


def indexed(model, df):
    return rows(model.transform(df), "id", "k_tmp", "n_tmp")


def test_same_index_as_with_a_list(data, new):
    table, plain = table_indexer(["k", "n"]).fit(data), string_indexer(["k", "n"]).fit(data)
    assert indexed(table, new) == indexed(plain, new)
    assert table.transform(new).columns == [*new.columns, "k_tmp", "n_tmp"]


def test_same_slots_as_with_a_list(data, new):
    slots = []
    # The encoder refuses an empty name among listed labels.
    data, new = data.where("k <> '' or k is null"), new.where("k <> '' or k is null")
    for indexer in (table_indexer(["k"]), string_indexer(["k"])):
        out = Pipeline(stages=[indexer, one_hot_encoder(["k"])]).fit(data).transform(new)
        slots.append(rows(out.select("id", F.col("k_catVec").cast("string"))))
    assert slots[0] == slots[1]


def test_hot_labels_are_split(spark, data, new, monkeypatch):
    model, plain = table_indexer(["k", "n"]).fit(data), string_indexer(["k", "n"]).fit(data)
    monkeypatch.setattr(indexing, "attach", lambda *a: __import__("stridecast.operators.lookup", fromlist=["attach"]).attach(*a[:4], -1, 100, "left"))
    assert indexed(model, new) == indexed(plain, new)
    assert "Broadcast" in plan(model.transform(new))  # the salts of hot labels alone


def test_no_list_on_the_driver(data):
    model = table_indexer(["n"]).fit(data)
    assert model.getOrDefault(model.sizes) == [700]
    assert {p.name for p in model.params} == {"inputCols", "outputCols", "tables", "sizes"}
    text = plan(model.transform(data))
    assert "UDF" not in text and "k96" not in text


def test_saved_in_a_pipeline(spark, data, new, root):
    fitted = preparation(["place"], ["k"], label_tables=True).fit(data)
    fitted.write().save(root + "/prep")
    loaded = PipelineModel.load(root + "/prep")
    tables = loaded.stages[0].getOrDefault(loaded.stages[0].tables)
    assert tables == [f"{root}/prep/stages/0_{loaded.stages[0].uid}/labels-0"]
    known = new.where("place is not null")
    assert rows(loaded.transform(known), "id", "features") == rows(fitted.transform(known), "id", "features")
    with pytest.raises(Exception, match="exist"):
        fitted.write().save(root + "/prep")
    fitted.write().overwrite().save(root + "/prep")
    table_indexer(["k"]).write().save(root + "/estimator")
    assert TableIndexer.load(root + "/estimator").getInputCols() == ["k"]


def test_nothing_to_index(data):
    model = table_indexer(["k"]).fit(data.where("false"))
    assert {r.k_tmp for r in model.transform(data).collect()} == {0.0}
    assert model.transform(data.where("false")).collect() == []


def test_forests_on_label_tables(spark, data, root):
    rows_ = data.where("k <> '' or k is null").selectExpr("id", "date_add(date'2018-01-01', cast(id % 300 as int)) as d", "cast(n as double) as x", "k", "cast(id % 13 + n as double) as t")
    spec = FeatureSpec("t", "d", ("id",), (("x",), ("x",)), (), (), ("k",))
    params, starts = ForestParams(num_trees=3, max_depth=3, max_features="all"), (0, 20)
    found = []
    for by_table in (False, True):
        own = FeatureSpec(**{**spec.__dict__, "label_tables": by_table})
        where = f"{root}/{by_table}"
        train(rows_, own, "2018-07-01", params, root=where)
        models = load_models(spark, execution_path(where, "t", "2018-07-01"), own)
        found.append(rows(predictions(rows_, own, models, "2018-07-01", starts, 2), "id", "fold", "t_pred"))
    assert found[0] == found[1] and len(found[0]) > 500
