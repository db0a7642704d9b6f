"""All models in one pass: the plan, and the same values as model by model."""

import re
from dataclasses import replace

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from stridecast.config import BASIC, FULL, FeatureSpec, ForestParams
from stridecast.operators.forest import score, score_routed
from stridecast.operators.folds import fold_rows
from stridecast.operators.split import project_fold, route_nulls
from stridecast.plans.predict import predict, predictions
from stridecast.plans.train import train, training_error, training_set
from stridecast.sources.artifacts import execution_path, load_models

SPLIT = "2018-06-01"
SPEC = FeatureSpec(
    target="t",
    date="d",
    ids=("id",),
    features=(("x", "y"), ("x", "y"), ("y",), ("y", "x"), ("x",), ("w",)),
    basic_features=(("z",), ("z",), ("z", "x"), (), (), ()),
    categorical=("k", "c"),
)
PARAMS = ForestParams(num_trees=5, max_depth=4, max_features="onethird")


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """Rows with nulls and NaN in features and categories, and labels unseen in training."""
    path = str(tmp_path_factory.mktemp("scoring"))
    spark.range(3000).selectExpr(
        "id",
        "date_add(date'2017-01-01', cast(id % 730 as int)) as d",
        "if(id % 13 = 0, double('NaN'), cast(id % 10 as double)) as x",
        "if(id % 11 = 0, null, cast(id % 7 as double)) as y",
        "if(id % 17 = 0, null, cast(id % 3 as double)) as z",
        "cast(id % 19 as int) as w",
        "case when id % 23 = 0 then null when id > 2900 then 'new' else concat('k', id % 4) end as k",
        "concat('c', id % 9) as c",
        "3.0D * (id % 10) + id % 7 + id % 4 as t",
    ).write.parquet(path + "/data")
    return spark.read.parquet(path + "/data")


@pytest.fixture(scope="module")
def models(data, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("models"))
    train(data.where("id % 3 <> 1 or k <> 'k2'"), SPEC, SPLIT, PARAMS, root=root)
    return load_models(data.sparkSession, execution_path(root, "t", SPLIT), SPEC)


def model_by_model(data, models):
    """Each model on the rows of its fold and variant, by its own pipeline."""
    found = []
    for fold in SPEC.folds:
        rest = fold_rows(data, SPEC.date, SPLIT, fold)
        for variant in (FULL, BASIC):
            model = next(m for m in models if (m.fold, m.variant) == (fold, variant))
            frame, rest = route_nulls(rest, SPEC.numeric(fold, variant))
            frame = project_fold(frame, SPEC, fold, variant, with_target=False)
            found += [(r["id"], fold, variant, r["t_pred"]) for r in score(model, frame, ["id"]).collect()]
        found += [(r["id"], fold, "unscored", None) for r in rest.select("id").collect()]
    return sorted(found, key=repr)


def test_predictions_equal_those_of_each_pipeline(data, models):
    found = predictions(data, SPEC, models, SPLIT)
    expected = model_by_model(data, models)
    assert rows(found, "id", "fold", "variant", "t_pred") == expected
    assert {variant for _, _, variant, _ in expected} == {"full", "basic", "unscored"}


def test_without_basic_models(data, models):
    full = [m for m in models if m.variant == FULL]
    spec = replace(SPEC, basic_features=())
    found = predictions(data, spec, full, SPLIT)
    assert {r["variant"] for r in found.select("variant").distinct().collect()} == {"full", "unscored"}
    expected = [e for e in model_by_model(data, models) if e[2] == FULL]
    assert rows(found.where("variant = 'full'"), "id", "fold", "variant", "t_pred") == expected


def of_each_kind(text):
    return {kind: len(re.findall(rf"\(\d+\) {kind}\b", text)) for kind in ("Scan", "Union", "InMemoryTableScan", "Exchange")}


def test_one_scan_and_one_projection(data, models):
    text = plan(predictions(data, SPEC, models, SPLIT))
    assert of_each_kind(text) == {"Scan": 1, "Union": 0, "InMemoryTableScan": 0, "Exchange": 0}
    # Every forest stands in a branch of the CASE: a row passes through one of them.
    assert len(re.findall(r"THEN UDF\(UDF\(_all_features", text)) == len(models)
    assert not re.search(r"AS _t_pred_\d", text)
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(d,2018-06-01)" in pushed and "LessThan(d,2018-12-01)" in pushed


def test_one_scan_with_a_root(data, models, root, monkeypatch):
    from stridecast.plans import predict as module

    plans, write = [], module.write_predictions
    monkeypatch.setattr(module, "write_predictions", lambda df, *a, **k: (plans.append(plan(df)), write(df, *a, **k)))
    cached = set(data.sparkSession.sparkContext._jsc.getPersistentRDDs())
    result = predict(data, SPEC, SPLIT, models=models, root=root)
    assert of_each_kind(plans[0])["Scan"] == 1 and len(plans) == 1
    assert set(data.sparkSession.sparkContext._jsc.getPersistentRDDs()) <= cached
    assert rows(result.results, "id", "t_pred") == [(i, p) for i, _, _, p in model_by_model(data, models)]


def test_training_errors_of_all_models_in_one_scan(data, models):
    known = training_set(data, SPEC, SPLIT)
    found = training_error(models, known, SPEC, range(6))
    assert of_each_kind(plan(found))["Scan"] <= 2  # the rows, and the list of models
    expected = []
    for m in models:
        full, lacking = route_nulls(known, SPEC.numeric(m.fold, FULL))
        frame = lacking if m.variant == BASIC else full
        frame = route_nulls(frame, SPEC.numeric(m.fold, m.variant))[0]
        for r in score(m, frame, ["id", "t"]).agg(
            F.avg(F.abs(F.col("t") - F.col("t_pred"))).alias("mae"), F.count("*").alias("n")
        ).collect():
            expected.append((m.fold, m.variant, r["n"], None if r["mae"] is None else round(r["mae"], 6)))
    got = found.select("fold", "variant", "row_count", F.round("mae", 6).alias("mae")).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_training_errors_read_the_vectors_of_the_fits(data, monkeypatch):
    from stridecast.plans import train as module

    plans, judge = [], module.training_error
    keep = lambda df: plans.append(plan(df)) or df
    monkeypatch.setattr(module, "training_error", lambda *a, **k: keep(judge(*a, **k)))
    out = train(data, SPEC, SPLIT, PARAMS, checks=True)
    assert len(plans) == 1 and "_all_features" not in plans[0] and "k#" not in plans[0]
    plain = judge(out.models, training_set(data, SPEC, SPLIT), SPEC)
    columns = ["fold", "variant", "row_count", *(F.round(c, 6).alias(c) for c in ("mape", "mae"))]
    found = rows(out.errors.select(*columns))
    assert found == rows(plain.select(*columns)) and len(found) == 4


def test_rows_of_no_branch(data, models):
    assert score_routed(data, [], "p").where("p is not null").count() == 0
    found = score_routed(data, [(F.col("id") < 10, models[0])], "p")
    assert found.columns == [*data.columns, "p"]
    assert found.where("p is not null").count() == 10


def test_empty_horizon(data, models):
    assert predictions(data.where("false"), SPEC, models, SPLIT).count() == 0
