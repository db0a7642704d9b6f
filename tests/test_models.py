from dataclasses import replace

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from stridecast.config import BASIC, FULL, FeatureSpec, ForestParams
from stridecast.operators.forest import feature_names, importances, subset_strategy
from stridecast.operators.reports import prediction_metrics
from stridecast.plans.predict import horizon_rows, predict, predictions, rows_to_score
from stridecast.plans.train import fit_fold, train, training_set
from stridecast.sources.artifacts import execution_path, load_models
from stridecast.sources.results import write_predictions

SPLIT = "2018-06-01"
SPEC = FeatureSpec(
    target="t",
    date="d",
    ids=("id",),
    features=tuple(("x", "y") for _ in range(5)) + (("x",),),
    basic_features=(("z",),) * 6,
    categorical=("k",),
)
PARAMS = ForestParams(num_trees=4, max_depth=3, max_features="all")


@pytest.fixture(scope="module")
def data(spark):
    """Two years of rows; every eleventh lacks y, and x in the last fold."""
    return spark.range(2600).selectExpr(
        "id",
        "date_add(date'2017-01-01', cast(id % 730 as int)) as d",
        "cast(id % 10 as double) as x",
        "if(id % 11 = 0, null, cast(id % 7 as double)) as y",
        "cast(id % 3 as double) as z",
        "concat('k', id % 4) as k",
        "3.0D * (id % 10) + id % 7 + 1 as t",
    ).cache()


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("models"))


@pytest.fixture(scope="module")
def training(data, root):
    return train(data, SPEC, SPLIT, PARAMS, root=root, checks=True)


@pytest.fixture(scope="module")
def scored(data, training):
    return predictions(data, SPEC, training.models, SPLIT).cache()


def test_one_model_per_fold_and_variant(training):
    assert [(m.fold, m.variant) for m in training.models] == [
        (f, v) for f in range(6) for v in (FULL, BASIC)
    ]


def test_folds_with_the_same_features_share_a_fit(data, training):
    full = [m.forest for m in training.models if m.variant == FULL]
    assert all(forest is full[0] for forest in full[:5]) and full[5] is not full[0]
    alone = fit_fold(training_set(data, SPEC, SPLIT).cache(), SPEC, PARAMS, 5, BASIC)
    assert alone.fold == 5 and alone.prep is not training.models[-1].prep


def test_models_with_the_same_inputs_share_a_fit(data, training):
    basic = [m for m in training.models if m.variant == BASIC]
    assert all(m.forest is basic[0].forest and m.prep is basic[0].prep for m in basic)
    for fold, variant in ((0, FULL), (5, FULL), (5, BASIC)):
        alone = fit_fold(training_set(data, SPEC, SPLIT).coalesce(1).sort("id"), SPEC, PARAMS, fold, variant)
        found = next(m for m in training.models if (m.fold, m.variant) == (fold, variant))
        trees = [m.forest.toDebugString.split("\n", 1)[1] for m in (alone, found)]
        assert trees[0] == trees[1]


def test_a_row_is_prepared_once_for_all_fits(data, monkeypatch):
    from stridecast.plans import train as module

    plans, tables = [], []
    real, stage = module.regressor, module.staged

    class Spy:
        def __init__(self, *args):
            self.forest = real(*args)

        def fit(self, frame):
            plans.append(plan(frame))
            return self.forest.fit(frame)

    monkeypatch.setattr(module, "regressor", Spy)
    monkeypatch.setattr(module, "staged", lambda df, name: tables.append((name, plan(df))) or stage(df, name))
    train(data, SPEC, SPLIT, PARAMS)
    assert len(plans) == 3  # x and y, x, z
    assert not any("UDF" in text or "k#" in text for text in plans)
    assert [name for name, _ in tables] == ["training", "prepared"]


def test_one_prediction_per_test_row(data, scored):
    assert rows(scored, "id") == rows(horizon_rows(data, SPEC, SPLIT), "id")
    assert scored.where("t_pred is null").count() == 0
    assert scored.columns == ["id", "d", "t_pred", "fold", "variant", "dt_execution"]


def test_rows_that_lack_a_feature_use_the_basic_model(scored):
    assert scored.where("fold < 5 and (variant = 'basic') <> (id % 11 = 0)").count() == 0
    assert scored.where("fold = 5 and variant = 'basic'").count() == 0


def test_predictions_lie_within_the_training_target(data, scored):
    low, high = data.where(f"d < '{SPLIT}'").selectExpr("min(t)", "max(t)").first()
    assert scored.where(f"t_pred < {low} or t_pred > {high}").count() == 0


def test_saved_models_predict_the_same(spark, data, root, scored):
    loaded = load_models(spark, execution_path(root, "t", SPLIT), SPEC)
    assert rows(predictions(data, SPEC, loaded, SPLIT)) == rows(scored)


def test_same_seed_same_predictions_whatever_the_layout(data, training, scored):
    one_by_one = train(data.repartition(5, "z"), SPEC, SPLIT, PARAMS, parallelism=1)
    assert rows(predictions(data, SPEC, one_by_one.models, SPLIT)) == rows(scored)


def test_training_metrics(training):
    got = training.metrics.first()
    assert (got.col_target, got.num_trees, got.max_depth, got.max_features) == ("t", 4, 3, "all")
    assert (got.train_date_min.isoformat(), got.train_date_max.isoformat()) == (
        "2017-01-01",
        "2018-05-31",
    )


def test_training_error_covers_first_and_last_fold(data, training):
    got = {(r.fold, r.variant): r for r in training.errors.collect()}
    past = data.where(f"d < '{SPLIT}'")
    lacking = past.where("y is null").count()
    assert got[0, FULL].row_count == past.count() - lacking
    assert got[0, BASIC].row_count == lacking
    assert got[5, FULL].row_count == past.count()
    # No row lacks a feature of the last fold: its basic model has no rows and no errors.
    empty = got[5, BASIC]
    assert (empty.row_count, empty.mape, empty.mae) == (0, None, None)
    assert 0 < got[0, FULL].mae < got[5, FULL].mae


def test_importances_cover_every_slot_and_sum_to_one(data, training):
    model = training.models[0]
    got = importances(model, data).collect()
    names = {r.variable for r in got}
    assert {"x", "y"} <= names and sum(n.startswith("k_catVec_") for n in names) == 5
    assert sum(r.importance for r in got) == pytest.approx(1)
    assert [r.importance for r in got] == sorted((r.importance for r in got), reverse=True)
    assert got[0].variable == "x"


def test_importances_of_numeric_features_only(data):
    spec = replace(SPEC, categorical=(), basic_features=(), features=(("x",),))
    model = train(data, spec, SPLIT, PARAMS).models[0]
    assert [(r.idx, r.variable, r.importance) for r in importances(model, data).collect()] == [
        (0, "x", 1.0)
    ]
    assert feature_names(model.prep.transform(data)) == [(0, "x")]


def test_predict_writes_and_reports(spark, data, root, scored):
    out = predict(data, SPEC, SPLIT, root=root, keys=["id", "d"], checks=True, csv=True)
    assert rows(out.results, *scored.columns) == rows(scored)
    metrics = out.metrics.first()
    assert metrics.check_duplicates == 0
    assert metrics.results_full_count == scored.count()
    assert metrics.test_basic_set_count == scored.where("variant = 'basic'").count()
    assert metrics.pred_date_min.isoformat() == "2018-06-01"
    assert metrics.pred_date_max.isoformat() == "2018-11-30"
    assert out.backtest.count() == 0  # no execution came before
    months = [r.month for r in out.months.collect()]
    assert months == [f"2018-{m:02d}" for m in range(6, 12)]
    tags = out.importances.select("fold", "model").distinct()
    assert rows(tags.where("model is not null")) == [(0, "first"), (5, "last")]
    saved = spark.read.option("header", True).csv(root + "/t_feat_importance_2018_06_01.csv")
    assert saved.count() == out.importances.count()
    saved = spark.read.option("header", True).csv(root + "/t_results_2018_06_01.csv")
    assert saved.count() == scored.count() and set(saved.columns) == set(scored.columns)


def test_models_of_an_earlier_execution(data, root, training):
    out = predict(data, SPEC, "2018-07-01", root=root, dt_execution=SPLIT)
    assert {r.dt_execution.isoformat() for r in out.results.select("dt_execution").collect()} == {
        "2018-07-01"
    }


def test_past_executions_are_judged(data, training, tmp_path):
    root = str(tmp_path)
    predict(data, SPEC, SPLIT, models=training.models, root=root)
    out = predict(data, SPEC, "2018-07-01", models=training.models, root=root, checks=True)
    (june,) = out.backtest.collect()
    assert june.dt_execution.isoformat() == SPLIT
    assert june.row_count + june.outlier_count == data.where(
        f"d >= '{SPLIT}' and d < '2018-07-01'"
    ).count()


def test_past_executions_of_any_horizon_are_judged(data, training, tmp_path):
    root = str(tmp_path)
    june = predict(data, SPEC, SPLIT, models=training.models, root=root).results
    write_predictions(june, root, SPEC.target, execution="2017-10-15")
    out = predict(data, SPEC, "2018-07-01", models=training.models, root=root, checks=True)
    early, late = out.backtest.orderBy("dt_execution").collect()
    assert (str(early.dt_execution), early.row_count) == ("2017-10-15", late.row_count)


def test_lost_rows_show_up(data, training):
    """The test sets are counted at their source, not in the results."""
    out = predict(data, SPEC, SPLIT, models=training.models, checks=True)
    tests = rows_to_score(data, SPEC, SPLIT)
    short = prediction_metrics(out.results.where("id % 2 = 0"), tests, ["id"], "d").first()
    assert short.test_set_count + short.test_basic_set_count == tests.count()
    assert short.results_full_count < tests.count()
    assert short.test_basic_set_count == out.results.where("variant = 'basic'").count()


def test_a_tree_without_bootstrap_gives_the_means_of_the_sides(data):
    spec = replace(SPEC, features=(("flag",),), basic_features=(), categorical=())
    flagged = data.selectExpr("id", "d", "t", "cast(x >= 5 as double) as flag")
    params = ForestParams(num_trees=1, max_depth=1, max_features="all", bootstrap=False)
    model = train(flagged, spec, SPLIT, params).models
    out = predict(flagged, spec, SPLIT, models=model, starts=(0,)).results.join(flagged, ["id", "d"])
    means = {r.flag: r.m for r in flagged.where(f"d < '{SPLIT}'").groupBy("flag").agg(F.avg("t").alias("m")).collect()}
    for r in out.select("flag", "t_pred").distinct().collect():
        assert r.t_pred == pytest.approx(means[r.flag], rel=1e-12)


def test_nothing_to_predict(data, training, tmp_path):
    out = predict(
        data, SPEC, "2030-01-01", models=training.models, root=str(tmp_path), checks=True
    )
    assert out.results.count() == 0
    assert out.metrics.first().results_full_count == 0
    assert out.months.count() == 0


def test_rows_no_model_can_score_stay(data, training):
    full_only = replace(SPEC, basic_features=())
    models = [m for m in training.models if m.variant == FULL]
    out = predict(data, full_only, SPLIT, models=models).results
    assert out.count() == horizon_rows(data, SPEC, SPLIT).count()
    assert out.where("(t_pred is null) <> (variant = 'unscored')").count() == 0
    assert out.where("variant = 'unscored'").count() > 0


def test_rows_the_basic_model_cannot_score_stay_too(data, training):
    poor = data.selectExpr("id", "d", "x", "y", "if(id % 22 = 0, null, z) as z", "k")
    out = predictions(poor, SPEC, training.models, SPLIT)
    assert rows(out, "id") == rows(horizon_rows(data, SPEC, SPLIT), "id")
    lost = out.where("variant = 'unscored'")
    assert lost.where("t_pred is not null or id % 22 <> 0 or fold = 5").count() == 0
    assert lost.count() == out.where("id % 22 = 0 and fold < 5").count() > 0


def test_predict_needs_models(data, training):
    with pytest.raises(ValueError):
        predict(data, SPEC, SPLIT)
    with pytest.raises(ValueError, match="fold 3"):
        predictions(data, SPEC, [m for m in training.models if m.fold != 3], SPLIT)
    with pytest.raises(ValueError, match="number of folds"):
        predictions(data, SPEC, training.models, SPLIT, starts=(0, 8))


def test_own_calendar(data, training):
    two = replace(SPEC, features=SPEC.features[:2], basic_features=SPEC.basic_features[:2])
    out = predict(data, two, SPLIT, models=training.models, starts=(0, 10), months_ahead=0).results
    spans = out.groupBy("fold").agg({"d": "max"}).collect()
    assert {r.fold: r[1].isoformat() for r in spans} == {0: "2018-06-10", 1: "2018-06-30"}


def test_sampled_training(data):
    one = replace(SPEC, features=(("x",),), basic_features=())
    out = train(data, one, SPLIT, PARAMS, 100, ["id"], checks=True, fit_partitions=3)
    assert out.errors.first().row_count == 100 and out.path is None
    as_is = train(data, one, SPLIT, PARAMS, 100, ["id"], checks=True, spread=False)
    assert as_is.errors.first().row_count == 100


@pytest.mark.parametrize(
    "value, expected",
    [
        ("sqrt", "sqrt"),
        ("auto", "auto"),
        (3, "3"),
        ("3", "3"),
        (1, "1"),
        (1.0, "1.0000000000"),
        ("1.0", "1.0000000000"),
        (0.25, "0.2500000000"),
        (1e-5, "0.0000100000"),
    ],
)
def test_features_per_split(value, expected):
    assert subset_strategy(value) == expected


@pytest.mark.parametrize("value", [0, -1, 0.0, 1.5, "half"])
def test_bad_features_per_split(value):
    with pytest.raises(ValueError):
        subset_strategy(value)


def test_training_rows_without_target_are_told(data):
    poor = data.withColumn("t", F.expr("if(id % 500 = 1, null, t)"))
    lost = poor.where(f"t is null and d < '{SPLIT}'").count()
    with pytest.raises(ValueError, match=f"^{lost} training rows"):
        train(poor, SPEC, SPLIT, PARAMS)
