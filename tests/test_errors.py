import pytest
from helpers import close, rows

from stridecast.operators.evaluate import (
    error_columns,
    error_means,
    error_summary,
    evaluation_rows,
    level_errors,
    outlier_share,
)
from stridecast.plans.evaluation import evaluate

LEVELS = [
    ("x", "1", 10.0, 8.0),
    ("x", "2", 5.0, 5.0),
    ("y", "1", 0.0, 1.0),
    (None, "1", 3.0, 3.0),
]


@pytest.fixture
def levels(spark):
    return spark.createDataFrame(LEVELS, "a string, b string, t double, p double")


def test_error_columns_on_zero_null_and_negative_targets(spark):
    df = spark.createDataFrame(
        [(0.0, 1.0), (2.0, 1.0), (None, 1.0), (-4.0, -2.0)], "t double, p double"
    )
    got = {r.t: (r.t_APE, r.t_AE, r.t_SE) for r in error_columns(df, "t", "p").collect()}
    assert got == {
        0.0: (None, 1.0, 1.0),
        2.0: (50.0, 1.0, 1.0),
        None: (None, None, None),
        -4.0: (50.0, 2.0, 4.0),
    }


def test_errors_are_doubles_for_integers_and_decimals(spark):
    df = spark.sql("select 3 as t, cast(2.00 as decimal(10,2)) as p")
    out = error_columns(df, "t", "p")
    assert [t for c, t in out.dtypes if c.startswith("t_")] == ["double"] * 3
    assert close(out.first().t_APE, 100 / 3)


def test_target_as_its_own_prediction_has_no_error(levels):
    out = error_columns(levels, "t", "t")
    assert {r.t_AE for r in out.collect()} == {0.0}
    total = level_errors(levels, "t", "t", ["a"]).collect()
    assert {r.abs_error for r in total} == {0.0}


def test_evaluation_starts_on_the_given_day(spark):
    df = spark.createDataFrame(
        [("2018-01-31", 1.0, 1.0), ("2018-02-01", 1.0, 2.0)], "d string, t double, p double"
    )
    out = evaluation_rows(df, "t", "p", "d", "2018-02-01")
    assert [(r.d, r.t_APE, r.t_AE) for r in out.collect()] == [("2018-02-01", 100.0, 1.0)]
    assert "t_SE" not in out.columns


def test_levels_tell_a_null_group_from_a_total(levels):
    got = rows(level_errors(levels, "t", "p", ["a", "b"]))
    expected = [
        ("x", "1", 0, 10.0, 8.0, 1, 2.0, 20.0),
        ("x", "2", 0, 5.0, 5.0, 1, 0.0, 0.0),
        ("y", "1", 0, 0.0, 1.0, 1, 1.0, None),
        (None, "1", 0, 3.0, 3.0, 1, 0.0, 0.0),
        ("x", None, 1, 15.0, 13.0, 2, 2.0, pytest.approx(200 / 15)),
        ("y", None, 1, 0.0, 1.0, 1, 1.0, None),
        (None, None, 1, 3.0, 3.0, 1, 0.0, 0.0),
        (None, "1", 2, 13.0, 12.0, 3, 1.0, pytest.approx(100 / 13)),
        (None, "2", 2, 5.0, 5.0, 1, 0.0, 0.0),
    ]
    assert len(got) == len(expected)
    for row in expected:
        assert row in got


def test_basic_evaluation_has_the_joint_level_only(levels):
    out = level_errors(levels, "t", "p", ["a", "b"], full=False)
    assert {r.level for r in out.collect()} == {0}


def test_any_number_of_levels(levels):
    df = levels.selectExpr("*", "a is null as c")
    got = {r.level for r in level_errors(df, "t", "p", ["a", "b", "c"]).collect()}
    assert got == {0, 0b011, 0b101, 0b110}
    assert {r.level for r in level_errors(df, "t", "p", ["a"]).collect()} == {0}


def test_summary_is_the_unweighted_mean_over_groups(levels):
    got = {(r.scope, r.metric): r.value for r in error_summary(levels, "t", "p", ["a", "b"]).collect()}
    assert got == {
        ("rows", "mape"): pytest.approx((20 + 0 + 0) / 3),
        ("rows", "mae"): pytest.approx(3 / 4),
        ("rows", "outliers_50"): 0.0,
        ("rows", "outliers_100"): 0.0,
        ("a,b", "mape"): pytest.approx(20 / 3),
        ("a,b", "mae"): pytest.approx(3 / 4),
        ("a", "mape"): pytest.approx((200 / 15 + 0) / 2),
        ("a", "mae"): pytest.approx(1.0),
        ("b", "mape"): pytest.approx((100 / 13 + 0) / 2),
        ("b", "mae"): pytest.approx(0.5),
    }


def test_evaluation_as_a_whole(spark):
    df = spark.createDataFrame([("2018-01-31", *r) for r in LEVELS] + [("2018-02-01", *LEVELS[0])],
                               "d string, a string, b string, t double, p double")
    out = evaluate(df, "t", "p", "d", "2018-02-01", ["a", "b"])
    assert out.rows.count() == 1
    assert {(r.a, r.b, r.abs_error) for r in out.levels.collect()} == {
        ("x", "1", 2.0), ("x", None, 2.0), (None, "1", 2.0)
    }
    assert {r.value for r in out.summary.where("metric = 'mae'").collect()} == {2.0}
    joint = evaluate(df, "t", "p", "d", "2018-01-01", ["a", "b"], full=False)
    assert {r.scope for r in joint.summary.collect()} == {"rows", "a,b"}


def test_empty_input_gives_null_metrics(levels):
    empty = levels.limit(0)
    summary = error_summary(empty, "t", "p", ["a", "b"]).collect()
    assert len(summary) == 10 and {r.value for r in summary} == {None}
    share = outlier_share(empty, "t", "p").first()
    assert (share.row_count, share.outliers_50, share.outliers_100) == (0, None, None)


def test_outliers_count_rows_without_an_error_in_the_denominator(spark):
    df = spark.createDataFrame(
        [(10.0, 4.0), (10.0, 30.0), (0.0, 5.0), (10.0, 10.0)], "t double, p double"
    )
    share = outlier_share(df, "t", "p").first()
    assert (share.outliers_50, share.outliers_100) == (50.0, 25.0)


def test_error_means_count_rows_with_an_id(spark):
    df = spark.createDataFrame(
        [(0, 1, 10.0, 9.0), (0, None, 0.0, 1.0), (1, 2, 4.0, 4.0)],
        "fold int, id int, t double, p double",
    )
    assert rows(error_means(df, "t", "p", "id", ["fold"])) == [
        (0, 10.0, 1.0, 1),
        (1, 0.0, 0.0, 1),
    ]
