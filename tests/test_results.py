import datetime as dt
import os

import pytest
from helpers import plan, rows

from stridecast.plans.backtest import backtest, last_days
from stridecast.sources.artifacts import execution_path
from stridecast.sources.results import csv_path, read_predictions, write_csv, write_predictions
from stridecast.sources.shared import shared_folder, staged

FORECASTS = [
    (1, 10.0, "2018-01-01"),
    (2, 20.0, "2018-01-01"),
    (1, 11.0, "2018-02-01"),
    (2, 90.0, "2018-02-01"),
    (3, 5.0, "2018-02-01"),
]
ACTUALS = [(1, 10.0, "2018-03-01"), (2, 40.0, "2018-03-31"), (3, 0.0, "2018-03-31"), (4, 1.0, "2018-03-02")]


@pytest.fixture
def forecasts(spark):
    return spark.createDataFrame(FORECASTS, "id int, t_pred double, e string").selectExpr(
        "id", "t_pred", "to_date(e) as dt_execution"
    )


@pytest.fixture
def actuals(spark):
    return spark.createDataFrame(ACTUALS, "id int, t double, d string").selectExpr(
        "id", "t", "cast(d as timestamp) + interval 12 hours as d"
    )


def test_layout():
    path = execution_path("/data/", "seats", "2018-01-15")
    assert path == "/data/pipelines/seats/dt-execution=2018-01-15"
    assert csv_path("/data", "seats", "results", "2018-01-15") == "/data/seats_results_2018_01_15.csv"


def test_an_execution_written_again_leaves_the_others(spark, root, forecasts):
    write_predictions(forecasts, root, "t", gather=True)
    again = forecasts.where("dt_execution = '2018-02-01' and id = 1").selectExpr(
        "id", "99.0D as t_pred", "dt_execution"
    )
    write_predictions(again, root, "t")
    expected = rows(forecasts.where("dt_execution = '2018-01-01'")) + rows(again)
    assert rows(read_predictions(spark, root, "t"), "id", "t_pred", "dt_execution") == sorted(
        expected, key=repr
    )


def test_other_executions_are_not_read(spark, root, forecasts):
    write_predictions(forecasts, root, "t")
    chosen = read_predictions(spark, root, "t", executions=["2018-01-01"])
    assert chosen.count() == 2
    assert "PartitionFilters: [isnotnull(dt_execution" in plan(chosen)
    assert read_predictions(spark, root, "t", last_execution="2018-01-31").count() == 2
    assert read_predictions(spark, root, "t", executions=[]).count() == 0


def test_csv_has_a_header(spark, root, forecasts):
    path = csv_path(root, "t", "results", "2018-01-01")
    write_csv(forecasts.coalesce(1), path)
    part = next(f for f in os.listdir(path) if f.startswith("part-"))
    with open(os.path.join(path, part)) as f:
        assert f.readline().strip() == "id,t_pred,dt_execution"
    back = spark.read.schema(forecasts.schema).option("header", True).csv(path)
    assert rows(back) == rows(forecasts)


def test_last_days_include_both_ends(actuals):
    got = [r.id for r in last_days(actuals, "d", days=31).orderBy("id").collect()]
    assert got == [1, 2, 3, 4]
    assert last_days(actuals, "d", days=30).count() == 3
    assert [r.id for r in last_days(actuals, "d", 1, until="2018-03-01").collect()] == [1]


def test_backtest_without_outliers(forecasts, actuals):
    got = {r.dt_execution.isoformat(): r for r in backtest(forecasts, actuals, ["id"], "t", "d").collect()}
    january, february = got["2018-01-01"], got["2018-02-01"]
    assert (january.mape, january.mae, january.mse) == (25.0, 10.0, 200.0)
    assert (january.row_count, january.outlier_count) == (2, 0)
    # 90 against 40 is an outlier; 5 against 0 has no percentage error and stays.
    assert (february.mape, february.mae, february.mse) == (10.0, 3.0, 13.0)
    assert (february.row_count, february.outlier_count) == (2, 1)


def test_backtest_choices(forecasts, actuals):
    every = backtest(forecasts, actuals, ["id"], "t", "d", remove_outliers=False)
    february = every.where("dt_execution = '2018-02-01'").first()
    assert (february.row_count, february.outlier_count, february.mae) == (3, 1, 56 / 3)
    chosen = backtest(forecasts, actuals, ["id"], "t", "d", executions=[dt.date(2018, 2, 1)])
    assert [r.dt_execution.month for r in chosen.collect()] == [2]
    upto = backtest(forecasts, actuals, ["id"], "t", "d", last_execution="2018-01-31")
    assert [r.dt_execution.month for r in upto.collect()] == [1]
    one_day = backtest(forecasts, actuals, ["id"], "t", "d", days=1)
    assert {r.row_count for r in one_day.collect()} == {1}


def test_backtest_meets_on_the_day_where_predictions_carry_it(spark, forecasts, actuals):
    days = spark.createDataFrame(
        [(1, "2018-03-01"), (2, "2018-03-30"), (3, "2018-03-31")], "id int, d string"
    ).selectExpr("id", "to_date(d) as d")
    dated = forecasts.join(days, "id")
    got = backtest(dated, actuals, ["id"], "t", "d", remove_outliers=False).collect()
    assert {r.dt_execution.month: r.row_count for r in got} == {1: 1, 2: 2}


def test_shared_folder_is_new_each_time(spark):
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a != b
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert root is None or a.startswith(root)


def test_a_staged_table_is_there_while_needed(spark, forecasts):
    with staged(forecasts, "stage") as table:
        (path,) = {f.rsplit("/", 1)[0].removeprefix("file://") for f in table.inputFiles()}
        assert os.path.isdir(path)
        assert rows(table) == rows(forecasts)
    assert not os.path.exists(path)


def test_an_empty_rerun_leaves_nothing_behind(spark, root):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "k int, dt_execution date")
    write_predictions(df, root, "t", execution="2020-01-01")
    write_predictions(df.limit(0), root, "t", execution="2020-01-01")
    assert read_predictions(spark, root, "t", schema=df.schema).count() == 0


def test_executions_that_cannot_reach_the_days_are_not_read(spark, root, actuals):
    """Days from 2018-01-01 on: with five months ahead, executions from 2017-08 on reach them."""
    made = spark.createDataFrame(
        [(1, 10.0, "2017-07-31"), (1, 11.0, "2017-08-01"), (1, 12.0, "2018-03-31"), (1, 13.0, "2018-04-01")],
        "id int, t_pred double, e string",
    ).selectExpr("id", "t_pred", "to_date(e) as dt_execution")
    write_predictions(made, root, "t")
    past = read_predictions(spark, root, "t")
    some = backtest(past, actuals, ["id"], "t", "d", until="2018-03-31")
    line = next(x for x in plan(some).splitlines() if "PartitionFilters" in x)
    assert "dt_execution" in line and "2017-08-01" in line and "2018-03-31" in line
    assert [str(r.dt_execution) for r in some.orderBy("dt_execution").collect()] == ["2017-08-01", "2018-03-31"]
    every = backtest(past, actuals, ["id"], "t", "d", until="2018-03-31", months_ahead=None)
    assert every.count() == 4


def test_executions_of_a_longer_horizon_are_judged(spark, actuals):
    made = spark.createDataFrame(
        [(1, 10.0, "2018-03-01", "2017-03-15"), (1, 12.0, "2018-03-01", "2018-02-01")],
        "id int, t_pred double, d string, e string",
    ).selectExpr("id", "t_pred", "to_date(d) as d", "to_date(e) as dt_execution")
    got = backtest(made, actuals, ["id"], "t", "d", until="2018-03-31")
    assert {str(r.dt_execution): r.mae for r in got.collect()} == {"2017-03-15": 0.0, "2018-02-01": 2.0}
    bounded = backtest(made, actuals, ["id"], "t", "d", until="2018-03-31", months_ahead=5)
    assert [str(r.dt_execution) for r in bounded.collect()] == ["2018-02-01"]
