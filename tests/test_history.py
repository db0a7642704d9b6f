"""Recorded sums against errors of all predictions read anew."""

import pytest
from helpers import close, plan, rows
from pyspark.sql import functions as F

from stridecast.operators.evaluate import error_summary, level_errors
from stridecast.plans import history
from stridecast.plans.backtest import backtest

DAYS = ["2018-01-01", "2018-02-01", "2018-03-01"]


@pytest.fixture(scope="module")
def actuals(spark):
    """Days of four months; some values are 0 or missing."""
    return spark.range(400).selectExpr(
        "id",
        "date_add(date'2018-01-01', cast(id % 120 as int)) as d",
        "case when id % 29 = 0 then 0.0D when id % 31 = 0 then null else cast(id % 17 + 3 as double) end as t",
        "if(id % 7 = 0, null, concat('k', id % 3)) as k",
    ).cache()


@pytest.fixture(scope="module")
def made(spark, actuals):
    each = spark.createDataFrame([(d,) for d in DAYS], "e string").selectExpr("to_date(e) as dt_execution")
    return actuals.crossJoin(each).selectExpr(
        "id", "d", "if(id % 41 = 0, null, cast(id % 23 + month(dt_execution) as double)) as t_pred", "dt_execution"
    ).cache()


def same(found, expected):
    assert len(found) == len(expected) > 0
    for a, b in zip(sorted(found, key=repr), sorted(expected, key=repr)):
        assert all(close(x, y) if isinstance(x, float) or isinstance(y, float) else x == y for x, y in zip(a, b)), (a, b)


def recorded(spark, made, actuals, root, **kwargs):
    history.record(made, actuals, root, ["id"], "t", "d", ["k"], **kwargs)
    return history.history(spark, root, "t")


@pytest.mark.parametrize("with_day", [True, False])
@pytest.mark.parametrize("remove", [True, False])
def test_backtest_equals_the_full_run(spark, made, actuals, root, with_day, remove):
    made = made if with_day else made.drop("d")
    sums = recorded(spark, made, actuals, root)
    for days, until in ((90, None), (30, "2018-03-20"), (1, "2018-02-02")):
        full = backtest(made, actuals, ["id"], "t", "d", days, until, remove_outliers=remove, months_ahead=None)
        found = history.recorded_backtest(sums, days, until, remove)
        same(rows(found), rows(full.select(found.columns)))


def test_executions_one_by_one(spark, made, actuals, root):
    for d in DAYS:
        history.record(made, actuals, root, ["id"], "t", "d", ["k"], execution=d)
    spoilt = made.withColumn("t_pred", F.lit(0.0))
    history.record(spoilt, actuals, root, ["id"], "t", "d", ["k"], execution=DAYS[1])
    full = made.where(F.col("dt_execution") != DAYS[1]).unionByName(spoilt.where(F.col("dt_execution") == DAYS[1]))
    found = history.recorded_backtest(history.history(spark, root, "t"))
    same(rows(found), rows(backtest(full, actuals, ["id"], "t", "d", months_ahead=None).select(found.columns)))


def test_only_the_recorded_execution_is_read(spark, made, actuals, root):
    made.write.partitionBy("dt_execution").parquet(root + "/made")
    stored = spark.read.parquet(root + "/made")
    one = stored.where(F.col("dt_execution") == F.to_date(F.lit(DAYS[1])))
    text = plan(history.execution_sums(one, actuals, ["id"], "t", "d", ["k"]))
    assert text.count("Scan parquet") == 2 and "PartitionFilters: [isnotnull(dt_execution" in text
    recorded(spark, made, actuals, root)
    read = plan(history.history(spark, root, "t", executions=[DAYS[0]]))
    assert "PartitionFilters: [isnotnull(dt_execution" in read


def test_levels_and_summary_equal_those_of_the_rows(spark, made, actuals, root):
    sums = recorded(spark, made, actuals, root)
    joined = made.join(actuals, ["id", "d"])
    for full in (True, False):
        same(rows(history.recorded_levels(sums, ["k"], full)), rows(level_errors(joined, "t", "t_pred", ["k"], full)))
        same(rows(history.recorded_summary(sums, ["k"], full)), rows(error_summary(joined, "t", "t_pred", ["k"], full)))
    march = history.history(spark, root, "t", first_day="2018-03-01", last_day="2018-03-31")
    expected = level_errors(joined.where("month(d) = 3"), "t", "t_pred", ["dt_execution", "k"])
    same(rows(history.recorded_levels(march, ["dt_execution", "k"])), rows(expected))


def test_an_execution_without_known_days(spark, made, actuals, root):
    recorded(spark, made, actuals, root)
    history.record(made, actuals.where("false"), root, ["id"], "t", "d", ["k"], execution=DAYS[2])
    left = history.recorded_backtest(history.history(spark, root, "t"))
    assert sorted(str(r.dt_execution) for r in left.collect()) == DAYS[:2]
