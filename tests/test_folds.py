import calendar
import datetime as dt

import pytest
from helpers import plan, rows

from stridecast.functions.dates import as_date
from stridecast.operators import evaluate, folds, split
from stridecast.operators.folds import assign_fold, fold_calendar, fold_rows
from stridecast.operators.reports import tag_execution
from stridecast.plans.backtest import last_days

ENDS = {
    "2018-01-31": "2018-06-30",
    "2018-07-15": "2018-12-31",
    "2018-08-31": "2019-01-31",
    "2018-09-30": "2019-02-28",
    "2018-12-31": "2019-05-31",
    "2019-09-01": "2020-02-29",
}


@pytest.fixture
def days(spark):
    return spark.sql(
        "select explode(sequence(date'2018-06-01', date'2019-02-28', interval 1 day)) as d"
    )


def test_calendar_ends_on_a_month_end_over_year_and_leap_day(spark):
    splits = spark.createDataFrame([(s,) for s in ENDS], "s string")
    got = {r.s: r.end_date.isoformat() for r in fold_calendar(splits, "s").collect() if r.fold == 5}
    assert got == ENDS


def test_calendar_of_every_day_of_a_leap_cycle(spark):
    splits = spark.sql(
        "select explode(sequence(date'2019-01-01', date'2022-12-31', interval 1 day)) as s"
    )
    got = fold_calendar(splits, "s").where("fold = 5").collect()
    assert len(got) == 1461
    for r in got:
        year, month = divmod(r.s.year * 12 + r.s.month - 1 + 5, 12)
        last = calendar.monthrange(year, month + 1)[1]
        assert r.end_date == dt.date(year, month + 1, last)


def test_calendar_is_adjacent_and_disjoint(spark):
    splits = spark.createDataFrame([("2018-01-31",)], "s string")
    folds = sorted(fold_calendar(splits, "s").collect(), key=lambda r: r.fold)
    split = dt.date(2018, 1, 31)
    offsets = [((r.start_date - split).days, (r.end_date - split).days) for r in folds]
    assert offsets[:5] == [(0, 7), (8, 14), (15, 32), (33, 45), (46, 63)]
    assert offsets[5][0] == 64


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_fold_of_each_row_agrees_with_the_calendar(spark, days, kind):
    typed = days.selectExpr(f"cast(d as {kind}) as x", "d")
    folds = fold_calendar(spark.createDataFrame([("2018-07-15",)], "s string"), "s").collect()
    expected = [
        (r.d, c.fold) for r in days.collect() for c in folds if c.start_date <= r.d <= c.end_date
    ]
    assert rows(assign_fold(typed, "x", "2018-07-15"), "d", "fold") == sorted(expected, key=repr)
    for c in folds:
        alone = [(d, f) for d, f in expected if f == c.fold]
        assert fold_rows(typed, "x", "2018-07-15", c.fold).count() == len(alone)


def test_last_day_of_a_fold_counts_to_its_end(spark):
    df = spark.sql(
        "select * from values (timestamp'2018-07-22 23:59:59.999999'), "
        "(timestamp'2018-07-23 00:00:00') t(x)"
    )
    assert [r.fold for r in assign_fold(df, "x", "2018-07-15").orderBy("x").collect()] == [0, 1]


def test_split_may_differ_by_row(spark):
    df = spark.sql(
        "select * from values ('2018-01-09', '2018-01-01'), ('2018-01-09', '2018-01-05') t(d, s)"
    ).selectExpr("to_date(d) as d", "s")
    assert rows(assign_fold(df, "d", df.s), "s", "fold") == [("2018-01-01", 1), ("2018-01-05", 0)]


def test_own_boundaries_and_horizon(spark, days):
    out = assign_fold(days, "d", "2018-07-15", starts=(0, 3), months_ahead=0)
    assert out.count() == 17
    assert out.where("fold = 0").count() == 3


def test_day_from_text_date_or_today():
    assert as_date("2018-02-03") == dt.date(2018, 2, 3)
    assert as_date(dt.datetime(2018, 2, 3, 4, 5)) == dt.date(2018, 2, 3)
    assert as_date() == dt.date.today()
    with pytest.raises(ValueError):
        as_date("03/02/2018")


def test_execution_tag_and_plain_date(spark):
    df = spark.sql("select timestamp'2018-07-22 10:00:00' as x")
    out = tag_execution(df, "2018-07-15", "x")
    assert dict(out.dtypes) == {"x": "date", "dt_execution": "date"}
    assert tuple(out.first()) == (dt.date(2018, 7, 22), dt.date(2018, 7, 15))


def test_no_fold_goes_past_a_short_horizon(spark):
    df = spark.sql("select explode(sequence(date'2018-06-01', date'2018-12-31')) as d")
    split, counts = "2018-06-10", []
    for fold in range(6):
        counts.append(fold_rows(df, "d", split, fold, months_ahead=0).count())
    assert sum(counts) == assign_fold(df, "d", split, months_ahead=0).count() == 21


def test_text_dates_give_the_same_rows_and_reach_the_scan(spark, root):
    spark.range(400).selectExpr(
        "id", "date_add(date'2018-01-01', cast(id % 200 as int)) as d"
    ).selectExpr("id", "d", "cast(d as string) as s", "concat(d, ' 12:30:00') as s2").write.parquet(root + "/t")
    df = spark.read.parquet(root + "/t")
    for text in ("s", "s2"):
        for fn, bounds in (
            (lambda c: split.train_rows(df, c, "2018-03-01"), ["LessThan({},2018-03-01)"]),
            (
                lambda c: folds.assign_fold(df, c, "2018-03-01", months_ahead=1),
                ["GreaterThanOrEqual({},2018-03-01)", "LessThan({},2018-05-01)"],
            ),
            (
                lambda c: folds.fold_rows(df, c, "2018-03-01", 1),
                ["GreaterThanOrEqual({},2018-03-09)", "LessThan({},2018-03-16)"],
            ),
            (
                lambda c: evaluate.evaluation_rows(df, "id", "id", c, "2018-06-01"),
                ["GreaterThanOrEqual({},2018-06-01)"],
            ),
        ):
            assert rows(fn(text)) == rows(fn("d")) != []
            assert all(b.format(text) in plan(fn(text)) for b in bounds)
        cut = split.train_test(df, text, "2018-03-01")
        assert rows(cut) == rows(split.train_test(df, "d", "2018-03-01"))
        assert rows(last_days(df, text, 7)) == rows(last_days(df, "d", 7)) != []


MANY = ["2018-06-01", "2018-07-15", "2018-07-15", None, "2018-08-31", "2018-12-31", "2020-02-29"]


def each_split(df, splits, **settings):
    """The same rows split by split."""
    found = []
    for s in sorted({s for s in splits if s}):
        one = folds.assign_fold(df, "x", s, **settings)
        found += [(r.d, dt.date.fromisoformat(s), r.fold) for r in one.collect()]
    return sorted(found, key=repr)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
@pytest.mark.parametrize("settings", [{}, {"months_ahead": 0}, {"starts": (0, 3), "months_ahead": 1}])
def test_many_splits_equal_one_by_one(spark, days, kind, settings):
    df = days.selectExpr(f"cast(d as {kind}) as x", "d").unionByName(
        spark.sql(f"select cast(null as {kind}) as x, cast(null as date) as d")
    )
    if kind.startswith("timestamp"):
        df = df.selectExpr("x + interval 23 hours as x", "d")
    splits = spark.createDataFrame([(s,) for s in MANY], "split string")
    got = folds.assign_folds(df, "x", splits, "split", **settings)
    assert got.columns == ["x", "d", "split", "fold"]
    assert rows(got, "d", "split", "fold") == each_split(df, MANY, **settings)


def test_many_splits_without_broadcast(spark, days):
    df = days.selectExpr("d as x", "d", "'old' as split", "9 as FOLD")
    df = df.unionByName(df.where("d = '2018-08-01'").selectExpr("*", "explode(sequence(1, 500)) as n").drop("n"))
    splits = spark.createDataFrame([(s,) for s in MANY], "split string")
    got = folds.assign_folds(df, "x", splits, "split", broadcast_bytes=-1, rows_per_task=50)
    assert rows(got, "d", "split", "fold") == each_split(df, MANY)
    assert "BroadcastNestedLoopJoin" not in plan(got) and "CartesianProduct" not in plan(got)


def test_many_splits_prune_the_scan(spark, days, root):
    days.selectExpr("d as x", "1 as y").write.parquet(root + "/days")
    df = spark.read.parquet(root + "/days")
    splits = spark.createDataFrame([("2018-07-01",), ("2018-07-09",)], "s string")
    text = plan(folds.assign_folds(df, "x", splits, "s", months_ahead=1))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line and "x" in line)
    assert "GreaterThanOrEqual(x,2018-07-01)" in pushed and "LessThan(x,2018-09-01)" in pushed
    assert text.count("BroadcastHashJoin") >= 1 and "SortMergeJoin" not in text


def test_no_splits(spark, days):
    none = spark.createDataFrame([(None,)], "s string")
    got = folds.assign_folds(days.selectExpr("d as x"), "x", none, "s")
    assert got.collect() == [] and got.columns == ["x", "s", "fold"]
