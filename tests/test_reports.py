import datetime as dt

from helpers import rows

from stridecast.operators import reports

DUPLICATES = [("a", "x"), ("a", "x"), ("a", None), ("a", None), (None, None), ("b", "x")]


def test_duplicate_check_counts_null_keys(spark):
    df = spark.createDataFrame(DUPLICATES, "k1 string, k2 string")
    assert reports.duplicate_check(df, ["k1", "k2"]).first().duplicates == -2
    assert reports.duplicate_check(df.distinct(), ["k1", "k2"]).first().duplicates == 0
    assert reports.duplicate_check(df.limit(0), ["k1", "k2"]).first().duplicates == 0


def test_distinct_rows_keep_one_per_key(spark):
    df = spark.createDataFrame([(*k, i) for i, k in enumerate(DUPLICATES)], "k1 string, k2 string, i int")
    out = reports.distinct_rows(df, ["k1", "k2"])
    assert out.columns == df.columns
    assert rows(out, "k1", "k2") == rows(df.select("k1", "k2").distinct())


def test_month_report_is_sorted_and_counts_values(spark):
    df = spark.sql(
        "select * from values (date'2018-02-03', 'a', 2.0), (date'2018-01-31', null, 3.0), "
        "(date'2018-02-28', 'b', null) t(d, c, x)"
    )
    assert [tuple(r) for r in reports.month_report(df, "d", "c", "x").collect()] == [
        ("2018-01", 0, 3.0),
        ("2018-02", 2, 2.0),
    ]


def test_fold_counts_and_date_range(spark):
    df = spark.sql(
        "select * from values (0, '2018-02-03'), (0, '2018-01-31'), (1, '2018-03-01') t(fold, d)"
    )
    assert rows(reports.fold_counts(df)) == [(0, 2), (1, 1)]
    assert tuple(reports.date_range(df, "d").first()) == (dt.date(2018, 1, 31), dt.date(2018, 3, 1))
    assert rows(reports.date_range(df, "d", ["fold"]))[1][0] == 1
    assert tuple(reports.date_range(df.limit(0), "d").first()) == (None, None)


def test_prediction_metrics(spark):
    df = spark.sql(
        "select * from values ('a', date'2018-02-03', 'full'), ('a', date'2018-02-03', 'full'), "
        "('b', date'2018-01-01', 'basic'), ('c', date'2018-01-02', 'unscored') t(id, d, variant)"
    )
    tests = spark.sql("select * from values (false), (false), (false), (true) t(is_basic)")
    got = reports.prediction_metrics(df, tests, ["id", "d"], "d").first()
    assert tuple(got) == (-1, 4, 3, 1, dt.date(2018, 1, 1), dt.date(2018, 2, 3))
    nothing = reports.prediction_metrics(df.limit(0), tests.limit(0), ["id"], "d").first()
    assert tuple(nothing) == (0, 0, 0, 0, None, None)
