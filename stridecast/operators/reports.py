"""Checks and summaries of a result table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stridecast.functions.dates import Day, day_column, month_of


def tag_execution(df: DataFrame, execution: Day, date: str | None = None) -> DataFrame:
    """Adds the execution day, and makes the date column a plain date."""
    tagged = df.withColumn("dt_execution", day_column(execution))
    return tagged.withColumn(date, F.to_date(date)) if date else tagged


def distinct_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key."""
    return df.dropDuplicates(list(keys))


def duplicate_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys minus rows: zero, or minus the number of surplus rows."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    surplus = F.count(F.lit(1)) - F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(surplus.alias("duplicates"))


def fold_counts(df: DataFrame, by: Sequence[str] = ("fold",)) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


def month_report(df: DataFrame, date: str, counted: str, amount: str) -> DataFrame:
    """Rows with a value in ``counted``, and the summed amount, month by month."""
    return (
        df.groupBy(month_of(date).alias("month"))
        .agg(F.count(counted).alias("row_count"), F.sum(amount).alias("total"))
        .orderBy("month")
    )


def date_range(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """First and last day, of all rows or per group."""
    day = F.to_date(date)
    return df.groupBy(*by).agg(F.min(day).alias("date_min"), F.max(day).alias("date_max"))


class Seen:
    """What a job sees of rows while it passes them on: full and basic test rows, scored
    rows, and their days. Read it when the job is done; it costs no scan of its own.

    Counts are Spark's observed metrics, of the tasks whose results are used.
    """

    def __init__(self):
        self._tests, self._scored = Observation(), Observation()

    def tests(self, rows: DataFrame, is_basic: Column) -> DataFrame:
        return rows.observe(
            self._tests,
            F.coalesce(F.count_if(~is_basic), F.lit(0)).alias("n_full"),
            F.coalesce(F.count_if(is_basic), F.lit(0)).alias("n_basic"),
        )

    def scored(self, rows: DataFrame, date: str) -> DataFrame:
        day = F.to_date(date)
        return rows.observe(
            self._scored,
            F.count(F.lit(1)).alias("n"),
            F.min(day).alias("first"),
            F.max(day).alias("last"),
        )

    def metrics(self, results: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``prediction_metrics`` of the rows that were seen; ``results`` are read for
        duplicates of their keys alone."""
        tests, scored = self._tests.get, self._scored.get
        # The names of the metrics.
        return duplicate_check(results, keys).select(
            F.col("duplicates").alias("check_duplicates"),
            F.lit(scored["n"]).cast("long").alias("results_full_count"),
            F.lit(tests["n_full"]).cast("long").alias("test_set_count"),
            F.lit(tests["n_basic"]).cast("long").alias("test_basic_set_count"),
            F.lit(scored["first"]).cast("date").alias("pred_date_min"),
            F.lit(scored["last"]).cast("date").alias("pred_date_max"),
        )


def prediction_metrics(
    df: DataFrame, tests: DataFrame, keys: Sequence[str], date: str
) -> DataFrame:
    """Duplicates, row counts and date range of scored rows, in one row.

    The test sets are counted in ``tests``, which has the rows to be scored with their
    ``is_basic``, so that rows lost in scoring show up.
    """
    counted = tests.agg(
        F.struct(
            F.count_if(~F.col("is_basic")).alias("n_full"),
            F.count_if(F.col("is_basic")).alias("n_basic"),
        )
    ).scalar()
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.to_date(date)).alias("d_min"),
        F.max(F.to_date(date)).alias("d_max"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    metrics = per_key.agg(
        (F.count(F.lit(1)) - total("n")).alias("check_duplicates"),
        total("n").alias("results_full_count"),
        F.min("d_min").alias("pred_date_min"),
        F.max("d_max").alias("pred_date_max"),
    ).withColumn("_tests", counted)
    # The names of the metrics.
    return metrics.select(
        "check_duplicates",
        "results_full_count",
        F.col("_tests.n_full").alias("test_set_count"),
        F.col("_tests.n_basic").alias("test_basic_set_count"),
        "pred_date_min",
        "pred_date_max",
    )
