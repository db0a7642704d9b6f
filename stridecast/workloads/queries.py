"""One query per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridecast.config import BASIC, FULL, INDEX, ONE_HOT, ForestParams
from stridecast.functions.dates import as_date, before
from stridecast.operators import evaluate, features, folds, prep, reports, split
from stridecast.operators.forest import importance_report
from stridecast.plans import history
from stridecast.plans.backtest import backtest as run_backtest
from stridecast.plans.evaluation import Evaluation, evaluate as run_evaluation
from stridecast.plans.predict import predict, union_results
from stridecast.plans.train import train, training_metrics, training_set
from stridecast.sources.results import csv_path, read_predictions, write_csv, write_predictions
from stridecast.sources.shared import shared_folder
from stridecast.workloads.tables import (
    EVAL_START,
    FLAG_SPEC,
    ORDER_SPEC,
    SPLIT,
    money,
    order_features,
    order_flags,
    order_history,
    sales,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

PARAMS = ForestParams(num_trees=10, max_depth=5, max_features="onethird")
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _plain_date(df: DataFrame, date: str = "o_orderdate") -> DataFrame:
    return df.withColumn(date, F.to_date(date))


# --- errors and evaluation


@query
def error_cols(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax"
    )
    return evaluate.error_columns(lines, "l_discount", "l_tax")


@query
def eval_rows(spark, sf_dir):
    rows = evaluate.evaluation_rows(
        sales(spark, sf_dir), "revenue", "revenue_pred", "l_shipdate", EVAL_START
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "p_type",
        F.to_date("l_shipdate").alias("l_shipdate"),
        F.col("revenue").cast("double").alias("revenue"),
        F.col("revenue_pred").cast("double").alias("revenue_pred"),
        "revenue_APE",
        "revenue_AE",
    )


def _evaluated(spark: SparkSession, sf_dir: str, full: bool = True) -> Evaluation:
    levels = ["p_type", "ship_month"]
    rows = sales(spark, sf_dir)
    return run_evaluation(rows, "revenue", "revenue_pred", "l_shipdate", None, levels, full)


@query
def eval_levels(spark, sf_dir):
    return _evaluated(spark, sf_dir).levels


@query
def eval_levels_basic(spark, sf_dir):
    return _evaluated(spark, sf_dir, full=False).levels


@query
def eval_summary(spark, sf_dir):
    return _evaluated(spark, sf_dir).summary.withColumn("value", F.round("value", 6))


@query
def outlier_share(spark, sf_dir):
    return evaluate.outlier_share(_evaluated(spark, sf_dir).rows, "revenue", "revenue_pred")


@query
def error_means(spark, sf_dir):
    """The training-error table for a forecast that needs no model: the line totals."""
    orders = split.flag_basic(order_history(spark, sf_dir), ["quantity"])
    rows = split.train_test(orders, "o_orderdate", SPLIT)
    means = evaluate.error_means(rows, "o_totalprice", "gross", "o_orderkey", ["fold", "is_basic"])
    return means.withColumns({"mape": F.round("mape", 6), "mae": F.round("mae", 6)})


# --- calendar, splits, samples


@query
def fold_calendar(spark, sf_dir):
    """The calendar of every day on which an execution could have started."""
    days = _orders(spark, sf_dir).select(F.to_date("o_orderdate").alias("split_date")).distinct()
    return folds.fold_calendar(days, "split_date")


@query
def fold_assign(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return _plain_date(folds.assign_fold(orders, "o_orderdate", SPLIT))


@query
def fold_assign_months(spark, sf_dir):
    """Each order's fold in every execution on the first of a month that tests it."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    months = orders.select(F.trunc("o_orderdate", "month").alias("month"))
    found = folds.assign_folds(orders, "o_orderdate", months, "month")
    return _plain_date(found.withColumnRenamed("month", "split_date"))


@query
def fold_counts_daily(spark, sf_dir):
    """Rows and amount of each fold of every day on which an execution could have started."""
    orders = _orders(spark, sf_dir).select("o_orderdate", money("o_totalprice").alias("price"))
    days = orders.select(F.col("o_orderdate").alias("split_date"))
    found = folds.assign_folds(orders, "o_orderdate", days, "split_date", months_ahead=1)
    return found.groupBy("split_date", "fold").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("price").cast("double").alias("total")
    )


@query
def fold_assign_short(spark, sf_dir):
    """A horizon that ends before the last folds begin: these have no rows."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return _plain_date(folds.assign_fold(orders, "o_orderdate", "2001-01-10", months_ahead=0))


@query
def fold_calendar_short(spark, sf_dir):
    """The same rows from the calendar of each fold."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    parts = [
        folds.fold_rows(orders, "o_orderdate", "2001-01-10", i, months_ahead=0).withColumn(
            "fold", F.lit(i)
        )
        for i in ORDER_SPEC.folds
    ]
    return _plain_date(union_results(parts))


@query
def fold_assign_timestamps(spark, sf_dir):
    """Events carry a time of day: the last day of a fold counts to its end."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return folds.assign_fold(events, "ts", "2024-01-01", starts=(0, 8, 15), months_ahead=0).select(
        "event_id", "user_id", "fold"
    )


@query
def train_cut(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "o_orderdate")
    return _plain_date(split.train_rows(orders, "o_orderdate", SPLIT))


@query
def train_test_split(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return split.train_test(orders, "o_orderdate", SPLIT).drop("o_orderdate")


@query
def split_fold_frames(spark, sf_dir):
    """The sampled training part and the test part of every fold, counted in one pass."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_totalprice")
    rows = split.sampled_train_test(orders, "o_orderdate", SPLIT, 0.5, ["o_orderkey"])
    parts = rows.groupBy("role", "fold").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(money("o_totalprice")).cast("double").alias("total"),
    )
    every = F.array(*map(F.lit, ORDER_SPEC.folds))
    folds_of = F.when(F.col("role") == "train", every).otherwise(F.array("fold"))
    return parts.withColumn("fold", F.explode(folds_of)).withColumn(
        "scale", F.col("row_count") * F.col("fold")
    )


@query
def sample_fraction(spark, sf_dir):
    return split.sample_fraction(_orders(spark, sf_dir), ["o_orderkey"], 0.3).select("o_orderkey")


@query
def sample_count(spark, sf_dir):
    train_part = split.train_rows(_orders(spark, sf_dir), "o_orderdate", SPLIT)
    return split.sample_training(train_part, 5000, ["o_orderkey"]).select(
        "o_orderkey", "o_totalprice"
    )


@query
def feature_projection(spark, sf_dir):
    data = order_features(spark, sf_dir)
    return _plain_date(split.project_fold(data, ORDER_SPEC, 2))


@query
def null_routing(spark, sf_dir):
    orders = order_history(spark, sf_dir)
    flagged = split.flag_basic(orders, ORDER_SPEC.features[0])
    return flagged.select("o_orderkey", "is_basic")


@query
def null_routing_sets(spark, sf_dir):
    """The rows of fold 0's full model, and those that fall back to its basic model."""
    rows = split.with_variant(order_history(spark, sf_dir), ORDER_SPEC.features[0])
    return rows.select("o_orderkey", "quantity", "variant")


@query
def nan_routing(spark, sf_dir):
    """A feature that is not a number counts as lacking, as null does."""
    rows = order_history(spark, sf_dir).withColumn(
        "quantity", F.when(F.col("o_orderstatus") == "P", float("nan")).otherwise(F.col("quantity"))
    )
    return split.with_variant(rows, ["quantity"]).select("o_orderkey", "variant")


# --- features


@query
def cyclical(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(
        "o_orderkey",
        F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").cast("string").alias("day"),
    )
    return features.cyclical(orders, ["month", "day"], drop=True)


@query
def cyclical_null_period(spark, sf_dir):
    """A null counts as one more step of the cycle, as any distinct value does."""
    orders = _orders(spark, sf_dir).select(
        "o_orderkey", F.nullif(F.month("o_orderdate"), F.lit(5)).alias("month")
    )
    return features.cyclical(orders, ["month"])


@query
def distinct_values(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(
        "o_orderpriority", F.nullif("o_orderstatus", F.lit("F")).alias("status"), "o_custkey"
    )
    return features.distinct_values(orders, ["o_orderpriority", "status", "o_custkey"])


@query
def group_totals(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("segment"),
        money("o_totalprice").alias("price"),
        F.lit(1).alias("one"),
    )
    return features.group_totals(orders, ["price", "one"], "segment").select(
        "o_orderkey",
        "segment",
        F.col("sum_price_by_segment").cast("double").alias("sum_price_by_segment"),
        "sum_one_by_segment",
    )


@query
def group_totals_trailing(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", "o_orderdate", money("o_totalprice").alias("price")
    )
    name = "sum_price_by_o_custkey_30d"
    totals = features.trailing_totals(orders, ["price"], "o_custkey", "o_orderdate", 30)
    return totals.select("o_orderkey", F.col(name).cast("double").alias(name))


@query
def minority_relabel(spark, sf_dir):
    orders = _orders(spark, sf_dir).select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("customer"),
        money("o_totalprice").alias("price"),
    )
    return features.relabel_by_total(orders, "customer", "price", 2_500_000).select(
        "o_orderkey", "customer"
    )


@query
def dummies(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return features.dummies(orders, ["o_orderpriority", "o_orderstatus", "not_there"])[0]


@query
def dummy_vectors(spark, sf_dir):
    """One slot per customer but the first, as a sparse vector in its text form."""
    orders = _orders(spark, sf_dir).select(
        "o_orderkey", F.nullif(F.col("o_custkey"), F.lit(7)).alias("customer")
    )
    encoded = features.dummy_vector(orders, "customer")
    return encoded.select("o_orderkey", F.col("customer_vec").cast("string").alias("customer_vec"))


# --- model inputs


def _train_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).where(before("o_orderdate", SPLIT))


@query
def string_index(spark, sf_dir):
    indexer = prep.string_indexer(["o_orderpriority", "o_orderstatus"])
    model = indexer.fit(_train_orders(spark, sf_dir))
    return model.transform(_orders(spark, sf_dir)).select(
        "o_orderkey", "o_orderpriority" + INDEX, "o_orderstatus" + INDEX
    )


@query
def string_index_table(spark, sf_dir):
    """The index of every customer from a table of labels, saved and loaded in a pipeline."""
    path = shared_folder(spark, "index")
    indexer = prep.table_indexer(["o_custkey", "o_orderpriority"])
    Pipeline(stages=[indexer]).fit(_train_orders(spark, sf_dir)).write().save(path)
    found = PipelineModel.load(path).transform(_orders(spark, sf_dir))
    return found.select("o_orderkey", "o_custkey" + INDEX, "o_orderpriority" + INDEX)


@query
def one_hot(spark, sf_dir):
    """Fitted without one priority, which then shares the last slot with nulls."""
    known = _train_orders(spark, sf_dir).where(F.col("o_orderpriority") != "5-LOW")
    column = ["o_orderpriority"]
    stages = [prep.string_indexer(column), prep.one_hot_encoder(column)]
    model = Pipeline(stages=stages).fit(known)
    encoded = model.transform(_orders(spark, sf_dir)).select(
        "o_orderkey", F.col("o_orderpriority" + ONE_HOT).alias("v")
    )
    return prep.slots(encoded, "v", "slot_")


@query
def assemble(spark, sf_dir):
    numeric, category = ["o_totalprice", "month"], ["o_orderpriority"]

    def with_month(df):
        return df.withColumn("month", F.month("o_orderdate"))

    model = prep.preparation(numeric, category).fit(with_month(_train_orders(spark, sf_dir)))
    vectors = model.transform(with_month(_orders(spark, sf_dir)))
    return prep.slots(vectors.select("o_orderkey", "features"), "features", "feature_")


# --- results and reports


@query
def union_folds(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_totalprice")
    parts = [
        folds.fold_rows(orders, "o_orderdate", SPLIT, i).withColumn("fold", F.lit(i))
        for i in ORDER_SPEC.folds
    ]
    return reports.tag_execution(union_results(parts), SPLIT, "o_orderdate")


@query
def dedup_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return reports.distinct_rows(lines, ["l_orderkey", "l_linenumber"]).drop("l_quantity")


@query
def duplicate_check(spark, sf_dir):
    return reports.duplicate_check(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def fold_counts(spark, sf_dir):
    return reports.fold_counts(folds.assign_fold(_orders(spark, sf_dir), "o_orderdate", SPLIT))


@query
def month_report(spark, sf_dir):
    orders = _orders(spark, sf_dir).withColumn("price", money("o_totalprice"))
    report = reports.month_report(orders, "o_orderdate", "o_orderpriority", "price")
    return report.withColumn("total", F.col("total").cast("double"))


@query
def date_range(spark, sf_dir):
    rows = split.train_test(_orders(spark, sf_dir), "o_orderdate", SPLIT)
    return reports.date_range(rows, "o_orderdate", ["role"])


@query
def run_metrics_train(spark, sf_dir):
    rows = training_set(order_features(spark, sf_dir), ORDER_SPEC, SPLIT)
    return training_metrics(rows, ORDER_SPEC, PARAMS, 1.0)


@query
def run_metrics_predict(spark, sf_dir):
    orders = split.flag_basic(order_history(spark, sf_dir), ["quantity"])
    rows = folds.assign_fold(orders, "o_orderdate", SPLIT)
    return reports.prediction_metrics(
        rows.drop("is_basic"), rows, ["o_custkey", "o_orderpriority"], "o_orderdate"
    )


def _monthly_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line totals as forecasts, made on the first day of each order's month."""
    return order_history(spark, sf_dir).select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("o_orderdate"),
        F.col("gross").alias("o_totalprice_pred"),
        F.trunc("o_orderdate", "month").alias("dt_execution"),
    )


@query
def results_written(spark, sf_dir):
    """Predictions written by execution; some executions read back."""
    root = shared_folder(spark, "results")
    write_predictions(_monthly_forecasts(spark, sf_dir), root, "o_totalprice", gather=True)
    return read_predictions(
        spark, root, "o_totalprice", ["2000-11-01", "2000-12-01", SPLIT], last_execution=SPLIT
    )


@query
def results_rerun(spark, sf_dir):
    """An execution written again: the earlier rows go, other executions stay."""
    root = shared_folder(spark, "results")
    made = _monthly_forecasts(spark, sf_dir)
    write_predictions(made, root, "o_totalprice", gather=True)
    again = made.where((F.col("dt_execution") == as_date(SPLIT)) & F.col("o_totalprice_pred").isNull())
    write_predictions(again, root, "o_totalprice", execution=SPLIT)
    return read_predictions(spark, root, "o_totalprice")


@query
def results_csv(spark, sf_dir):
    """Results as CSV with a header."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_totalprice")
    rows = reports.tag_execution(orders, SPLIT, "o_orderdate")
    path = csv_path(shared_folder(spark, "results"), "o_totalprice", "results", SPLIT)
    write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query
def backtest(spark, sf_dir):
    root = shared_folder(spark, "backtest")
    write_predictions(_monthly_forecasts(spark, sf_dir), root, "o_totalprice", gather=True)
    past = read_predictions(spark, root, "o_totalprice")
    actuals = _orders(spark, sf_dir)
    errors = run_backtest(past, actuals, ["o_orderkey"], "o_totalprice", "o_orderdate")
    return errors.select(
        "dt_execution",
        F.round("mape", 6).alias("mape"),
        F.round("mae", 4).alias("mae"),
        F.round(F.sqrt("mse"), 4).alias("rmse"),
        "row_count",
        "outlier_count",
    )


@query
def backtest_history(spark, sf_dir):
    """The back-test from recorded sums: all executions but one, then that one, and one again."""
    root = shared_folder(spark, "history")
    made, actuals = _monthly_forecasts(spark, sf_dir), _orders(spark, sf_dir)
    late, again = as_date("2001-03-01"), as_date(SPLIT)
    spoilt = F.when(F.col("dt_execution") == again, 0.0).otherwise(F.col("o_totalprice_pred"))
    first = made.where(F.col("dt_execution") != late).withColumn("o_totalprice_pred", spoilt)
    settings = (actuals, root, ["o_orderkey"], "o_totalprice", "o_orderdate")
    history.record(first, *settings)
    history.record(made, *settings, execution=late)
    history.record(made, *settings, execution=again)
    sums = history.history(spark, root, "o_totalprice")
    errors = history.recorded_backtest(sums, days=900)
    return errors.select(
        "dt_execution",
        F.round("mape", 6).alias("mape"),
        F.round("mae", 4).alias("mae"),
        F.round(F.sqrt("mse"), 4).alias("rmse"),
        "row_count",
        "outlier_count",
    )


@query
def history_levels(spark, sf_dir):
    """Errors by execution and priority, and by each alone, from recorded sums."""
    root = shared_folder(spark, "history")
    orders = _orders(spark, sf_dir).withColumn("o_totalprice", money("o_totalprice"))
    made = _monthly_forecasts(spark, sf_dir)
    made = made.withColumn("o_totalprice_pred", money("o_totalprice_pred"))
    history.record(made, orders, root, ["o_orderkey"], "o_totalprice", "o_orderdate", ["o_orderpriority"])
    sums = history.history(spark, root, "o_totalprice", first_day="2000-01-15", last_day="2001-02-10")
    return history.recorded_levels(sums, ["dt_execution", "o_orderpriority"])


# --- models


SMALL = ForestParams(num_trees=3, max_depth=2, max_features="all")
# One tree of one split on flags, without a bootstrap: SQL finds the split with the
# largest reduction of the variance, and the means of its two sides.
STUMP = ForestParams(num_trees=1, max_depth=1, max_features="all", bootstrap=False)


@query
def rf_predict(spark, sf_dir):
    """Train on the past, save, load, and score every test row."""
    root = shared_folder(spark, "models")
    data = order_flags(spark, sf_dir)
    train(data, FLAG_SPEC, SPLIT, STUMP, root=root)
    results = predict(data, FLAG_SPEC, SPLIT, root=root).results
    return results.withColumn(FLAG_SPEC.prediction, F.round(FLAG_SPEC.prediction, 4))


@query
def predict_checks(spark, sf_dir):
    """The metrics of a prediction that is written, also as CSV: counted while it is written."""
    root = shared_folder(spark, "checked")
    data = order_features(spark, sf_dir)
    models = train(data, ORDER_SPEC, SPLIT, SMALL).models
    out = predict(data, ORDER_SPEC, SPLIT, models=models, root=root, checks=True, csv=True)
    saved = spark.read.option("header", True).csv(csv_path(root, ORDER_SPEC.target, "results", SPLIT))
    rows = saved.agg(F.count(F.lit(1)).alias("csv_count")).scalar()
    return out.metrics.withColumn("csv_count", rows)


@query
def feature_importance(spark, sf_dir):
    """Name, slot, value and rank of every feature, written as CSV and read back."""
    root = shared_folder(spark, "importances")
    data = order_flags(spark, sf_dir)
    models = train(data, replace(FLAG_SPEC, basic_features=()), SPLIT, STUMP).models
    report = importance_report(models, data, FLAG_SPEC.target, SPLIT)
    path = csv_path(root, FLAG_SPEC.target, "feat_importance", SPLIT)
    write_csv(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query
def training_error(spark, sf_dir):
    errors = train(order_flags(spark, sf_dir), FLAG_SPEC, SPLIT, STUMP, checks=True).errors
    return errors.withColumns({"mape": F.round("mape", 6), "mae": F.round("mae", 4)})


# Larger forests, for measuring alone: their values follow from MLlib's random draws.
FORESTS: dict[str, Query] = {}


def forest(fn: Query) -> Query:
    FORESTS[fn.__name__] = fn
    return fn


@forest
def forest_predict(spark, sf_dir):
    root = shared_folder(spark, "models")
    data = order_features(spark, sf_dir)
    train(data, ORDER_SPEC, SPLIT, PARAMS, root=root)
    return predict(data, ORDER_SPEC, SPLIT, root=root).results


@forest
def forest_importance(spark, sf_dir):
    data = order_features(spark, sf_dir)
    full_only = replace(ORDER_SPEC, basic_features=())
    models = train(data, full_only, SPLIT, PARAMS).models
    return importance_report(models, data, full_only.target, SPLIT)


@forest
def forest_training_error(spark, sf_dir):
    data = order_features(spark, sf_dir)
    return train(data, ORDER_SPEC, SPLIT, PARAMS, checks=True).errors


# What holds for any forest, so that SQL can check it.


@query
def rf_predict_counts(spark, sf_dir):
    """Every test row has one prediction, from the model it belongs to."""
    data = order_features(spark, sf_dir)
    models = train(data, ORDER_SPEC, SPLIT, SMALL).models
    root = shared_folder(spark, "scores")
    results = predict(data, ORDER_SPEC, SPLIT, models=models, root=root).results
    return results.groupBy("fold", "variant", "dt_execution").agg(
        F.count(ORDER_SPEC.prediction).alias("row_count"),
        F.sum("o_orderkey").alias("key_sum"),
        F.min("o_orderdate").alias("date_min"),
        F.max("o_orderdate").alias("date_max"),
    )


@query
def training_error_counts(spark, sf_dir):
    """The training error of the first and last fold covers the rows of each model."""
    data = order_features(spark, sf_dir)
    errors = train(data, ORDER_SPEC, SPLIT, SMALL, checks=True).errors.where("row_count > 0")
    return errors.select(
        "fold", "variant", "row_count", ((F.col("mae") > 0) & (F.col("mape") > 0)).alias("has_error")
    )


@query
def feature_importance_totals(spark, sf_dir):
    """Each fold's importances name every feature and label, and add up to one."""
    data = order_features(spark, sf_dir)
    full_only = replace(ORDER_SPEC, basic_features=())
    models = train(data, full_only, SPLIT, SMALL).models
    report = importance_report(models, data, full_only.target, SPLIT)
    return report.groupBy("fold", "model", "target_variable", "dt_execution").agg(
        F.count_distinct("variable").alias("variable_count"),
        F.round(F.sum("importance"), 6).alias("importance"),
    )
