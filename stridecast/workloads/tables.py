"""The given tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridecast.config import FeatureSpec
from stridecast.operators.features import cyclical

SPLIT = "2001-01-01"
EVAL_START = "2000-01-01"

ORDER_SPEC = FeatureSpec(
    target="o_totalprice",
    date="o_orderdate",
    ids=("o_orderkey", "o_custkey"),
    features=(
        ("line_count", "quantity", "gross"),
        ("line_count", "quantity", "gross"),
        ("line_count", "quantity"),
        ("line_count", "quantity"),
        ("line_count",),
        ("line_count",),
    ),
    basic_features=((),) * 6,
    cyclical=("month", "weekday"),
    categorical=("o_orderpriority", "o_orderstatus"),
)


# All features are 0 or 1, so that SQL can grow the same tree.
FLAG_SPEC = FeatureSpec(
    target="o_totalprice",
    date="o_orderdate",
    ids=("o_orderkey",),
    features=(
        ("many", "bulky", "dear"),
        ("many", "bulky", "dear"),
        ("many", "bulky"),
        ("many", "bulky"),
        ("many",),
        ("many",),
    ),
    basic_features=((),) * 6,
    categorical=("o_orderpriority",),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: Column | str) -> Column:
    """Exact cents, so that sums do not depend on the order of the rows."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(18,2)")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the revenue and a simple forecast of it from the list price."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_type", "p_retailprice"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    return lines.join(part, "l_partkey").select(
        "l_orderkey",
        "l_linenumber",
        "p_type",
        "l_shipdate",
        F.date_format("l_shipdate", "yyyy-MM").alias("ship_month"),
        money("l_extendedprice").alias("revenue"),
        money(F.col("l_quantity") * F.col("p_retailprice")).alias("revenue_pred"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order totals of the line items."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("line_count"),
            F.sum(money("l_quantity")).cast("double").alias("quantity"),
            F.sum(money("l_extendedprice")).cast("double").alias("gross"),
        )
    )


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with line totals; an order without lines has none."""
    orders = table(spark, sf_dir, "orders")
    return orders.join(order_lines(spark, sf_dir), "o_orderkey", "left")


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared table the models learn from."""
    dated = order_history(spark, sf_dir).withColumns(
        {"month": F.month("o_orderdate"), "weekday": F.dayofweek("o_orderdate")}
    )
    return cyclical(dated, ["month", "weekday"], periods={"month": 12, "weekday": 7}, drop=True)


def order_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with line totals as flags; null for an order without lines."""
    return order_history(spark, sf_dir).select(
        "o_orderkey",
        "o_orderdate",
        "o_orderpriority",
        "o_totalprice",
        (F.col("line_count") >= 5).cast("double").alias("many"),
        (F.col("quantity") >= 100).cast("double").alias("bulky"),
        (F.col("gross") >= 200_000).cast("double").alias("dear"),
    )
