"""Comparing rows whatever their order."""

import math


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def rows(df, *columns):
    data = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in data), key=repr)


def close(a, b, tolerance=1e-9):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)
