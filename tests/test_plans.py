"""Physical plans: what reaches the scan, and what must never appear."""

import os

import pytest
from helpers import plan

from stridecast.workloads.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

MODELS = {name for name in QUERIES if name.startswith(("rf_", "feature_imp", "training_error"))}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert word not in text


@pytest.mark.parametrize(
    "name, filters",
    [
        ("train_cut", ["LessThan(o_orderdate,2001-01-01"]),
        ("fold_assign", ["GreaterThanOrEqual(o_orderdate,2001-01-01", "LessThan(o_orderdate,2001-07-01"]),
        ("fold_counts", ["GreaterThanOrEqual(o_orderdate,2001-01-01", "LessThan(o_orderdate,2001-07-01"]),
        ("union_folds", ["GreaterThanOrEqual(o_orderdate,2001-03-06", "LessThan(o_orderdate,2001-01-09"]),
        ("eval_rows", ["GreaterThanOrEqual(l_shipdate,2000-01-01"]),
        ("train_test_split", ["LessThan(o_orderdate,2001-01-01", "LessThan(o_orderdate,2001-07-01"]),
    ],
)
def test_date_filters_reach_the_scan(spark, name, filters):
    text = plan(QUERIES[name](spark, SF_DIR))
    pushed = "\n".join(line for line in text.splitlines() if "PushedFilters" in line)
    for f in filters:
        assert f in pushed


@pytest.mark.parametrize(
    "name, schema",
    [
        ("fold_counts", "struct<o_orderdate:timestamp_ntz>"),
        ("month_report", "struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>"),
        ("duplicate_check", "struct<l_orderkey:bigint,l_linenumber:int>"),
        ("date_range", "struct<o_orderdate:timestamp_ntz>"),
    ],
)
def test_only_needed_columns_are_read(spark, name, schema):
    text = plan(QUERIES[name](spark, SF_DIR))
    read = {line.split(": ", 1)[1] for line in text.splitlines() if line.startswith("ReadSchema")}
    assert read == {schema}


@pytest.mark.parametrize("name, scans", [("eval_summary", 1), ("error_means", 1), ("date_range", 1)])
def test_the_fact_table_is_read_once(spark, name, scans):
    fact = "lineitem" if name == "eval_summary" else "orders"
    text = plan(QUERIES[name](spark, SF_DIR))
    assert sum("Location" in line and fact in line for line in text.splitlines()) == scans


def test_levels_expand_groups_not_rows(spark):
    text = plan(QUERIES["eval_levels"](spark, SF_DIR)).splitlines()
    tree = [line.strip(" +-:*") for line in text if "(" in line]
    expand = next(i for i, line in enumerate(tree) if line.startswith("Expand"))
    join = next(i for i, line in enumerate(tree) if "HashJoin" in line)
    assert any(line.startswith("Exchange") for line in tree[expand:join])
