import math

import pytest
from helpers import close, plan, rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stridecast.functions.encode import keep_or_minority
from stridecast.operators import features
from stridecast.operators.lookup import attach, measured_bytes, split_above


def test_cyclical_casts_text_and_counts_null(spark):
    df = spark.createDataFrame([("1",), ("2",), ("12",), (None,)], "x string")
    got = {r.x: (r.x_sin, r.x_cos) for r in features.cyclical(df, ["x"]).collect()}
    for x in (1, 2, 12):
        assert close(got[str(x)][0], math.sin(2 * math.pi * x / 4))
        assert close(got[str(x)][1], math.cos(2 * math.pi * x / 4))
    assert got[None] == (None, None)


def test_cyclical_of_malformed_text_is_null(spark):
    df = spark.createDataFrame([("1",), ("one",)], "x string")
    got = {r.x: r.x_sin for r in features.cyclical(df, ["x"]).collect()}
    assert got["one"] is None and close(got["1"], math.sin(math.pi))


def test_cyclical_on_no_rows(spark):
    df = spark.createDataFrame([], "x int")
    out = features.cyclical(df, ["x"])
    assert out.columns == ["x", "x_sin", "x_cos"] and out.count() == 0


def test_cyclical_period_may_be_fixed_and_originals_dropped(spark):
    df = spark.createDataFrame([(3, 1), (6, 2)], "m int, w int")
    out = features.cyclical(df, ["m", "w"], periods={"m": 12}, drop=True)
    assert out.columns == ["m_sin", "m_cos", "w_sin", "w_cos"]
    assert close(out.first().m_sin, 1.0)
    assert close(out.first().w_cos, math.cos(math.pi))


def test_cyclical_reads_the_data_twice_at_most(spark, root):
    spark.range(100).selectExpr("id % 12 as m", "id % 7 as w", "id").write.parquet(root + "/c")
    out = features.cyclical(spark.read.parquet(root + "/c"), ["m", "w"])
    out.collect()
    assert plan(out).count("(1) Scan parquet") >= 1
    assert plan(out).count("Subquery:1") == 1 and "Subquery:2" not in plan(out)


GROUPS = [("a", 1), ("a", 2), (None, 3), ("b", None)]


@pytest.mark.parametrize("broadcast_bytes", [10**6, 0])
def test_group_totals_leave_out_null_keys(spark, broadcast_bytes):
    df = spark.createDataFrame(GROUPS, "k string, v int")
    out = features.group_totals(df, ["v"], "k", broadcast_bytes)
    assert out.columns == ["k", "v", "sum_v_by_k"]
    assert rows(out) == [("a", 1, 3), ("a", 2, 3), ("b", None, None)]


def test_totals_made_twice_are_replaced(spark):
    df = spark.createDataFrame(GROUPS, "k string, v int")
    once = features.group_totals(df, ["v"], "k")
    assert rows(features.group_totals(once, ["v"], "k")) == rows(once)


def skewed(spark, n=3000):
    """One key holds a third of all rows, and one day of it half of them."""
    return spark.range(n).selectExpr(
        "id",
        "if(id % 3 = 0, 0, id % 97) as k",
        "case when id % 3 = 0 and id % 2 = 0 then date'2018-03-01' when id % 50 = 1 then null "
        "else date_add(date'2018-01-01', cast(id % 89 as int)) end as d",
        "cast(id as decimal(18,2)) as v",
        "id % 5 as u",
    )


@pytest.mark.parametrize("rows_per_task", [1, 40, 10**6])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_every_way_of_attaching_gives_the_same_rows(spark, rows_per_task, how):
    df = skewed(spark).withColumn("k", F.nullif("k", F.lit(5)))
    totals = df.where("k <> 11").groupBy("k").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
    expected = rows(df.join(totals.drop("n"), "k", how).select(*df.columns, "s"))
    assert rows(attach(df, totals, ["k"], "n", how=how)) == expected
    assert rows(attach(df, totals, ["k"], "n", 0, rows_per_task, how)) == expected


@pytest.mark.parametrize("rows_per_task", [1, 40, 10**6])
def test_group_totals_beyond_the_broadcast_equal_the_window(spark, rows_per_task):
    df = skewed(spark)
    out = features.group_totals(df, ["v", "u"], "k", 0, rows_per_task)
    group = W.partitionBy("k")
    assert out.columns == [*df.columns, "sum_v_by_k", "sum_u_by_k"]
    assert rows(out, "id", "sum_v_by_k", "sum_u_by_k") == rows(
        df.select("id", F.sum("v").over(group).alias("a"), F.sum("u").over(group).alias("b"))
    )


@pytest.mark.parametrize("broadcast_bytes, rows_per_task", [(10**8, 10**6), (0, 10**6), (0, 40)])
def test_totals_read_the_rows_once_more_at_most(spark, root, broadcast_bytes, rows_per_task):
    skewed(spark).write.parquet(root + "/rows")
    df = spark.read.parquet(root + "/rows")
    for out in (
        features.group_totals(df, ["v"], "k", broadcast_bytes, rows_per_task),
        features.trailing_totals(df, ["v"], "k", "d", 7, broadcast_bytes, rows_per_task),
    ):
        text = plan(out)
        scans = [line for line in text.splitlines() if "Location" in line and root in line]
        assert len(scans) == 1 and "Union" not in text and "Window" not in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_a_hot_key_is_split(spark):
    df = skewed(spark)
    totals = df.groupBy("k").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
    text = plan(attach(df, totals, ["k"], "n", 0, 50))
    assert "_lookup_splits" in text and "sequence(0" in text
    assert "_lookup_splits" not in plan(attach(df, totals, ["k"], "n", 0, 10**6))
    assert split_above(10**12) == 10**7 and split_above(10) == 4_000_000


def test_size_of_a_lookup_is_measured(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "k string, v int")
    assert measured_bytes(df) == 3 + 4 * 16
    assert measured_bytes(df.limit(0)) == 0
    assert measured_bytes(spark.sql("select array('abcdef', 'ghi') as a")) >= 9 + 16


@pytest.mark.parametrize("days", [1, 7, 30])
@pytest.mark.parametrize("broadcast_bytes", [10**8, 0])
@pytest.mark.parametrize("rows_per_task", [20, 10**6])
def test_trailing_totals_equal_the_window_over_rows(spark, days, broadcast_bytes, rows_per_task):
    df = skewed(spark)
    over = (
        W.partitionBy("k").orderBy(F.unix_date("d")).rangeBetween(-(days - 1), W.currentRow)
    )
    expected = df.select("id", F.sum("v").over(over).alias("s"), F.sum("u").over(over).alias("t"))
    out = features.trailing_totals(df, ["v", "u"], "k", "d", days, broadcast_bytes, rows_per_task)
    names = [f"sum_v_by_k_{days}d", f"sum_u_by_k_{days}d"]
    assert out.columns == [*df.columns, *names]
    assert rows(out, "id", *names) == rows(expected)


def test_minority_boundary(spark):
    df = spark.createDataFrame(
        [("five", 5.0), ("six", 6.0), ("null", None), ("nan", float("nan")), (None, 9.0)],
        "label string, s double",
    )
    out = df.select("label", keep_or_minority("label", "s", 5).alias("out"))
    assert dict(rows(out)) == {
        "five": "minor_segment",
        "six": "six",
        "null": "minor_segment",
        "nan": "minor_segment",
        None: None,
    }


def test_minority_by_total(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 3.0), ("b", 5.0), (None, 99.0)], "k string, v double")
    out = features.relabel_by_total(df, "k", "v", 5, minority="other")
    assert rows(out) == [("a", 3.0, 6.0), ("a", 3.0, 6.0), ("other", 5.0, 5.0)]


def test_dummies_drop_the_first_category(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3), (None, 4)], "c string, i int")
    out, names = features.dummies(df, ["c", "absent"])
    assert names == ["c_b", "c_c"] and out.columns == ["i", "c_b", "c_c"]
    assert rows(out) == [(1, 1, 0), (2, 0, 0), (3, 0, 1), (4, 0, 0)]


def test_dummies_of_a_single_category_leave_nothing(spark):
    out, names = features.dummies(spark.createDataFrame([("a", 1)], "c string, i int"), ["c"])
    assert names == [] and out.columns == ["i"]


def test_dummies_of_numbers_sort_as_numbers(spark):
    df = spark.createDataFrame([(10, 1.5), (9, float("nan")), (100, 0.5)], "n int, x double")
    out, names = features.dummies(df, ["n", "x"])
    assert names == ["n_10", "n_100", "x_1.5"]
    assert rows(out) == [(0, 0, 0), (0, 1, 0), (1, 0, 1)]


def test_known_categories_need_no_pass(spark):
    df = spark.createDataFrame([("b",), ("z",)], "c string")
    out, names = features.dummies(df, ["c"], known={"c": ["a", "b"]})
    assert names == ["c_b"] and rows(out) == [(0,), (1,)]


def test_any_number_of_categories_in_their_own_order(spark):
    df = spark.range(1500).selectExpr("cast(id as string) as c", f"id + {2**53} as big")
    found = features.categories(df, ["c", "big"])
    assert len(found["c"]) == 1500 and found["big"] == [str(2**53 + i) for i in range(1500)]


def test_labels_of_any_type_can_be_minor(spark):
    df = spark.createDataFrame([(1, 9.0), (2, 1.0)], "label bigint, s double")
    assert rows(features.relabel_minority(df, "label", "s", 5, "minor")) == [("1", 9.0), ("minor", 1.0)]


@pytest.mark.parametrize("broadcast_bytes", [10**8, 0])
def test_dummy_vectors_equal_dummies(spark, broadcast_bytes):
    df = spark.range(300).selectExpr("id", "id as place", "if(id % 7 = 0, null, id % 23 * 10) as c")
    wide, names = features.dummies(df, ["c"])
    narrow = features.dummy_vector(df, "c", broadcast_bytes, 5)
    assert narrow.columns == ["id", "place", "c_vec"]
    expected = wide.select("id", "place", F.array(*(F.col(n).cast("double") for n in names)).alias("v"))
    assert rows(narrow.select("id", "place", vector_to_array("c_vec").alias("v"))) == rows(expected)


def test_dummy_vectors_without_categories(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None)], "id int, c double")
    assert rows(features.dummy_vector(df, "c").selectExpr("id", "cast(c_vec as string) as v")) == [
        (1, "(0,[],[])"),
        (2, "(0,[],[])"),
    ]
    one = spark.createDataFrame([(1, "a"), (2, None)], "id int, c string")
    assert {r[0] for r in features.dummy_vector(one, "c").selectExpr("cast(c_vec as string)").collect()} == {
        "(0,[],[])"
    }
    assert features.dummy_vector(df.limit(0), "c").count() == 0


def test_distinct_values_without_expand(spark):
    from helpers import plan

    df = spark.range(3000).selectExpr(
        "cast(id % 7 as int) as few", "if(id % 50 = 0, null, id) as many", "concat('k', id % 900) as k",
        "case id % 4 when 0 then -0.0D when 1 then 0.0D when 2 then double('NaN') else null end as f",
        "date_add(date'2018-01-01', cast(id % 365 as int)) as d",
    )
    expected = {"few": 7, "many": 2941, "k": 900, "f": 3, "d": 365}
    columns = list(expected)
    for most in (10_000, 500, 5, -1):
        found = features.distinct_values(df, columns, most)
        assert found.columns == columns and found.first().asDict() == expected
        assert "Expand" not in plan(found) and "NestedLoop" not in plan(found)
    assert features.distinct_values(df.where("false"), columns).first().asDict() == dict.fromkeys(columns, 0)
    assert features.distinct_values(df.where("false"), columns, -1).first().asDict() == dict.fromkeys(columns, 0)
