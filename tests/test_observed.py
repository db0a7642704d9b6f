"""Metrics that are counted while rows are written."""

from helpers import rows
from pyspark.sql import functions as F

from stridecast.config import FeatureSpec, ForestParams
from stridecast.operators.reports import Seen, prediction_metrics
from stridecast.plans import predict as module
from stridecast.plans.predict import predict, rows_to_score
from stridecast.plans.train import train

SPEC = FeatureSpec("t", "d", ("id",), (("x",), ("x", "y")), ((), ()), ("z",), ())
STARTS = (0, 20)


def test_checks_do_not_read_the_data_again(spark, root, monkeypatch):
    spark.range(4000).selectExpr(
        "id", "date_add(date'2018-01-01', cast(id % 300 as int)) as d", "cast(id % 5 as double) as x",
        "if(id % 9 = 0, null, 1.0D) as y", "0.5D as z_sin", "0.5D as z_cos", "cast(id % 5 as double) as t",
    ).write.parquet(root + "/data")
    data = spark.read.parquet(root + "/data")
    models = train(data, SPEC, "2018-06-01", ForestParams(num_trees=2, max_depth=2)).models
    monkeypatch.setattr(module, "rows_to_score", None)
    out = predict(data, SPEC, "2018-06-01", models=models, root=root, keys=["d"], checks=True, starts=STARTS, months_ahead=2)
    monkeypatch.undo()
    tests = rows_to_score(data, SPEC, "2018-06-01", STARTS, 2)
    assert rows(out.metrics) == rows(prediction_metrics(out.results, tests, ["d"], "d"))
    assert out.metrics.first().test_basic_set_count > 0
    plain = predict(data, SPEC, "2018-06-01", models=models, keys=["d"], checks=True, starts=STARTS, months_ahead=2)
    assert rows(plain.metrics) == rows(out.metrics)


def test_nothing_seen(spark):
    seen = Seen()
    none = spark.range(0).selectExpr("id", "current_date() as d")
    seen.scored(seen.tests(none, F.lit(True)), "d").write.format("noop").mode("overwrite").save()
    assert tuple(seen.metrics(none, ["id"]).first()) == (0, 0, 0, 0, None, None)
