import hashlib

import pytest
from helpers import rows

from stridecast.config import BASIC, FULL, FeatureSpec
from stridecast.functions.sampling import sampling_hash
from stridecast.operators import split
from stridecast.sources.shared import written

SPEC = FeatureSpec(
    target="t",
    date="d",
    ids=("id",),
    features=(("a", "b"), ("a",)),
    basic_features=(("c",), ()),
    cyclical=("m",),
    categorical=("k",),
)


@pytest.fixture
def numbered(spark):
    return spark.range(5000).selectExpr(
        "id", "date_add(date'2018-01-01', cast(id % 400 as int)) as d", "cast(id as double) as t"
    )


def digest(key, seed=23):
    return hashlib.md5(f"{key}#{seed}".encode()).hexdigest()


def test_training_ends_the_day_before_the_split(numbered):
    got = split.train_rows(numbered, "d", "2018-06-01").agg({"d": "max"}).first()[0]
    assert got.isoformat() == "2018-05-31"


def test_train_and_test_rows_in_one_pass(numbered):
    out = split.train_test(numbered, "d", "2018-06-01")
    train, test = out.where("role = 'train'"), out.where("role = 'test'")
    assert train.where("fold is not null").count() == 0
    assert test.where("fold is null").count() == 0
    assert train.count() == split.train_rows(numbered, "d", "2018-06-01").count()
    spans = [r[0].isoformat() for r in test.selectExpr("min(d)").collect()]
    assert spans == ["2018-06-01"]


def test_split_of_frames_that_differ_by_fold(numbered):
    frames = [numbered, numbered.drop("t"), numbered]
    cuts = split.train_filters("d", "2018-06-01")[:3]
    days = split.fold_filters("d", "2018-06-01")[:3]
    train, test = split.split_frames(frames, cuts, days)
    assert [f.columns for f in train] == [f.columns for f in frames]
    assert {f.count() for f in train} == {split.train_rows(numbered, "d", "2018-06-01").count()}
    counted = split.train_test(numbered, "d", "2018-06-01").groupBy("fold").count().collect()
    by_fold = {r.fold: r["count"] for r in counted}
    assert [f.count() for f in test] == [by_fold[i] for i in range(3)]


def test_own_filters_per_fold(numbered):
    cuts = [numbered.id < 10, numbered.id < 100]
    days = [numbered.id == 10, numbered.id >= 4000]
    train, test = split.split_frames([numbered, numbered], cuts, days, 0.5, ["id"])
    assert [f.count() for f in test] == [1, 1000]
    chosen = [sum(digest(i)[:8] < "80000000" for i in range(n)) for n in (10, 100)]
    assert [f.count() for f in train] == chosen
    with pytest.raises(ValueError):
        split.split_test([numbered], days)


def test_bernoulli_sample_uses_the_fixed_seed(numbered):
    got = split.sample_training(numbered, 0.3)
    assert rows(got) == rows(numbered.sample(False, 0.3, 23))


def test_hash_sample_does_not_depend_on_partitioning(numbered):
    expected = sorted(i for i in range(5000) if digest(i)[:8] < "4ccccccc")
    for df in (numbered, numbered.repartition(7), numbered.coalesce(1)):
        got = split.sample_training(df, 0.3, ["id"])
        assert sorted(r.id for r in got.collect()) == expected
    assert split.sample_fraction(numbered, ["id"], 1.0).count() == 5000
    assert split.sample_fraction(numbered, ["id"], 0.0).count() == 0
    with pytest.raises(ValueError):
        split.sample_fraction(numbered, ["id"], 1.5)


@pytest.mark.parametrize("n", [2, 17, 1234, 4999, 5000, 9999])
def test_count_sample_takes_the_first_keys_by_hash(numbered, n):
    expected = sorted(sorted(range(5000), key=digest)[:n])
    got = split.sample_training(numbered.repartition(5), n, ["id"])
    assert sorted(r.id for r in got.collect()) == expected


def test_count_sample_of_repeated_keys_has_n_rows(spark):
    df = spark.range(90).selectExpr("if(id < 30, 0, id) as id")
    order = sorted([0] * 30 + list(range(30, 90)), key=digest)
    for n in (1, 10, 40, 80):
        assert sorted(r.id for r in split.sample_count(df, ["id"], n).collect()) == sorted(order[:n])


def test_several_keys_are_told_apart(spark):
    df = spark.createDataFrame([("a#b", "c"), ("a", "b#c"), (None, "x"), ("", "x")], "k string, l string")
    assert df.select(sampling_hash(["k", "l"]).alias("h")).distinct().count() == 4


def test_nan_is_lacking(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    full, lacking = split.route_nulls(df, ["x"])
    assert (full.count(), lacking.count()) == (1, 2)


def test_count_sample_needs_keys(numbered):
    with pytest.raises(ValueError):
        split.sample_training(numbered, 100)


def test_sample_by_several_columns_with_nulls(spark):
    df = spark.sql("select if(id % 3 = 0, null, id) as a, cast(id as string) as b from range(100)")
    assert split.sample_count(df, ["a", "b"], 40).count() == 40


def test_rows_that_lack_a_feature_are_routed_once(spark):
    df = spark.sql("select * from values (1, 1.0, 2.0), (2, null, 2.0), (3, 1.0, null) t(id, a, b)")
    full, basic = split.route_nulls(df, ["a", "b"])
    assert rows(full, "id") == [(1,)]
    assert rows(basic, "id") == [(2,), (3,)]
    assert rows(split.flag_basic(df, ["a"]), "id", "is_basic") == [
        (1, False),
        (2, True),
        (3, False),
    ]
    everything, none = split.route_nulls(df, [])
    assert everything.count() == 3 and none.count() == 0


def test_projection_of_a_fold(spark):
    df = spark.sql(
        "select 1 as id, date'2018-01-01' as d, 5.0 as t, 1.0 as a, 2.0 as b, 3.0 as c, "
        "'x' as k, 0.1 as m_sin, 0.2 as m_cos, 'unused' as z"
    )
    waves = ["m_sin", "m_cos", "k"]
    assert split.project_fold(df, SPEC, 0).columns == ["id", "d", "t", "a", "b", *waves]
    assert split.project_fold(df, SPEC, 0, BASIC).columns == ["id", "d", "t", "c", *waves]
    assert split.project_fold(df, SPEC, 1, FULL, with_target=False).columns == ["id", "d", "a", *waves]


def test_spec_checks_and_names():
    assert SPEC.prediction == "t_pred"
    assert SPEC.inputs() == ["a", "b", "m_sin", "m_cos", "c", "k"]
    with pytest.raises(ValueError):
        FeatureSpec(target="t", date="d", ids=("id",), features=((), ()), basic_features=((),))


def test_one_pass_split_equals_the_frames(spark):
    df = spark.range(900).selectExpr("id", "date_add(date'2018-01-01', cast(id % 300 as int)) as d")
    split_day, starts = "2018-05-01", (0, 8, 15)
    frames = [df for _ in starts]
    train_parts, test_parts = split.split_frames(
        frames,
        split.train_filters("d", split_day, starts),
        split.fold_filters("d", split_day, starts),
        0.5,
        ["id"],
    )
    once = split.sampled_train_test(df, "d", split_day, 0.5, ["id"], starts)
    for part in train_parts:
        assert rows(once.where("role = 'train'"), "id") == rows(part, "id")
    for i, part in enumerate(test_parts):
        assert rows(once.where(f"fold = {i}"), "id") == rows(part, "id")


def test_variant_in_one_pass(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "id int, x double")
    assert rows(split.with_variant(df, ["x"]), "id", "variant") == [(1, "full"), (2, "basic"), (3, "basic")]


@pytest.mark.parametrize("n", [2, 100, 1999, 2000, 2001, 2999, 3000, 3001])
def test_sample_count_reads_the_keys_twice(spark, n, monkeypatch):
    """Exact for unique keys, a hot key and nulls; all but the first count is made on a table."""
    from stridecast.operators import split as module

    tables = []
    monkeypatch.setattr(module, "written", lambda df, name: tables.append(write(df, name)) or tables[-1])
    write = written
    df = spark.range(3000).selectExpr("if(id < 1000, 7, if(id % 100 = 0, null, id)) as k", "id")
    found = module.sample_count(df, ["k"], n)
    kept = [(r.k, r.id) for r in found.collect()]
    assert len(kept) == min(n, 3000) == len(set(kept))
    ranked = df.select("k", "id", sampling_hash(["k"]).alias("h")).collect()
    last = sorted(r.h for r in ranked)[min(n, 3000) - 1]
    assert {r.id for r in ranked if r.h < last} <= {i for _, i in kept} <= {r.id for r in ranked if r.h <= last}
    assert len(tables) == (n <= 3000) and all(t.count() <= 10 for t in tables)
