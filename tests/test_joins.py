import pytest

from tests.conftest import rows
from wicketflow.operators import joins


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [("hot", i) for i in range(60)] + [("a", 100), ("b", 101), (None, 102)], "k string, v bigint")


@pytest.fixture
def dims(spark):
    return spark.createDataFrame([("hot", "H"), ("a", "A"), ("z", "Z")], "k string, name string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_all_join_paths_agree(facts, dims, how):
    right = dims.select("k") if how in ("left_semi", "left_anti") else dims
    plain = rows(facts.join(right, "k", how))
    for path in (joins.lookup_join(facts, right, "k", how, small=True),
                 joins.lookup_join(facts, right, "k", how, small=False),
                 joins.lookup_join(facts, right, "k", how, small=False, salts=5),
                 joins.lookup_join(facts, right, "k", how)):
        assert rows(path, *facts.join(right, "k", how).columns) == plain


def test_broadcast_only_after_the_size_is_known(facts, dims):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(joins.lookup_join(facts, dims, "k"))
    assert "strategy=broadcast" not in plan(joins.lookup_join(facts, dims, "k", small=False))
    assert joins.fits_broadcast(dims, 3) and not joins.fits_broadcast(dims, 2)


def test_hot_keys_are_measured_and_spread_by_their_share(spark):
    facts = spark.range(10_000, numPartitions=7).selectExpr(
        "case when id % 10 < 4 then 'hot' when id % 10 = 4 then null"
        " else concat('k', id % 3000) end as k", "id as v")
    hot, nulls = joins.hot_keys(facts, "k", 20)
    assert list(hot.values()) == [8] and nulls == 2
    dims = facts.select("k").distinct().selectExpr("k", "upper(k) as name")
    got = joins.spread_join(facts, dims, "k", tasks=20)
    assert rows(got, "k", "v", "name") == rows(facts.join(dims, "k", "left"), "k", "v", "name")
    spread = joins.spread_join(facts.where("k = 'hot'").repartition(3), dims, "k", tasks=20)
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_salt" not in spread.columns
    even = joins.hot_keys(facts.where("k <> 'hot'"), "k", 20)
    assert even == ({}, 1)


def test_two_keys_empty_facts_and_other_joins(spark):
    facts = spark.createDataFrame([(1, "x", i) for i in range(50)] + [(2, None, 99), (2, "y", 100)],
                                  "a bigint, b string, v bigint")
    dims = spark.createDataFrame([(1, "x", 7), (2, "y", 8), (2, None, 9)],
                                 "a bigint, b string, n bigint")
    for how in ("left", "inner", "left_semi", "left_anti"):
        got = joins.spread_join(facts, dims, ["a", "b"], how, tasks=6)
        assert rows(got) == rows(facts.join(dims, ["a", "b"], how))
    assert joins.spread_join(facts.limit(0), dims, ["a", "b"]).count() == 0
    with pytest.raises(ValueError, match="right"):
        joins.spread_join(facts, dims, ["a", "b"], "right")


def test_null_keys_meet(spark):
    left = spark.createDataFrame([(1, None, 5), (2, "x", 6)], "m bigint, c string, v bigint")
    right = spark.createDataFrame([(1, None, 7), (2, "y", 8)], "m bigint, c string, p bigint")
    assert rows(joins.null_safe_join(left, right, ["m", "c"])) == [
        (1, None, 5, 7), (2, "x", 6, None)]


def test_combined_predictions(spark):
    base = spark.createDataFrame([(1, None), (2, 8.0)], "m bigint, c double")
    a = spark.createDataFrame([(1, None, 3.0), (2, 8.0, 4.0)], "m bigint, c double, pred_points double")
    b = a.filter("m = 2")
    got = joins.combine_predictions(base, {"a": a, "b": b}, ["m", "c"])
    assert got.columns == ["m", "c", "pred_points_a", "pred_points_b"]
    assert rows(got) == [(1, None, 3.0, None), (2, 8.0, 4.0, 4.0)]


@pytest.mark.parametrize("small", [True, False])
def test_keep_new_and_known(spark, small, monkeypatch):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, max_rows=0: small)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "m bigint, x string")
    master = spark.createDataFrame([(1, 0), (1, 1), (3, 0)], "m bigint, y bigint")
    assert rows(joins.keep_new(df, master, "m")) == [(2, "b"), (2, "c")]
    assert rows(joins.keep_known(df, master, "m")) == [(1, "a"), (3, "d")]


@pytest.mark.parametrize("small", [True, False])
def test_name_lookup_first_mapping_wins(spark, small, monkeypatch):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, max_rows=0: small)
    names = spark.createDataFrame([(2, "A", "late"), (1, "A", "first"), (3, "T", "B")],
                                  "row_no bigint, feed_name string, master_name string")
    df = spark.createDataFrame([("A", "T"), ("B", None), ("first", "A")], "x string, y string")
    got = joins.lookup_name(df, names, ["x", "y"], order="row_no")
    # B occurs only as a target, so it keeps its own value.
    assert rows(got, "x", "y") == [("B", None), ("first", "B"), ("first", "first")]
    assert rows(joins.map_names_inner(df.select("x"), names, "x")) == [("first",), ("late",)]


def test_appends(spark):
    a = spark.createDataFrame([(1, "x", 2.0)], "m bigint, n string, only_a double")
    b = spark.createDataFrame([("y", 2, True)], "n string, m bigint, only_b boolean")
    assert rows(joins.append_common(a, b)) == [(1, "x"), (2, "y")]
    assert rows(joins.append_outer(a, b), "m", "only_a", "only_b") == [
        (1, 2.0, None), (2, None, True)]


def test_first_and_last_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, "y")],
                               "k string, n bigint, s string")
    assert rows(joins.first_per_key(df, ["k"], [df["n"]])) == [("a", 1, "x"), ("b", 2, "y")]
    assert rows(joins.last_row(df, ["k"], "n")) == [("a", 3, "z"), ("b", 2, "y")]
