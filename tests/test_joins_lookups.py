from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins, lookups
from ledgerloom.operators.changes import delete_where, merge_upsert, partial_update


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def null_sides(spark):
    a = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,)], "a int")
    b = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,), (None,)], "b int")
    return a, b


@pytest.mark.parametrize("how, n", [("inner", 9), ("left", 11), ("right", 12), ("left_semi", 3), ("left_anti", 2)])
def test_null_and_duplicate_keys(null_sides, how, n):
    a, b = null_sides
    assert a.join(b, a.a == b.b, how).count() == n


def test_full_outer_as_left_and_anti(null_sides):
    a, b = null_sides
    assert joins.full_outer(a, b, "a", "b").count() == 14
    assert rows(joins.full_outer(a, b, "a", "b")) == rows(a.join(b, a.a == b.b, "full"))


def test_null_matching_join(null_sides):
    a, b = null_sides
    assert a.join(b, joins.null_safe_on(a, b, [("a", "b")])).count() == 15


def test_unique_lookup_raises_on_repeated_key(spark):
    dim = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    facts = spark.createDataFrame([(1,), (2,)], "f int")
    with pytest.raises(Exception, match="not unique"):
        joins.lookup_equi(facts, dim, {"f": "k"}, {"v": "v"}).collect()


def test_either_key_prefers_the_first(spark):
    alias = spark.createDataFrame([("a", 1), ("b", 2)], "w string, id int")
    facts = spark.createDataFrame([("a", "b"), ("z", "b"), ("z", "z"), (None, "a")], "c string, n string")
    got = joins.lookup_by_either(facts, alias, "c", "n", "w", "id", "out")
    assert rows(got) == rows(spark.createDataFrame([("a", "b", 1), ("z", "b", 2), ("z", "z", None), (None, "a", 1)], "c string, n string, o int"))


def test_id_list_does_not_repeat_rows(spark):
    assert joins.by_id_list(spark.range(10), "id", "[3,5,3]").count() == 2


@pytest.fixture(scope="module")
def dated(spark):
    facts = spark.createDataFrame(
        [(1, "x", date(2020, 1, 31)), (2, "x", date(2020, 2, 1)), (3, "y", date(2020, 2, 1)), (4, "x", None), (5, "x", date(2031, 5, 5))],
        "id int, k string, d date",
    )
    dim = spark.createDataFrame(
        [("x", date(2019, 6, 1), date(2020, 1, 31), 10), ("x", date(2020, 2, 1), date(9999, 12, 31), 20)], "k string, beg date, fin date, v int"
    )
    return facts, dim


@pytest.mark.parametrize("months", [None, (2019 * 12, 2040 * 12)])
def test_effective_lookup_bounds_are_inclusive(dated, months):
    facts, dim = dated
    out = lookups.effective_lookup(facts, dim, {"k": "k"}, "d", "beg", "fin", {"v": "v"}, months=months, single=True)
    assert dict((r["id"], r["v"]) for r in out.collect()) == {1: 10, 2: 20, 3: None, 4: None, 5: 20}


def test_range_lookup_plans_no_nested_loop(dated):
    facts, dim = dated
    out = lookups.effective_lookup(facts, dim, {}, "d", "beg", "fin", {"v": "v"}, months=lookups.months_spanned(facts, ["d"]))
    assert "NestedLoop" not in out._jdf.queryExecution().toString()
    assert out.count() == 5


def test_overlapping_periods_raise(spark, dated):
    facts, dim = dated
    doubled = dim.union(spark.createDataFrame([("x", date(2020, 1, 31), date(2020, 2, 2), 30)], dim.schema))
    with pytest.raises(Exception, match="overlapping"):
        lookups.effective_lookup(facts, doubled, {"k": "k"}, "d", "beg", "fin", {"v": "v"}, single=True).collect()


def test_override_falls_back_to_own_value(spark):
    facts = spark.createDataFrame([(5, 202001), (9, 202001), (5, 202301)], "v int, period int").withColumn("line", F.lit("lease"))
    over = spark.createDataFrame(
        [("lease", "L", "V", 201901, 202112, 4, 6, 77)],
        "line string, lookup string, lookup_var string, beg int, end int, min_val int, max_val int, override int",
    )
    got = lookups.override_lookup(facts, over, "L", "V", "v", "period", "line", "o")
    assert sorted((r["v"], r["period"], r["o"]) for r in got.collect()) == [(5, 202001, 77), (5, 202301, 5), (9, 202001, 9)]


def test_merge_updates_inserts_and_rejects_doubles(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, n string, v int")
    source = spark.createDataFrame([(2, None), (3, 30)], "k int, v int")
    assert rows(merge_upsert(target, source, ["k"])) == rows(
        spark.createDataFrame([(1, "a", 10), (2, "b", None), (3, None, 30)], target.schema)
    )
    with pytest.raises(Exception, match="not unique"):
        merge_upsert(target, source.union(source), ["k"]).collect()


def test_delete_keeps_unknown_rows(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert rows(delete_where(df, F.col("v") > 2)) == rows(spark.createDataFrame([(1,), (None,)], "v int"))


def test_partial_update_keeps_null_arguments(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, n string, t string")
    out = partial_update(df, F.col("k") == 1, {"n": "c", "t": None}, overwrite=["t"])
    assert sorted(map(tuple, out.collect())) == [(1, "c", None), (2, "b", "y")]
    assert rows(partial_update(df, F.col("k") == 1, {"n": None, "t": None}, overwrite=["t"])) == rows(df)


def test_merge_with_hot_and_null_target_keys(spark):
    target = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 3), (2, "d", 4)], "k int, n string, extra int")
    source = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k int, n string")
    out = merge_upsert(target, source, ["k"])
    assert rows(out) == rows(spark.createDataFrame(
        [(1, "x", 1), (1, "x", 2), (None, "c", 3), (2, "d", 4), (3, "y", None), (None, "z", None)], "k int, n string, extra int"))
    assert "FullOuter" not in out._jdf.queryExecution().executedPlan().toString()
