"""Dated lookups by sweep, bands that must not overlap, overrides in one join."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.lookups import Override, band_join, override_lookups
from ledgerloom.operators.sweep import FEW, Dated, sweep

DAY = date(2020, 1, 1)


def _periods(rng, keys, longest=40):
    """Periods of each key that never overlap, with gaps, some ending on the day before the next."""
    rows = []
    for k in keys:
        at = DAY + timedelta(rng.randrange(30))
        for _ in range(rng.randrange(6)):
            end = at + timedelta(rng.randrange(longest))
            rows.append((k, at, end, rng.randrange(1000)))
            at = end + timedelta(1 + rng.choice([0, 0, 5]))
    return rows


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_sweep_equals_brute_force(spark, ranges):
    """Two sets of keys, two dates, a constant condition, an open end, NULL keys and dates, repeated rows; any cut into ranges."""
    rng = random.Random(ranges)
    a, b = _periods(rng, ["x", "y", "z"]), _periods(rng, [1])
    a += [("w", DAY + timedelta(3), date(9999, 12, 31), 5), (None, DAY, date(9999, 1, 1), 6), ("x", None, DAY, 7), ("v", DAY, None, 8), ("u", DAY + timedelta(2), DAY, 9)]
    facts = [(i, rng.choice(["x", "x", "x", "y", "w", "v", "u", None]), DAY + timedelta(rng.randrange(160)), DAY + timedelta(rng.randrange(160))) for i in range(400)]
    facts += [(400, "x", None, DAY), (401, "w", date(9999, 12, 31), None), (401, "w", date(9999, 12, 31), None)]
    df = spark.createDataFrame(facts, "id int, k string, d date, e date")
    dim_a = spark.createDataFrame(a, "key string, beg date, end date, v int")
    dim_b = spark.createDataFrame([(r[1], r[2], r[3], "on") for r in b] + [(DAY, date(9999, 1, 1), -1, "off")], "beg date, end date, v int, state string")
    found = sweep(df, [
        Dated(dim_a, {"k": "key"}, "d", {"v": "one"}), Dated(dim_b, {}, "e", {"v": "two"}, constants={"state": "on"}),
        Dated(dim_a, {"k": "key"}, "e", {"v": "three", "key": "four"}), Dated(dim_a.filter("key = 'x'"), {"k": "key"}, "d", {"v": "five"}),
    ], ranges)

    def held(rows, key, at):
        hit = [r for r in rows if key is not None and at is not None and r[0] == key and r[1] and r[2] and r[1] <= at <= r[2]]
        return hit[0] if hit else (None,) * 4

    want = [
        (*f, held(a, f[1], f[2])[3], held([(0, *r[1:]) for r in b], 0, f[3])[3], held(a, f[1], f[3])[3], held(a, f[1], f[3])[0], held([r for r in a if r[0] == "x"], f[1], f[2])[3])
        for f in facts
    ]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("ranges", [1, 7])
def test_sweep_rejects_overlaps(spark, ranges):
    """Same day at a border, same start, one inside another; across ranges too."""
    df = spark.createDataFrame([("x", DAY)], "k string, d date")
    for again in ((DAY + timedelta(9), DAY + timedelta(20)), (DAY, DAY + timedelta(1)), (DAY + timedelta(2), DAY + timedelta(3))):
        dim = spark.createDataFrame([("x", DAY, DAY + timedelta(9), 1), ("x", *again, 2)] + [("y", DAY + timedelta(i), DAY + timedelta(i), i) for i in range(30)], "k string, beg date, end date, v int")
        with pytest.raises(Exception, match="overlapping"):
            sweep(df, [Dated(dim, {"k": "k"}, "d", {"v": "v"})], ranges).collect()


@pytest.mark.parametrize("most", [FEW, 3])
def test_few_periods_give_the_same(spark, monkeypatch, most):
    """Short lookup tables are sent, also beside one that is swept; NULL keys, open ends, a constant, no key at all."""
    monkeypatch.setattr("ledgerloom.operators.sweep.FEW", most)
    rng = random.Random(7)
    periods = _periods(rng, ["x", "y"]) + [("w", DAY, date(9999, 12, 31), 5), (None, DAY, DAY, 6), ("x", None, DAY, 7), ("u", DAY, DAY - timedelta(1), 9)]
    always = [(DAY, DAY + timedelta(9), 1), (DAY + timedelta(20), date(9999, 1, 1), 2)]
    facts = [(i, rng.choice(["x", "y", "w", "u", None]), rng.choice([None, DAY + timedelta(rng.randrange(60))])) for i in range(200)] * 2
    df = spark.createDataFrame(facts, "id int, k string, d date")
    dim, plain = spark.createDataFrame(periods, "key string, beg date, end date, v int"), spark.createDataFrame(always, "beg date, end date, v int")
    lookups = [Dated(dim, {"k": "key"}, "d", {"v": "one", "key": "two"}), Dated(plain, {}, "d", {"v": "three"}), Dated(plain, {}, "d", {"v": "four"}, constants={"v": 9})]

    def held(k, d):
        a = [p for p in periods if k is not None and d and p[0] == k and p[1] and p[1] <= d <= p[2]]
        b = [p for p in always if d and p[0] <= d <= p[1]]
        return (*((a[0][3], k) if a else (None, None)), b[0][2] if b else None, None)

    assert sorted(map(tuple, sweep(df, lookups).collect()), key=str) == sorted([(*f, *held(*f[1:])) for f in facts], key=str)


def test_few_periods_that_overlap_raise(spark):
    df = spark.createDataFrame([("x", DAY)], "k string, d date")
    for key in ("x", "y", None):
        dim = spark.createDataFrame([(key, DAY, DAY + timedelta(9), 1), (key, DAY + timedelta(9), DAY + timedelta(12), 2)], "k string, beg date, end date, v int")
        for on in ({"k": "k"}, {}):
            with pytest.raises(Exception, match="overlapping"):
                sweep(df, [Dated(dim, on, "d", {"v": "v"})]).collect()


def test_rows_are_not_shuffled_for_few_periods(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(DAY).alias("d"))
    dim = spark.createDataFrame([(1, DAY, DAY + timedelta(9), 4)], "k int, beg date, end date, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = sweep(df, [Dated(dim, {"k": "k"}, "d", {"v": "v"}), Dated(dim, {}, "d", {"v": "w"})])
        assert out.agg(F.sum("v"), F.sum("w")).first() == (4, 4000)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "NestedLoopJoin" not in plan


def test_sweep_of_nothing(spark):
    none = spark.createDataFrame([], "k string, d date")
    dim = spark.createDataFrame([("x", DAY, DAY, 1)], "k string, beg date, end date, v int")
    assert sweep(none, [Dated(dim, {"k": "k"}, "d", {"v": "v"})]).collect() == []
    one = spark.createDataFrame([("x", DAY)], "k string, d date")
    assert [tuple(r) for r in sweep(one, [Dated(dim.limit(0), {"k": "k"}, "d", {"v": "v"})]).collect()] == [("x", DAY, None)]


def _grid(rng, n):
    """Boxes of a grid: disjoint, many per key."""
    return [(k, i * 10, i * 10 + 9, f"{j:02d}", f"{j:02d}z", k * 100 + i * 10 + j) for k in range(3) for i in range(n) for j in range(n)]


def test_bands_of_two_axes(spark):
    rng = random.Random(3)
    boxes = _grid(rng, 6)
    dim = spark.createDataFrame(boxes, "k int, lo int, hi int, first string, last string, v int")
    facts = [(i, rng.randrange(4), rng.randrange(70), f"{rng.randrange(8):02d}b") for i in range(300)]
    df = spark.createDataFrame(facts, "id int, k int, x int, y string")
    bands = [("x", "lo", "hi"), ("y", "first", "last")]
    found = band_join(df, dim.withColumnRenamed("k", "key"), {"k": "key"}, bands, {"v": "v"})
    want = [(*f, next((b[5] for b in boxes if b[0] == f[1] and b[1] <= f[2] <= b[2] and b[3] <= f[3] <= b[4]), None)) for f in facts]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_overlapping_bands_raise(spark):
    """By a shared bound, a box inside another, and boxes that meet in both axes; not if they meet in one only."""
    df = spark.createDataFrame([(1, 1, 5, "05b")], "id int, k int, x int, y string")
    schema = "key int, lo int, hi int, first string, last string, v int"
    boxes = _grid(random.Random(4), 4)
    two = [("x", "lo", "hi"), ("y", "first", "last")]
    for extra in ((1, 9, 9, "03", "03", 0), (1, 0, 39, "00", "99", 0), (1, 35, 60, "02b", "02c", 0)):
        dim = spark.createDataFrame([*boxes, extra], schema)
        with pytest.raises(Exception, match="overlapping bands"):
            band_join(df, dim, {"k": "key"}, two, {"v": "v"}).collect()
    fine = spark.createDataFrame([*boxes, (1, 0, 99, "50", "60", 0), (1, None, 5, "00", "99", 0), (None, 0, 99, "00", "99", 0), (None, 0, 99, "00", "99", 0), (1, 9, 0, "00", "99", 0)], schema)
    assert band_join(df, fine, {"k": "key"}, two, {"v": "v"}).count() == 1
    for second, raises in (((1, 10, 12), True), ((1, 11, 12), False), ((1, 2, 3), True), ((2, 5, 6), False)):
        dim = spark.createDataFrame([(1, 1, 10), second], "key int, lo int, hi int")
        joined = band_join(df, dim, {"k": "key"}, [("x", "lo", "hi")], {"lo": "v"})
        if raises:
            with pytest.raises(Exception, match="overlapping bands"):
                joined.collect()
        else:
            assert joined.count() == 1


OVERRIDE = "line string, lookup string, lookup_var string, beg int, end int, min_val string, max_val string, override string"


def test_overrides_in_one_join(spark):
    """Open ends, values of two types, rules of other lines, a text that is no number, NULL bounds."""
    rules = spark.createDataFrame([
        ("lease", "L", "make", 201901, 999912, "4", "6", "77"), ("lease", "L", "make", 199001, 201812, "0", "99", "1"),
        ("loan", "L", "make", 199001, 999912, "0", "99", "2"), ("lease", "L", "age", 202001, 202012, "used1", "used5", "older"),
        ("lease", "L", "bad", 202001, 202012, "a", "b", "7"), ("lease", "L", "open", None, 202012, "0", "99", "5"),
    ], OVERRIDE)
    facts = [(1, 5, "used3", 202001), (2, 7, "new", 202001), (3, 5, "used3", 201812), (4, 5, None, 300001), (5, None, "used1", 202012), (6, 5, "used1", None)]
    df = spark.createDataFrame(facts, "id int, make int, age string, period int").withColumns({"line": F.lit("lease"), "bad": F.lit(3), "open": F.lit(3)})
    wanted = [Override("L", "make", "make", "m"), Override("L", "age", "age", "a"), Override("L", "bad", "bad", "b"), Override("L", "open", "open", "o")]
    got = override_lookups(df, rules, wanted, "period", "line").orderBy("id").select("m", "a", "b", "o").collect()
    assert [tuple(r) for r in got] == [(77, "older", 3, 3), (7, "new", 3, 3), (1, "used3", 3, 3), (77, None, 3, 3), (None, "older", 3, 3), (5, "used1", 3, 3)]


def test_overlapping_overrides_raise(spark):
    df = spark.createDataFrame([(5, 202001, "lease")], "v int, period int, line string")
    rules = spark.createDataFrame([("lease", "L", "V", 201901, 202012, "4", "6", "1"), ("lease", "L", "V", 202001, 999912, "5", "9", "2")], OVERRIDE)
    with pytest.raises(Exception, match="overlapping overrides"):
        override_lookups(df, rules, [Override("L", "V", "v", "o")], "period", "line").collect()


def test_overrides_in_force_are_sent(spark):
    """The pairs come from another table that holds them; the rows are not shuffled by them."""
    df = spark.createDataFrame([(1, "l", 202001, 5), (2, "l", 202007, 5), (3, None, 202001, 5), (4, "l", None, 5)], "id int, line string, period int, v int")
    rules = spark.createDataFrame([("l", "L", "V", 201901, 202003, "1", "9", "70")], "line string, lookup string, lookup_var string, beg int, end int, min_val string, max_val string, override string")
    pairs = df.select("line", "period").union(spark.createDataFrame([("z", 202001)], "line string, period int"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = override_lookups(df, rules, [Override("L", "V", "v", "o")], "period", "line", pairs)
        assert sorted((r["id"], r["o"]) for r in out.collect()) == [(1, 70), (2, 5), (3, 5), (4, 5)]
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
