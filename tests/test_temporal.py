from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import temporal


def changes(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    data = [
        (1, "a", at(1), 1, False), (2, "a", at(3), 2, False), (3, "a", at(3), 3, False), (4, "b", at(2), 1, False),
        (5, "b", at(5), 9, True), (6, "c", at(4), 7, False),
    ]
    return spark.createDataFrame(data, "event_id long, k string, at timestamp_ntz, v int, gone boolean")


def history(spark):
    return temporal.build_history(changes(spark), ["k"], "at", "event_id", deleted=F.col("gone"))


def test_periods_tile_without_overlap(spark):
    h = history(spark)
    w = Window.partitionBy("k").orderBy("valid_from")
    gaps = h.withColumn("nxt", F.lead("valid_from").over(w)).filter("nxt is not null and nxt <> valid_to")
    assert gaps.count() == 0
    # The first of two changes at the same instant lasted no time.
    assert sorted(r["event_id"] for r in h.collect()) == [1, 3, 4, 6]


def test_as_of_is_half_open(spark):
    h = history(spark)
    state = lambda t: sorted((r["k"], r["v"]) for r in temporal.as_of(h, t).collect())
    assert state("2024-01-01 02:59:59") == [("a", 1), ("b", 1)]
    assert state("2024-01-01 03:00:00") == [("a", 3), ("b", 1)]
    assert state("2024-01-01 05:00:00") == [("a", 3), ("c", 7)]
    assert state(None) == [("a", 3), ("c", 7)]


def test_between_and_contained(spark):
    h = history(spark)
    ids = lambda df: sorted(r["event_id"] for r in df.collect())
    assert ids(temporal.between(h, "2024-01-01 03:00:00", "2024-01-01 04:00:00")) == [3, 4, 6]
    assert ids(temporal.contained_in(h, "2024-01-01 01:00:00", "2024-01-01 05:00:00")) == [1, 4]


def test_recover_and_diff(spark):
    h = history(spark)
    assert [tuple(r) for r in temporal.recover_deleted(h, ["k"], ["k", "v"]).collect()] == [("b", 1)]
    assert sorted(map(tuple, temporal.changed_since(h, "2024-01-01 03:30:00", ["k", "v"]).collect())) == [("c", 7)]


def test_increment_equals_rebuild(spark):
    log = changes(spark).filter("not gone")
    first = temporal.build_history(log.filter("event_id in (1, 4, 6)"), ["k"], "at", "event_id")
    step = temporal.apply_changes(first, log.filter("event_id = 3"), ["k"], "at")
    whole = temporal.build_history(log.filter("event_id <> 2"), ["k"], "at", "event_id")
    pick = lambda df: sorted((r["k"], r["v"], str(r["valid_from"]), str(r["valid_to"])) for r in df.collect())
    assert pick(step) == pick(whole)


def test_increment_with_a_repeated_key_raises(spark):
    log = changes(spark).filter("not gone")
    first = temporal.build_history(log.filter("event_id = 1"), ["k"], "at", "event_id")
    with pytest.raises(Exception, match="not unique"):
        temporal.apply_changes(first, log.filter("event_id in (2, 3)"), ["k"], "at").collect()


def test_increment_with_deletes_and_late_changes(spark):
    h = history(spark)
    at = lambda hour: datetime(2024, 1, 2, hour)
    batch = spark.createDataFrame([(7, "a", at(1), 5, False), (8, "c", at(2), 0, True)], "event_id long, k string, at timestamp_ntz, v int, gone boolean")
    out = temporal.apply_changes(h, batch, ["k"], "at", deleted=F.col("gone"))
    assert [(r.k, r.v) for r in temporal.as_of(out, None).orderBy("k").collect()] == [("a", 5)]
    assert {r.valid_to for r in out.filter("k = 'c'").collect()} == {at(2)}
    late = spark.createDataFrame([(9, "a", datetime(2023, 1, 1), 5, False)], batch.schema)
    with pytest.raises(Exception, match="not later than the open version"):
        temporal.apply_changes(h, late, ["k"], "at").collect()
