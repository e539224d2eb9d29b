"""Ordered operators against plain windows, with one key holding a third of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.nesting import children_as_json
from ledgerloom.operators.ordered import RANGE, ordered_dense_rank, ordered_lead, ordered_row_number, place_in_order


@pytest.fixture(scope="module")
def skewed(spark):
    ids = spark.range(600)
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 17 + 2)
    value = F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") * 37) % 101)
    return ids.select("id", key.cast("int").alias("k"), value.cast("int").alias("v"), ((F.col("id") * 13) % 40).cast("int").alias("at"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_hot_key_is_spread_over_ranges(skewed):
    placed = place_in_order(skewed, ["k", "at", "id"], ranges=12)
    assert placed.filter("k = 1").select(RANGE).distinct().count() > 2


@pytest.mark.parametrize("keys", [["k"], []])
def test_row_number(skewed, keys):
    w = Window.partitionBy(*keys).orderBy("at", "id")
    want = skewed.withColumn("rn", F.row_number().over(w).cast("bigint"))
    assert rows(ordered_row_number(skewed, keys, ["at", "id"], "rn", ranges=12)) == rows(want)


@pytest.mark.parametrize("keys", [["k"], []])
def test_lead_tells_null_from_missing(skewed, keys):
    w = Window.partitionBy(*keys).orderBy("at", "id")
    want = skewed.withColumn("nxt", F.lead("v", 1, -5).over(w))
    assert rows(ordered_lead(skewed, keys, ["at", "id"], "v", "nxt", F.lit(-5), ranges=12)) == rows(want)


def test_dense_rank_with_ties_and_nulls(skewed):
    want = skewed.withColumn("rk", F.dense_rank().over(Window.partitionBy("k").orderBy("v")).cast("bigint"))
    assert rows(ordered_dense_rank(skewed, ["k"], "v", "rk", ranges=12)) == rows(want)


def test_empty_input(skewed):
    assert ordered_row_number(skewed.filter("id < 0"), ["k"], ["at", "id"]).count() == 0
    assert ordered_lead(skewed.filter("id < 0"), [], ["at", "id"], "v", "nxt").count() == 0


def test_children_are_paged_and_complete(spark, skewed):
    pages = children_as_json(skewed.filter("k is not null"), "k", ["at", "id"], ["id"], page=50)
    sizes = pages.select("k", "page_no", F.size(F.from_json("items", "array<struct<id:bigint>>")).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] == 50
    assert sizes.filter("k = 1").agg(F.sum("n")).first()[0] == 200
