"""Joins whose keys are very unequal."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from inkrank.operators.skew import deal, grid_join, hot_keys, in_grids, lookup


@pytest.fixture(scope="module")
def left(spark):
    keys = ["hot"] * 600 + ["warm"] * 300 + [f"k{i % 200}" for i in range(900)]
    rows = [(key, i) for i, key in enumerate(keys)]
    return spark.createDataFrame(rows, "key STRING, l INT")


@pytest.fixture(scope="module")
def right(spark):
    keys = ["hot"] * 30 + ["only-right"] * 30 + [f"k{i}" for i in range(0, 300, 3)]
    return spark.createDataFrame([(key, i) for i, key in enumerate(keys)], "key STRING, r INT")


def counted(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.mark.parametrize("width", [1, 4, 50])
def test_grid_join_equals_join(left, right, width):
    found = grid_join(left, right, "key", "l", "r", width, cell_pairs=50).select("key", "l", "r")
    assert counted(found) == counted(left.join(right, "key").select("key", "l", "r"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("width", [1, 4, 50])
def test_lookup_equals_join(left, right, how, width):
    table = right.groupBy("key").agg(F.max("r").alias("m"))
    found = lookup(left, table, "key", "l", how, width=width, cell_rows=10).select("key", "l", "m")
    assert counted(found) == counted(left.join(table, "key", how).select("key", "l", "m"))


@pytest.mark.parametrize("width", [1, 2, 4, 8, 50])
def test_fewer_hot_keys_than_tasks(left, width):
    sizes = left.groupBy("key").agg(F.count("*").alias("n"))
    assert hot_keys(sizes, "key", "n", width, 1).count() < max(width, 2)


def test_hot_rows_are_dealt_out(left):
    sizes = left.groupBy("key").agg(F.count("*").alias("n"))
    dealt = deal(left, "key", "l", hot_keys(sizes, "key", "n", 9, 100))
    cells = dealt.groupBy("key", "cell").count().collect()
    hot = [row["count"] for row in cells if row.key == "hot"]
    assert len(hot) == 3 and sum(hot) == 600 and max(hot) < 300
    assert all(row.cell == 0 for row in cells if row.key.startswith("k"))


def test_null_and_empty_keys(spark):
    left = spark.createDataFrame([("", 1), (None, 2)], "key STRING, l INT")
    right = spark.createDataFrame([("", 1), (None, 2)], "key STRING, r INT")
    assert counted(grid_join(left, right, "key", "l", "r").select("key", "l", "r")) == {("", 1, 1): 1}
    assert lookup(left, right, "key", "l", "left").count() == 2


def test_empty_sides(spark, left):
    empty = spark.createDataFrame([], "key STRING, r INT")
    assert grid_join(left, empty, "key", "l", "r").count() == 0
    assert lookup(left, empty, "key", "l", "left").count() == 1800


def test_copies_stay_few_whatever_the_partitions(spark):
    rank = F.floor(F.exp(F.rand(3) * 7.6)).cast("int")
    left = spark.range(400_000).select(rank.alias("key"), F.col("id").alias("l")).cache()
    right = spark.range(4_000).select(F.floor(F.exp(F.rand(4) * 7.6)).cast("int").alias("key"), F.col("id").alias("r")).cache()
    for width in (8, 200, 2_000, 80_000):
        dealt = in_grids(left, right, "key", "l", "r", width)
        assert dealt[0].count() + dealt[1].count() < 2 * 404_000
    assert hot_keys(left.groupBy("key").agg(F.count("*").alias("n")), "key", "n", 8_000).count() < 20
    left.unpersist()
    right.unpersist()


def test_a_grid_cuts_the_larger_side(spark):
    left = spark.range(20_000).select(F.lit(1).alias("key"), F.col("id").alias("l"))
    right = spark.range(100).select(F.lit(1).alias("key"), F.col("id").alias("r"))
    dealt = in_grids(left, right, "key", "l", "r", 40, cell_pairs=50_000)
    assert dealt[0].count() == 20_000 and dealt[1].count() == 4_000
    sizes = [row["count"] for row in dealt[0].groupBy("_rows", "_columns").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 700
