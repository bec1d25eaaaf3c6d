"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkrank.operators.skew import lookup
from inkrank.session import scratch_path, settle


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the least.

    In each round every node hands its larger neighbours, then its smaller ones,
    to the least node it knows, until the table of links no longer changes: some
    log(nodes) rounds, each of which never has more links than the first. Rounds
    are written to the shared folder. Hubs are joined in cells.
    """
    spark = links.sparkSession
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = settle(ends.distinct(), scratch_path(spark, "links"))
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
        mark = tuple(state.first())
        if mark == before or not mark[0]:
            break
        before = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        larger = lookup(both.where("b > a"), least, "a", "b").where("b > m")
        large = larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = settle(large, scratch_path(spark, "links"))
        # Here a > b. Each a hands its smaller neighbours to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        smaller = lookup(large, least, "a", "b")
        moved = smaller.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        now = settle(moved.unionByName(own).distinct(), scratch_path(spark, "links"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
