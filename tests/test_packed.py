"""Links packed as differences: round trip, bounded rows, size, ranking."""

import random

import pytest
from pyspark.sql import functions as F

import inkrank as ink
from __spark_entry__ import own_queries
from inkrank.operators import saved_rank
from inkrank.operators.graph import PACK_LINKS
from inkrank.operators.skew import hot_keys
from test_graph import WIKI, frame
from test_rank import STEPS, expected_ranks, ranks_of
from test_saved_rank import drawn

LINKS = "src bigint, dst bigint, n bigint"


def packed_and_back(spark, rows, **options):
    packed = ink.pack_links(spark.createDataFrame(rows, LINKS), **options)
    return packed.collect(), sorted(tuple(row) for row in ink.unpack_links(packed).collect())


def test_rows_by_hand(spark):
    packed, back = packed_and_back(spark, [(1, 9, 2), (1, 3, 1), (1, 4, 5), (2, 0, 1)])
    assert sorted((r.src, r.first, list(r.gaps), list(r.times)) for r in packed) == [(1, 3, [1, 5], [1, 5, 2]), (2, 0, [], [1])]
    assert back == [(1, 3, 1), (1, 4, 5), (1, 9, 2), (2, 0, 1)]


@pytest.mark.parametrize("size", [1, PACK_LINKS - 1, PACK_LINKS, PACK_LINKS + 1, 3 * PACK_LINKS])
def test_list_lengths_around_a_row(spark, size):
    rows = [(7, 3 * i, i % 3 + 1) for i in range(size)]
    packed, back = packed_and_back(spark, rows)
    assert back == rows
    assert len(packed) == -(-size // PACK_LINKS)
    assert max(len(row.times) for row in packed) <= PACK_LINKS


def test_numbers_far_apart(spark):
    """Numbers of nodes carry their partition in the upper bits."""
    rng = random.Random(1)
    targets = sorted({(part << 33) + rng.randrange(1 << 33) for part in range(100) for _ in range(3)} | {0, (1 << 63) - 1})
    rows = [(1 << 40, dst, 1) for dst in targets]
    assert packed_and_back(spark, rows)[1] == rows


def test_a_hub_is_sorted_in_blocks_and_whole(spark):
    rows = sorted([(0, i, 1 + i % 2) for i in range(3000)] + [(i, 0, 1) for i in range(1, 1500)])
    packed, back = packed_and_back(spark, rows, links_per_row=500)
    assert back == rows
    assert max(len(row.times) for row in packed) <= PACK_LINKS


def test_nothing_and_further_columns(spark):
    assert packed_and_back(spark, []) == ([], [])
    packed = ink.pack_links(spark.createDataFrame([(1, 2, 3), (1, 5, 1)], LINKS)).withColumn("share", F.lit(0.5))
    assert sorted(tuple(row) for row in ink.unpack_links(packed).collect()) == [(1, 0.5, 2, 3), (1, 0.5, 5, 1)]


def bytes_in(folder):
    return sum(file.stat().st_size for file in folder.rglob("*.parquet"))


def test_packed_links_are_smaller(spark, tmp_path):
    ids = spark.range(200_000)
    links = ids.select(
        (F.col("id") % 1000).alias("src"), F.pmod(F.xxhash64("id"), F.lit(50_000)).alias("dst"), F.lit(1).cast("bigint").alias("n")
    ).distinct()
    ordered = links.repartition(2, "src").sortWithinPartitions("src", "dst")
    ordered.write.parquet(str(tmp_path / "flat"))
    ink.pack_links(links).repartition(2, "src").sortWithinPartitions("src", "first").write.parquet(str(tmp_path / "packed"))
    assert bytes_in(tmp_path / "packed") < 0.7 * bytes_in(tmp_path / "flat")


@pytest.mark.parametrize("steps", STEPS)
def test_ranks_of_a_packed_graph(spark, tmp_path, steps):
    wiki, graph = frame(spark, WIKI), str(tmp_path / "graph")
    ink.write_graph(ink.extract_links(wiki), ink.count_pages(wiki), graph, packed=True)
    assert "gaps" in spark.read.parquet(f"{graph}/links").columns
    assert ranks_of(ink.rank_saved(spark, graph, str(tmp_path / "w"), steps)) == pytest.approx(STEPS[steps], abs=1e-12)


def test_hot_sources_stay_flat(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hot_keys, "__defaults__", (None, 5))
    edges, path = drawn(3, 300), str(tmp_path / "graph")
    ink.write_graph(spark.createDataFrame(edges, "src string, dst string"), 41, path, packed=True)
    assert spark.read.parquet(f"{path}/hot-links").count() >= 40
    found = ranks_of(ink.rank_saved(spark, path, str(tmp_path / "w"), 5))
    assert found == pytest.approx(expected_ranks(edges, 41, 5), abs=1e-12)


def test_empty_packed_graph(spark, tmp_path):
    path = str(tmp_path / "graph")
    ink.write_graph(spark.createDataFrame([], "src string, dst string"), 0, path, packed=True)
    assert ink.rank_saved(spark, path, str(tmp_path / "w")).collect() == []


def test_a_step_joins_rows_and_shuffles_sums(spark, tmp_path, plan):
    path = str(tmp_path / "graph")
    ink.write_graph(spark.createDataFrame(drawn(4, 0), "src string, dst string"), 40, path, packed=True)
    buckets = ink.graph_note(spark, path)["buckets"]
    own = saved_rank._bucket_session(spark, buckets)
    read = saved_rank.read_bucketed
    state = read(own, f"{path}/nodes", "number", buckets, "number bigint, out_degree bigint").withColumn("rank", F.lit(0.1))
    links = read(own, f"{path}/links", "src", buckets, saved_rank._PACKED)
    text = plan(saved_rank._next(state, links, own.sql("SELECT 1L AS src, 1L AS dst, 1L AS n WHERE false"), 0.85))
    moved = [line for line in text.splitlines() if "Exchange" in line]
    assert len(moved) == 1 and "hashpartitioning(dst" in moved[0]
    assert text.index("Generate explode") < text.index("SortMergeJoin [src") and text.count("aggregate(gaps") == 1


def test_titles_are_numbered_in_order_with_their_links(spark):
    counts = spark.createDataFrame([("b", "a", 2), ("b", "d", 1), ("a", "a", 1), ("c", "d", 5)], "src string, dst string, n bigint")
    rows = ink.numbered_titles(counts).orderBy("number").collect()
    assert [(r.title, r.targets, r.sources) for r in rows] == [("a", 1, 2), ("b", 2, 0), ("c", 1, 0), ("d", 0, 2)]
    assert len({r.number for r in rows}) == 4


def test_known_list_lengths_pack_the_same(spark):
    rows = [(0, 3 * i, 1 + i % 2) for i in range(700)] + [(i, 0, 1) for i in range(1, 30)]
    links = spark.createDataFrame(rows, LINKS)
    sizes = links.groupBy("src").agg(F.count("*").alias("targets"))

    def rows_of(packed):
        return sorted((r.src, r.first, tuple(r.gaps), tuple(r.times)) for r in packed.collect())

    known = ink.pack_links(links, links_per_row=100, targets=sizes)
    assert rows_of(known) == rows_of(ink.pack_links(links, links_per_row=100))
    assert sorted(tuple(row) for row in ink.unpack_links(known).collect()) == sorted(rows)


def test_packed_adjacency_unpacks_its_links_once(spark, small, plan):
    text = plan(own_queries()["packed_adjacency"](spark, small))
    assert text.count("aggregate(gaps") == 1
