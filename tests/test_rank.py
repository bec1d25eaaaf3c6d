"""Rank steps, the full ranking and its order."""

import random
import re

import pytest
from pyspark.sql import functions as F

import inkrank as ink
from inkrank.operators.rank import LinkGraph, _advance, _hold
from inkrank.operators.skew import hot_keys
from test_graph import WIKI, frame

STEPS = {
    1: {
        "A": 0.43333333333333335,
        "B": 0.2916666666666667,
        "D": 0.18541666666666667,
        "": 0.15000000000000002,
    },
    2: {
        "A": 0.4802604166666667,
        "B": 0.45812500000000006,
        "D": 0.24208333333333337,
        "": 0.15000000000000002,
    },
    10: {
        "A": 0.7389488189763724,
        "B": 0.7934411914937959,
        "D": 0.30541563158744434,
        "": 0.15000000000000002,
    },
}


def ranks_of(df):
    return {row.node: row.rank for row in df.collect()}


def expected_ranks(edges, n_pages, steps, damping=0.85):
    degree = {}
    for src, _ in edges:
        degree[src] = degree.get(src, 0) + 1
    ranks = dict.fromkeys(degree, 1 / n_pages)
    for _ in range(steps):
        got = dict.fromkeys(degree, 0.0)
        for src, dst in edges:
            if dst in got:
                got[dst] += ranks[src] / degree[src]
        ranks = {node: (1 - damping) + damping * got[node] for node in degree}
    return ranks


@pytest.fixture(scope="module")
def wiki(spark):
    return frame(spark, WIKI)


@pytest.fixture
def small_cells(monkeypatch):
    """Lets the small graphs of these tests have hot sources."""
    monkeypatch.setattr(hot_keys, "__defaults__", (None, 50))


@pytest.mark.parametrize("steps", STEPS)
def test_wiki_ranks(wiki, steps):
    ranks = ink.page_rank(ink.extract_links(wiki), ink.count_pages(wiki), steps)
    assert ranks_of(ranks) == pytest.approx(STEPS[steps], abs=1e-12)


def test_single_steps(wiki):
    edges = ink.extract_links(wiki)
    graph = ink.link_graph(ink.link_counts(edges))
    first = ink.rank_step(graph, ink.initial_ranks(edges, ink.count_pages(wiki)))
    assert ranks_of(first) == pytest.approx(STEPS[1], abs=1e-12)
    assert ranks_of(ink.rank_step(graph, first)) == pytest.approx(STEPS[2], abs=1e-12)


def test_no_step_leaves_the_initial_ranks(wiki):
    ranks = ink.page_rank(ink.extract_links(wiki), 6, iterations=0)
    assert ranks_of(ranks) == dict.fromkeys(["A", "B", "D", ""], 1 / 6)


@pytest.mark.parametrize("every", [1, 3, 100])
def test_checkpoints_change_nothing(wiki, every):
    ranks = ink.page_rank(ink.extract_links(wiki), 6, checkpoint_every=every)
    assert ranks_of(ranks) == pytest.approx(STEPS[10], abs=1e-12)


def random_edges(hub_share, seed):
    """Edges of which a part leaves one hub and as many arrive there."""
    rng = random.Random(seed)
    edges = []
    for _ in range(3000):
        src, dst = f"n{rng.randrange(300)}", f"n{rng.randrange(400)}"
        draw = rng.random()
        if draw < hub_share:
            src = "hub"
        elif draw < 2 * hub_share:
            dst = "hub"
        edges.append((src, dst))
    return edges


@pytest.mark.parametrize("hub_share", [0, 0.4])
def test_random_graph(spark, small_cells, hub_share):
    edges = random_edges(hub_share, 5)
    df = spark.createDataFrame(edges, "src STRING, dst STRING")
    hot = ink.link_graph(ink.link_counts(df)).hot
    assert hot.count() == (1 if hub_share else 0)
    ranks = ranks_of(ink.page_rank(df, 400))
    assert ranks == pytest.approx(expected_ranks(edges, 400, 10), abs=1e-9)
    assert min(ranks.values()) >= 0.15 - 1e-12


def test_hub_links_are_in_several_cells(spark, small_cells):
    df = spark.createDataFrame(random_edges(0.4, 6), "src STRING, dst STRING")
    links = ink.link_graph(ink.link_counts(df)).links
    cells = {r.src: r.n_cells for r in links.groupBy("src").agg(F.countDistinct("cell").alias("n_cells")).collect()}
    assert cells.pop("hub") > 1
    assert set(cells.values()) == {1}


def test_mass_is_kept_when_every_target_is_a_node(spark):
    edges = [(f"n{i}", f"n{(i * 7 + k) % 50}") for i in range(50) for k in range(3)]
    df = spark.createDataFrame(edges, "src STRING, dst STRING")
    graph = ink.link_graph(ink.link_counts(df))
    before = ink.initial_ranks(df, 50)
    after = sum(ranks_of(ink.rank_step(graph, before)).values())
    assert after == pytest.approx(0.15 * 50 + 0.85 * 1, abs=1e-9)


def test_held_frames_need_no_shuffle(spark, plan):
    df = spark.createDataFrame(random_edges(0, 7), "src STRING, dst STRING")
    graph = ink.link_graph(ink.link_counts(df))
    nodes = _hold(graph.nodes, ["node"])
    links = _hold(ink.link_counts(df), ["src"])
    joined = links.join(nodes.withColumnRenamed("node", "src").hint("merge"), "src")
    above_cache = "".join(
        line for line in plan(joined).splitlines(True) if "Exchange" in line or "Sort " in line
    ).split("REPARTITION_BY_NUM")[0]
    assert "ENSURE_REQUIREMENTS" not in above_cache
    nodes.unpersist()
    links.unpersist()


def test_sorted_ranks(spark):
    rows = [("a", 0.15), ("b", 0.5), ("c", 0.15), ("d", 0.9), ("e", 0.5)]
    ranks = spark.createDataFrame(rows, "node STRING, rank DOUBLE").repartition(3)
    assert [r.node for r in ink.sort_ranks(ranks).collect()] == ["d", "b", "e", "a", "c"]


def test_equal_ranks_still_split_over_tasks(spark):
    ranks = spark.range(20000).select(F.concat(F.lit("n"), "id").alias("node"), F.lit(0.15).alias("rank"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = (
            ink.sort_ranks(ranks).groupBy(F.spark_partition_id().alias("p")).count().collect()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4


def test_numbered_ranks(spark):
    rows = [(f"n{i:04d}", float(i % 37)) for i in range(3000)]
    ranks = spark.createDataFrame(rows, "node STRING, rank DOUBLE").repartition(5)
    expected = [node for node, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    numbered = ink.number_sorted(ranks).collect()
    assert [r.node for r in sorted(numbered, key=lambda r: r.position)] == expected
    assert sorted(r.position for r in numbered) == list(range(1, 3001))


def test_links_to_non_nodes_count_in_the_out_degree_only(spark):
    edges = [("a", "b"), ("a", "gone"), ("a", "gone"), ("b", "a"), ("b", "lost")]
    ranks = ranks_of(ink.page_rank(spark.createDataFrame(edges, "src STRING, dst STRING"), 7))
    assert ranks == pytest.approx(expected_ranks(edges, 7, 10), abs=1e-12)


def test_no_links_at_all(spark):
    assert ink.page_rank(spark.createDataFrame([], "src STRING, dst STRING"), 3).count() == 0


def test_the_session_and_its_cache_are_left_as_they_were(spark, wiki):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        ranks = ink.page_rank(ink.extract_links(wiki), 6)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ranks_of(ranks) == pytest.approx(STEPS[10], abs=1e-12)


@pytest.mark.parametrize("hub_share", [0, 0.4])
def test_a_step_has_one_exchange_or_two_with_hot_sources(spark, small_cells, plan, hub_share):
    df = spark.createDataFrame(random_edges(hub_share, 8), "src STRING, dst STRING")
    graph = ink.link_graph(ink.link_counts(df))
    nodes = _hold(graph.nodes.withColumn("rank", F.lit(1.0)), ["node"])
    hot = graph.hot if hub_share else None
    links = _hold(graph.links, ["src"] if hot is None else ["src", "cell"])
    held = LinkGraph(nodes.drop("rank"), links, hot)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = [nodes]
        for _ in range(3):
            steps.append(_advance(held, steps[-1], 0.85))
        # Those by source alone lie below held frames and ran when they were filled.
        moved = [re.findall(r"Exchange hashpartitioning\((.*?), \d+\), ENSURE", plan(s)) for s in steps]
        counts = [sum(not re.fullmatch(r"src#\d+|_\w+#\d+L?", keys) for keys in x) for x in moved]
        assert [b - a for a, b in zip(counts, counts[1:], strict=False)] == [2 if hub_share else 1] * 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        nodes.unpersist()
        links.unpersist()


def test_step_reads_the_edges_once(spark, small, tmp_path):
    """The counted links are written once; nothing after reads the edges again."""
    path = str(tmp_path / "edges")
    spark.createDataFrame(random_edges(0, 9), "src STRING, dst STRING").write.parquet(path)
    graph = ink.link_graph(ink.link_counts(spark.read.parquet(path)))
    step = ink.rank_step(graph, ink.start_ranks(graph))
    files = {name.split("/")[-2] for name in step.inputFiles()}
    assert files and "edges" not in files
