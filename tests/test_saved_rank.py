"""Ranking from a saved graph: results, resuming, layout and hot sources."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import inkrank as ink
from inkrank.operators import saved_rank
from inkrank.operators.skew import hot_keys
from inkrank.plans.link_jobs import rank_graph_job, save_graph_job
from test_graph import WIKI, frame
from test_rank import STEPS, expected_ranks, ranks_of
from test_sources import lines_in


@pytest.fixture
def graph(spark, tmp_path):
    wiki = frame(spark, WIKI)
    ink.write_graph(ink.extract_links(wiki), ink.count_pages(wiki), str(tmp_path / "graph"))
    return str(tmp_path / "graph")


@pytest.mark.parametrize("steps", STEPS)
def test_ranks(spark, graph, tmp_path, steps):
    assert ranks_of(ink.rank_saved(spark, graph, str(tmp_path / "w"), steps)) == pytest.approx(STEPS[steps], abs=1e-12)


def test_counts_and_no_step(spark, graph, tmp_path):
    note = ink.graph_note(spark, graph)
    assert (note["n_pages"], note["n_nodes"], note["n_links"]) == (6, 4, 8)
    ranks = ranks_of(ink.rank_saved(spark, graph, str(tmp_path / "w"), 0))
    assert ranks == pytest.approx(dict.fromkeys(["A", "B", "D", ""], 1 / 6))


def stamps(work, step):
    files = [*Path(work, f"step-{step:05d}").iterdir(), Path(work, f"step-{step:05d}.json")]
    return {file.name: file.stat().st_mtime_ns for file in files}


def test_a_killed_ranking_resumes(spark, graph, tmp_path):
    """Killed while step 4 is being written, when steps 1 to 3 are committed."""
    work = str(tmp_path / "work")

    class Killed(Exception):
        pass

    def kill(step):
        if step == 3:
            raise Killed

    with pytest.raises(Killed):
        ink.rank_saved(spark, graph, work, on_step=kill)
    half_written = Path(work, "step-00004")
    half_written.mkdir()
    (half_written / "part-00000-x_00000.c000.snappy.parquet").write_bytes(b"torn")
    before = {step: stamps(work, step) for step in (1, 2, 3)}
    seen = []
    ranks = ranks_of(ink.rank_saved(spark.newSession(), graph, work, on_step=seen.append))
    assert ranks == pytest.approx(STEPS[10], abs=1e-12)
    assert seen == [4, 5, 6, 7, 8, 9, 10]
    assert {step: stamps(work, step) for step in (1, 2, 3)} == before
    # A finished ranking runs nothing, and can be carried on.
    again = []
    assert ranks_of(ink.rank_saved(spark, graph, work, on_step=again.append)) == ranks
    ink.rank_saved(spark, graph, work, 12, on_step=again.append)
    assert again == [11, 12]


def test_steps_of_another_ranking_are_an_error(spark, graph, tmp_path):
    work = str(tmp_path / "work")
    ink.rank_saved(spark, graph, work, 2)
    with pytest.raises(ValueError):
        ink.rank_saved(spark, graph, work, 3, damping=0.5)
    other = str(tmp_path / "other")
    ink.write_graph(spark.createDataFrame([("a", "b")], "src string, dst string"), 1, other)
    with pytest.raises(ValueError):
        ink.rank_saved(spark, other, work, 3)


def test_an_unfinished_graph_is_an_error(spark, graph, tmp_path):
    with pytest.raises(FileExistsError):
        ink.write_graph(spark.createDataFrame([("a", "b")], "src string, dst string"), 1, graph)
    Path(graph, "graph.json").unlink()
    with pytest.raises(FileNotFoundError):
        ink.rank_saved(spark, graph, str(tmp_path / "w"))


def drawn(seed, hub):
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(40)]
    edges = [(rng.choice(names), rng.choice([*names, "leaf"])) for _ in range(400)]
    return edges + [("hub", rng.choice(names)) for _ in range(hub)]


def test_a_hot_source_leaves_its_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hot_keys, "__defaults__", (None, 5))
    edges = drawn(3, 300)
    path = str(tmp_path / "graph")
    ink.write_graph(spark.createDataFrame(edges, "src string, dst string"), 41, path)
    number = spark.read.parquet(f"{path}/nodes").where("node = 'hub'").first().number
    assert spark.read.parquet(f"{path}/hot-links").where(F.col("src") == number).count() == 40
    assert spark.read.parquet(f"{path}/links").where(F.col("src") == number).count() == 0
    found = ranks_of(ink.rank_saved(spark, path, str(tmp_path / "w"), 5))
    assert found == pytest.approx(expected_ranks(edges, 41, 5), abs=1e-12)


def test_a_step_shuffles_only_sums(spark, tmp_path, plan):
    path = str(tmp_path / "graph")
    ink.write_graph(spark.createDataFrame(drawn(4, 0), "src string, dst string"), 40, path)
    buckets = ink.graph_note(spark, path)["buckets"]
    own = saved_rank._bucket_session(spark, buckets)
    read = saved_rank.read_bucketed
    state = read(own, f"{path}/nodes", "number", buckets, "number bigint, out_degree bigint").withColumn("rank", F.lit(0.1))
    links = read(own, f"{path}/links", "src", buckets, "src bigint, dst bigint, n bigint")
    text = plan(saved_rank._next(state, links, own.sql("SELECT 1L AS src, 1L AS dst, 1L AS n WHERE false"), 0.85))
    moved = [line for line in text.splitlines() if "Exchange" in line]
    assert len(moved) == 1 and "hashpartitioning(dst" in moved[0] and text.count("Bucketed: true") == 3
    ink.rank_saved(spark, path, str(tmp_path / "w"), 1)
    files = list((tmp_path / "w" / "step-00001").glob("part-*"))
    assert len(files) <= buckets


def test_empty_graph(spark, tmp_path):
    path = str(tmp_path / "graph")
    ink.write_graph(spark.createDataFrame([], "src string, dst string"), 0, path)
    assert ink.rank_saved(spark, path, str(tmp_path / "w")).collect() == []


def test_jobs(spark, tmp_path):
    dump, graph, out = tmp_path / "dump.xml", str(tmp_path / "graph"), str(tmp_path / "ranks")
    dump.write_text("\n".join(WIKI) + "\n")
    save_graph_job(spark, str(dump), graph)
    rank_graph_job(spark, graph, str(tmp_path / "w"), out, iterations=2)
    rank_graph_job(spark, graph, str(tmp_path / "w"), out)
    ranked = [line.rsplit("\t", 1) for line in lines_in(out)]
    assert [node for node, _ in ranked] == ["B", "A", "D", ""]
    assert {n: float(r) for n, r in ranked} == pytest.approx(STEPS[10], abs=1e-12)
