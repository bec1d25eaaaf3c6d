"""Files, sinks, scratch folders and the jobs over them."""

import math
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import inkrank as ink
from inkrank.__main__ import JOBS
from inkrank.plans.link_jobs import initial_graph_job, page_count_job, page_rank_job
from inkrank.plans.text_jobs import (
    search_index_job,
    search_job,
    term_frequency_job,
    tf_idf_job,
    word_count_job,
)
from inkrank.session import checkpoint_folder, scratch_folder, scratch_path, settle, spread
from test_graph import WIKI
from test_rank import STEPS


@pytest.fixture
def corpus(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.txt").write_text("The cat.\n\nthe end\n")
    (folder / "two words+é%=.txt").write_text("cat\r\ncat # cat\r")
    (folder / "empty.txt").write_text("")
    (folder / "_hidden.txt").write_text("unseen")
    return folder


def lines_in(folder):
    return [
        line
        for part in sorted(Path(folder).glob("part-*"))
        for line in part.read_text().splitlines()
    ]


def test_corpus_lines_and_names(spark, corpus):
    rows = [tuple(r) for r in ink.read_corpus(spark, str(corpus)).collect()]
    assert sorted(rows) == [
        ("one.txt", ""),
        ("one.txt", "The cat."),
        ("one.txt", "the end"),
        ("two words+é%=.txt", "cat"),
        ("two words+é%=.txt", "cat # cat"),
    ]


def test_several_inputs(spark, corpus, tmp_path):
    other = tmp_path / "more"
    other.mkdir()
    (other / "one.txt").write_text("more")
    together = f"{corpus},{other}"
    assert ink.read_corpus(spark, together).count() == 6
    assert ink.read_corpus(spark, [str(corpus), str(other)]).count() == 6
    # Files of one name are one document, yet each file counts.
    assert ink.read_corpus(spark, together).select("doc").distinct().count() == 2
    assert ink.count_files(spark, together) == 5


def test_file_count_sees_empty_hidden_and_nested_files(spark, corpus):
    nested = corpus / "sub"
    nested.mkdir()
    (nested / "x.txt").write_text("x")
    assert ink.count_files(spark, str(corpus)) == 5


def test_table_lines_equal_file_lines(spark, tmp_path):
    texts = ["a\nb", "a\n", "\n", "\n\na", "a\r\nb\rc\n", "x"]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.txt").write_bytes(text.encode())
    table = spark.createDataFrame([(f"{i}.txt", t) for i, t in enumerate(texts)], "doc STRING, text STRING")
    from_table = sorted(tuple(r) for r in ink.table_lines(table).collect())
    from_files = sorted(tuple(r) for r in ink.read_corpus(spark, str(tmp_path)).collect())
    assert from_table == from_files


def test_tsv_sink(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("   (", 'quo"te', 1.0), ("b", None, 1e-7), ("a", "x", 0.1)]
    df = spark.createDataFrame(rows, "k STRING, d STRING, v DOUBLE").coalesce(1)
    ink.write_tsv(df, path, key_order=["k"])
    assert lines_in(path) == ['   (\tquo"te\t1.0', "a\tx\t0.1", "b\t\t1.0E-7"]
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        ink.write_tsv(df, path)
    ink.write_tsv(df.limit(1), path, overwrite=True)
    assert len(lines_in(path)) == 1


def test_text_jobs(spark, corpus, tmp_path):
    counted, weighted, packed, index = (str(tmp_path / n) for n in ("wc", "tf", "packed", "index"))
    word_count_job(spark, str(corpus), counted)
    assert set(lines_in(counted)) >= {"cat#####one.txt\t1", "#" * 6 + "two words+é%=.txt\t1"}
    assert set(lines_in(counted)) >= {"cat#####two words+é%=.txt\t3", "the#####one.txt\t2"}
    term_frequency_job(spark, str(corpus), weighted)
    assert "cat#####one.txt\t1.0" in lines_in(weighted)
    tf_idf_job(spark, str(corpus), packed, index)
    for job, source, out in ((search_job, packed, "s1"), (search_index_job, index, "s2")):
        job(spark, source, str(tmp_path / out), "CAT the")
        found = dict(line.split("\t") for line in lines_in(tmp_path / out))
        assert list(found) == ["one.txt", "two words+é%=.txt"]
        # N = 4 files, the hidden one among them.
        score = math.log10(1 + 4 / 2) * (1 + math.log10(3))
        assert float(found["two words+é%=.txt"]) == pytest.approx(score, abs=1e-12)


def test_rank_job(spark, tmp_path):
    dump, out = tmp_path / "dump.xml", str(tmp_path / "ranks")
    dump.write_text("\n".join(WIKI) + "\n")
    for _ in range(2):  # the output is replaced
        page_rank_job(spark, str(dump), out)
    ranked = [line.rsplit("\t", 1) for line in lines_in(out)]
    assert [node for node, _ in ranked] == ["B", "A", "D", ""]
    assert {n: float(r) for n, r in ranked} == pytest.approx(STEPS[10], abs=1e-12)


def test_graph_jobs(spark, tmp_path):
    dump = tmp_path / "dump.xml"
    dump.write_text("\n".join(WIKI) + "\n")
    page_count_job(spark, str(dump), str(tmp_path / "count"))
    assert lines_in(tmp_path / "count") == ["Pages\t6"]
    initial_graph_job(spark, str(dump), str(tmp_path / "graph"))
    lines = lines_in(tmp_path / "graph")
    assert f"A\t{1 / 6}\tB\t2" in lines and len(lines) == 8


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        word_count_job(spark, str(tmp_path / "none"), str(tmp_path / "out"))


def test_command_line_lists_the_jobs():
    shown = subprocess.run(
        [sys.executable, "-m", "inkrank", "--help"],
        cwd=Path(__file__).resolve().parent.parent,
        capture_output=True,
        text=True,
        check=True,
    )
    assert all(job in shown.stdout for job in JOBS)


def test_scratch_lies_in_the_checkpoint_folder(spark):
    folder = checkpoint_folder(spark)
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(folder.rstrip("/") + "/") and one != two


def test_scratch_folder_is_removed(spark):
    with scratch_folder(spark, "test") as folder:
        settled = settle(spark.range(5), f"{folder}/five")
        assert settled.count() == 5
        local = Path(folder.removeprefix("file:"))
        assert (local / "five").exists()
    assert not local.exists()


def test_settled_frame_has_no_lineage(spark, plan):
    df = spark.range(10).select(F.col("id") * 2)
    settled = settle(df, scratch_path(spark, "test"))
    assert sorted(r[0] for r in settled.collect()) == list(range(0, 20, 2))
    assert "Range" not in plan(settled)


def test_spread_only_widens(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert spread(documents).rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores + 3)
    assert spread(wide) is wide
