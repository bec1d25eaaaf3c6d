"""Tables of queries against saved indexes: results, plans, hot terms."""

import json
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import inkrank as ink
from inkrank.functions.text import folded
from inkrank.operators import skew
from inkrank.operators.skew import hot_keys
from inkrank.session import checkpoint_folder

WORDS = ["the", "cat", "dog", "ıs", "straße", "#", "of", "Σίσυφος"]


def tables(spark, seed=1):
    rng = random.Random(seed)
    weights = [60, 8, 8, 4, 4, 2, 10, 1]
    texts = [(f"D{i}", " ".join(rng.choices(WORDS, weights, k=rng.randint(0, 9)))) for i in range(120)]
    asked = [(i, " ".join(rng.choices([w.upper() for w in WORDS] + ["none"], k=rng.randint(0, 4)))) for i in range(60)]
    asked += [(100 + i, "The") for i in range(40)]
    counts = ink.doc_word_count(ink.tokenize(spark.createDataFrame(texts, "doc string, text string")))
    queries = spark.createDataFrame(asked, "query_id long, query_text string")
    return ink.tf_idf(counts, len(texts)).cache(), queries


def scores(df):
    return {(row.query_id, row.doc): row.score for row in df.collect()}


def test_both_layouts_equal_the_search(spark, tmp_path):
    index, queries = tables(spark)
    expected = pytest.approx(scores(ink.search_many(index, queries)), abs=1e-12)
    ink.write_bucketed_index(index, str(tmp_path / "b"), 4)
    assert scores(ink.search_bucketed(spark, str(tmp_path / "b"), queries)) == expected
    ink.write_sliced_index(index, str(tmp_path / "s"), 8)
    assert scores(ink.search_sliced(spark, str(tmp_path / "s"), queries)) == expected
    assert scores(ink.search_sliced(spark, str(tmp_path / "s"), queries, broadcast_bytes=0)) == expected
    none = queries.limit(0)
    assert scores(ink.search_bucketed(spark, str(tmp_path / "b"), none)) == {}
    assert scores(ink.search_sliced(spark, str(tmp_path / "s"), none)) == {}


@pytest.mark.parametrize("cell_rows", [60, 5])
def test_hot_terms(spark, tmp_path, monkeypatch, cell_rows):
    """Hot in the index and among the queries, at 5 rows a cell most terms are."""
    index, queries = tables(spark, 2)
    monkeypatch.setattr(hot_keys, "__defaults__", (None, cell_rows))
    monkeypatch.setattr(skew.grid_join, "__defaults__", (None, 50))
    path = str(tmp_path / "b")
    ink.write_bucketed_index(index, path, 4)
    hot = {row.term for row in spark.read.parquet(f"{path}/hot-terms").collect()}
    assert "the" in hot and "the" not in {row.term for row in spark.read.parquet(f"{path}/terms").collect()}
    expected = pytest.approx(scores(ink.search_many(index, queries)), abs=1e-12)
    assert scores(ink.search_bucketed(spark, path, queries)) == expected


def test_the_bucketed_index_does_not_move(spark, tmp_path, plan):
    index, queries = tables(spark)
    path = str(tmp_path / "b")
    ink.write_bucketed_index(index, path, 4)
    lines = plan(ink.search_bucketed(spark, path, queries)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert join < scan and not any("Exchange" in line for line in lines[join:scan])
    assert sum("Exchange" in line for line in lines[scan:]) == 1  # the query terms


def test_only_asked_slices_are_read(spark, tmp_path, plan):
    index, _ = tables(spark)
    path = str(tmp_path / "s")
    ink.write_sliced_index(index, path, 64)
    queries = spark.createDataFrame([(1, "dog")], "query_id long, query_text string")
    found = ink.search_sliced(spark, path, queries)
    assert "dynamicpruningexpression" in plan(found)
    slices = spark.read.parquet(f"{path}/slices")
    assert slices.select("slice").distinct().count() > 3
    assert scores(found) == pytest.approx(scores(ink.search_many(index, queries)), abs=1e-12)


def test_an_unfinished_index_is_an_error(spark, tmp_path):
    index, queries = tables(spark)
    ink.write_sliced_index(index, str(tmp_path / "s"), 4)
    (tmp_path / "s" / "index.json").unlink()
    for search in (ink.search_sliced, ink.search_bucketed):
        with pytest.raises(FileNotFoundError):
            search(spark, str(tmp_path / "s"), queries)


@pytest.mark.parametrize("bytes_", [0, 1 << 20])
@pytest.mark.parametrize("cell_rows", [10_000, 5])
def test_matches_in_buckets_are_added_up_where_they_arise(spark, tmp_path, plan, monkeypatch, bytes_, cell_rows):
    """With and without hot terms, with query terms broadcast and in cells."""
    index, queries = tables(spark, 3)
    asked = [(None, "the THE cat"), (7, "of"), (7, "none"), (8, ""), (9, None)]
    queries = queries.unionByName(spark.createDataFrame(asked, queries.schema))
    monkeypatch.setattr(hot_keys, "__defaults__", (None, cell_rows))
    path = str(tmp_path / "b")
    ink.write_bucketed_index(index, path, 4)
    assert spark.read.parquet(f"{path}/hot-terms").isEmpty() == (cell_rows > 5)
    found = ink.search_bucketed(spark, path, queries, broadcast_bytes=bytes_)
    # Neither the matches nor their sums are moved.
    assert "Exchange" not in plan(found).split("Join")[0]
    assert scores(found) == pytest.approx(scores(ink.search_many(index, queries)), abs=1e-12)


def test_buckets_are_in_order_and_not_sorted_again(spark, tmp_path, plan):
    index, queries = tables(spark, 4)
    path = str(tmp_path / "b")
    ink.write_bucketed_index(index, path, 2)
    files = sorted((tmp_path / "b" / "terms").glob("*.parquet"))
    assert len(files) == 2
    for file in files:
        terms = [term.encode() for term in pq.read_table(file).column("term").to_pylist()]
        assert terms == sorted(terms) and len(set(terms)) > 1
    lines = plan(ink.search_bucketed(spark, path, queries)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert not any("Sort " in line for line in lines[join:scan])


def test_an_index_saved_without_sizes(spark, tmp_path):
    index, queries = tables(spark, 5)
    path = tmp_path / "b"
    ink.write_bucketed_index(index, str(path), 4)
    sizes = {row.term: row.n for row in spark.read.parquet(str(path / "sizes")).collect()}
    assert sizes == dict(index.groupBy(folded(F.col("term"))).count().collect())
    note = json.loads((path / "index.json").read_text())
    for crc in path.glob(".index.json*"):
        crc.unlink()
    (path / "index.json").write_text(json.dumps({name: note[name] for name in ("buckets", "n_hot")}))
    (path / "sizes").rename(path / "other")
    expected = pytest.approx(scores(ink.search_many(index, queries)), abs=1e-12)
    assert scores(ink.search_bucketed(spark, str(path), queries)) == expected


def test_writing_an_index_leaves_nothing_in_the_shared_folder(spark, tmp_path):
    index, _ = tables(spark, 6)
    scratch = Path(checkpoint_folder(spark).removeprefix("file:"))
    before = set(scratch.iterdir())
    ink.write_bucketed_index(index.withColumn("doc", F.upper("doc")), str(tmp_path / "b"), 4)
    assert set(scratch.iterdir()) == before
    saved = spark.read.parquet(str(tmp_path / "b" / "terms"))
    assert saved.columns == ["term", "doc", "tf_idf"] and saved.where("doc <> lower(doc)").isEmpty()
