"""Counts saved in batches, weights read back, and Bloom filters of an index."""

import pytest
from pyspark.sql import functions as F

import inkrank as ink
from inkrank.sources.index import with_filters
from test_index import DOCS, expected_index, index_of

SCHEMA = "doc string, text string"
MORE = [("new.txt", "a new cat"), ("none.txt", None), ("B.txt", "dog")]


def whole(spark, rows):
    texts = spark.createDataFrame(rows, SCHEMA)
    n_docs = len({doc for doc, _ in rows})
    return expected_index(ink.doc_word_count(ink.tokenize(texts)), n_docs), n_docs


def saved(spark, path, *batches):
    for rows in batches:
        ink.append_documents(spark.createDataFrame(rows, SCHEMA), path)
    return index_of(ink.saved_tf_idf(spark, path)), ink.saved_size(spark, path)


def close(found, expected):
    assert found[1] == expected[1]
    assert found[0] == pytest.approx(expected[0], abs=1e-12)


def test_batches_equal_one_index(spark, tmp_path):
    close(saved(spark, str(tmp_path / "one"), DOCS), whole(spark, DOCS))
    close(saved(spark, str(tmp_path / "two"), DOCS, MORE[:2]), whole(spark, DOCS + MORE[:2]))


def test_a_document_that_comes_again_replaces_the_old(spark, tmp_path):
    kept = [row for row in DOCS if row[0] != "B.txt"]
    path = str(tmp_path / "store")
    close(saved(spark, path, DOCS, MORE), whole(spark, kept + MORE))
    again = [("new.txt", ""), ("a.txt", "the")]
    last = [row for row in kept + MORE if row[0] not in ("new.txt", "a.txt")]
    close(saved(spark, path, again), whole(spark, last + again))
    close(saved(spark, path, [("B.txt", "dog dog")]), whole(spark, [r for r in last + again if r[0] != "B.txt"] + [("B.txt", "dog dog")]))


def test_an_unfinished_batch_does_not_count(spark, tmp_path):
    path = str(tmp_path / "store")
    expected = saved(spark, path, DOCS)
    saved(spark, path, MORE)
    (tmp_path / "store" / "batch-00002.json").unlink()
    assert (index_of(ink.saved_tf_idf(spark, path)), ink.saved_size(spark, path)) == expected
    with pytest.raises(FileNotFoundError):
        ink.read_counts(spark, str(tmp_path / "none"))


def test_no_old_text_is_read_again(spark, tmp_path):
    texts = tmp_path / "texts"
    spark.createDataFrame(DOCS, SCHEMA).write.parquet(str(texts))
    path = str(tmp_path / "store")
    ink.append_documents(spark.read.parquet(str(texts)), path)
    for file in texts.iterdir():
        file.unlink()
    ink.append_documents(spark.createDataFrame(MORE[:2], SCHEMA), path)
    index = ink.saved_tf_idf(spark, path)
    assert all("/counts/" in file for file in index.inputFiles())
    close((index_of(index), 5), whole(spark, DOCS + MORE[:2]))


@pytest.mark.parametrize("broadcast_bytes", [0, 100, 1 << 20])
def test_index_of_saved_weights(spark, tmp_path, broadcast_bytes):
    counts = ink.doc_word_count(ink.tokenize(spark.createDataFrame(DOCS, SCHEMA)))
    ink.write_packed(ink.term_frequency(counts), str(tmp_path / "tf"))
    weights = ink.read_packed(spark, str(tmp_path / "tf"), "tf")
    found = index_of(ink.tf_idf_of_weights(weights, 3, broadcast_bytes))
    assert found == pytest.approx(expected_index(counts, 3), abs=1e-12)


def rows_scanned(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_row_groups_without_a_term_are_skipped(spark, tmp_path):
    """Batches whose ranges of terms overlap; dictionaries too small to tell."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.dictionary.page.size", "1024")
    try:
        for batch in range(20):
            ids = spark.range(batch * 1000, batch * 1000 + 1000)
            counts = ids.select(F.sha1(F.col("id").cast("string")).alias("term"), "id", F.lit(1).alias("n"))
            counts = counts.unionByName(spark.sql("SELECT '7rare' AS term, 5L AS id, 1 AS n")) if batch == 17 else counts
            rows = counts.withColumnRenamed("id", "doc").coalesce(1)
            rows.write.mode("append").parquet(str(tmp_path / "plain"))
            with_filters(rows.write.mode("append"), "term").parquet(str(tmp_path / "filtered"))
    finally:
        conf.unset("parquet.dictionary.page.size")
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    wanted = F.col("term") == "7rare"
    plain = own.read.parquet(str(tmp_path / "plain")).where(wanted)
    stored = own.read.parquet(str(tmp_path / "filtered")).where(wanted)
    assert plain.count() == stored.count() == 1
    assert rows_scanned(plain) >= 10 * rows_scanned(stored) > 0
