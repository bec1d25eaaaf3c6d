"""Saved word counts that grow by batches of documents.

A batch has the counts ``(term, doc, n)`` of its documents, the documents
themselves, as one without any token counts too, and a note with their number,
which commits it. An index is made from the counts of all batches; no text of an
earlier batch is looked at again. A document that comes again replaces the earlier
one. One program at a time may append.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from inkrank.operators.postings import doc_word_count, tf_idf, tokenize
from inkrank.sources.index import with_filters
from inkrank.sources.saved import names_in, read_note, write_note


def append_documents(texts: DataFrame, path: str) -> None:
    """Count the ``(doc, text)`` rows, lines or whole texts, and save them as a batch."""
    append_counts(doc_word_count(tokenize(texts)), texts.select("doc"), path)


def append_counts(counts: DataFrame, docs: DataFrame, path: str) -> None:
    """Save the counts of the documents named by ``docs`` as a further batch."""
    spark = counts.sparkSession
    batch = f"{path}/batch-{len(_batches(spark, path)) + 1:05d}"
    ordered = counts.select("term", "doc", "n").repartitionByRange("term", "doc")
    with_filters(ordered.sortWithinPartitions("term", "doc").write.mode("overwrite"), "term").parquet(f"{batch}/counts")
    docs.select("doc").distinct().write.mode("overwrite").parquet(f"{batch}/docs")
    new = spark.read.parquet(f"{batch}/docs")
    replaced = _live_docs(spark, path).join(new, "doc", "left_semi").count() if _batches(spark, path) else 0
    write_note(spark, f"{batch}.json", {"n_docs": new.count(), "replaced": replaced})


def _batches(spark: SparkSession, path: str) -> list[tuple[str, dict]]:
    """Path and note of each committed batch, in order."""
    names = [name.removesuffix(".json") for name in names_in(spark, f"{path.rstrip('/')}/batch-*.json")]
    return [(f"{path}/{name}", read_note(spark, f"{path}/{name}.json")) for name in names]


def _live(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The rows of a table whose documents no later batch replaces."""
    parts = []
    newer = None
    for batch, note in reversed(_batches(spark, path)):
        rows = spark.read.parquet(f"{batch}/{table}")
        parts.append(rows if newer is None else rows.join(newer, "doc", "left_anti"))
        if note["replaced"]:
            docs = spark.read.parquet(f"{batch}/docs")
            newer = docs if newer is None else newer.unionByName(docs)
    if not parts:
        raise FileNotFoundError(f"no finished batch at {path}")
    return reduce(DataFrame.unionByName, reversed(parts))


def _live_docs(spark: SparkSession, path: str) -> DataFrame:
    return _live(spark, path, "docs")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(term, doc, n)`` of all documents that are saved."""
    return _live(spark, path, "counts")


def saved_size(spark: SparkSession, path: str) -> int:
    """The number of documents that are saved, by the notes alone."""
    return sum(note["n_docs"] - note["replaced"] for _, note in _batches(spark, path))


def saved_tf_idf(spark: SparkSession, path: str) -> DataFrame:
    """The index ``(term, doc, tf_idf)`` over all batches."""
    return tf_idf(read_counts(spark, path), saved_size(spark, path))
