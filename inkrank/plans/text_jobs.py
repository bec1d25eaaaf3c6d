"""The text jobs from input paths to an output folder."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from inkrank.operators.postings import doc_word_count, term_frequency, tf_idf, tokenize
from inkrank.operators.search import in_document_order, search
from inkrank.sources.corpus import count_files, read_corpus
from inkrank.sources.index import read_index, read_packed, write_index, write_packed
from inkrank.sources.sinks import write_tsv

Paths = str | Iterable[str]


def counted_corpus(spark: SparkSession, inputs: Paths) -> DataFrame:
    return doc_word_count(tokenize(read_corpus(spark, inputs)))


def word_count_job(spark: SparkSession, inputs: Paths, output: str) -> None:
    write_packed(counted_corpus(spark, inputs), output)


def term_frequency_job(spark: SparkSession, inputs: Paths, output: str) -> None:
    write_packed(term_frequency(counted_corpus(spark, inputs)), output)


def tf_idf_job(
    spark: SparkSession, inputs: Paths, output: str, index_path: str | None = None
) -> None:
    """Packed text for other programs, and parquet for searching if a path is given."""
    if not isinstance(inputs, str):
        inputs = list(inputs)
    index = tf_idf(counted_corpus(spark, inputs), count_files(spark, inputs))
    if index_path:
        write_index(index, index_path)
        index = read_index(spark, index_path)
    write_packed(index, output)


def search_job(spark: SparkSession, index_path: str, output: str, query: str) -> None:
    """Search a packed text index."""
    result = search(read_packed(spark, index_path), query)
    write_tsv(in_document_order(result), output)


def search_index_job(spark: SparkSession, index_path: str, output: str, query: str) -> None:
    """Search a parquet index, reading little more than the query's terms."""
    result = search(read_index(spark, index_path), query, folded=True)
    write_tsv(in_document_order(result), output)
