"""Corpora: text files named by their base name, or a table of texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkrank.functions.text import lines_of


def path_list(paths: str | Iterable[str]) -> list[str]:
    """One path, several, or several in one string separated by commas.

    A comma inside braces belongs to a glob, as in ``/d/{a,b}``.
    """
    if isinstance(paths, str):
        cuts, depth = [-1], 0
        for at, char in enumerate(paths):
            depth += (char == "{") - (char == "}" and depth > 0)
            if char == "," and not depth:
                cuts.append(at)
        paths = [paths[a + 1 : b] for a, b in zip(cuts, [*cuts[1:], len(paths)], strict=True)]
    return [path for path in paths if path]


def read_corpus(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """``(doc, text)``, one row per line; files of the same name are one document."""
    # The metadata column is URL-encoded except for a plus sign.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return spark.read.text(path_list(paths)).select(name.alias("doc"), F.col("value").alias("text"))


def count_files(spark: SparkSession, paths: str | Iterable[str]) -> int:
    """Number of files in the input trees.

    Empty and hidden files count as well, and Spark's file sources leave those
    out, so the file system is asked instead.
    """
    jvm = spark.sparkContext._jvm
    hadoop_conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in path_list(paths):
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        file_system = hadoop_path.getFileSystem(hadoop_conf)
        found = file_system.globStatus(hadoop_path)
        if not found:
            raise FileNotFoundError(path)
        for status in found:
            total += file_system.getContentSummary(status.getPath()).getFileCount()
    return total


def table_corpus(df: DataFrame, doc: str, text: str = "text") -> DataFrame:
    """``(doc, text)`` of a table that has one document per row."""
    return df.select(F.col(doc).alias("doc"), F.col(text).alias("text"))


def table_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per line of a text column, all other columns kept."""
    others = [F.col(name) for name in df.columns if name != text]
    return df.select(*others, F.explode(lines_of(F.col(text))).alias("line"))


def corpus_size(docs: DataFrame) -> DataFrame:
    """``(n_docs)``: documents without any token count as well."""
    return docs.agg(F.count("*").alias("n_docs"))


def read_pages(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """``(line)``: a wiki dump holding one page per line."""
    return spark.read.text(path_list(paths)).select(F.col("value").alias("line"))
