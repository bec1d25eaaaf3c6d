"""The link jobs from a wiki dump to an output folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkrank.operators.graph import count_pages, initial_graph, write_links
from inkrank.operators.rank import ITERATIONS, page_rank, sort_ranks
from inkrank.operators.saved_rank import rank_saved, write_graph
from inkrank.plans.text_jobs import Paths
from inkrank.session import scratch_path
from inkrank.sources.corpus import read_pages
from inkrank.sources.sinks import write_tsv


def _links(spark: SparkSession, inputs: Paths) -> tuple[DataFrame, int]:
    """Links and page count of a dump, which is read once."""
    return write_links(read_pages(spark, inputs), scratch_path(spark, "dump-links"))


def page_count_job(spark: SparkSession, inputs: Paths, output: str) -> None:
    """One line: ``Pages<TAB>count``."""
    count = count_pages(read_pages(spark, inputs))
    write_tsv(count.select(F.lit("Pages").alias("key"), "n_pages"), output)


def initial_graph_job(
    spark: SparkSession, inputs: Paths, output: str, graph_path: str | None = None
) -> None:
    """The ranked graph as lines of node, rank, link target and its multiplicity.

    A tab in a link's text shifts the columns of its line; the parquet table, written
    if ``graph_path`` is given, keeps every text as it is.
    """
    graph = initial_graph(*_links(spark, inputs))
    if graph_path:
        graph.write.mode("overwrite").parquet(graph_path)
        graph = spark.read.parquet(graph_path)
    write_tsv(graph, output, overwrite=True)


def ranked_dump(spark: SparkSession, inputs: Paths, iterations: int = ITERATIONS) -> DataFrame:
    """``(node, rank)`` of a dump with one page per line."""
    return page_rank(*_links(spark, inputs), iterations)


def page_rank_job(
    spark: SparkSession, inputs: Paths, output: str, iterations: int = ITERATIONS
) -> None:
    """Pages by falling rank; an existing output is replaced."""
    write_tsv(sort_ranks(ranked_dump(spark, inputs, iterations)), output, overwrite=True)


def save_graph_job(spark: SparkSession, inputs: Paths, graph_path: str) -> None:
    """A graph on disk that any number of rankings can read."""
    write_graph(*_links(spark, inputs), graph_path)


def rank_graph_job(
    spark: SparkSession, graph_path: str, work_path: str, output: str, iterations: int = ITERATIONS
) -> None:
    """Pages of a saved graph by falling rank, going on behind the last step that
    ``work_path`` holds."""
    ranks = rank_saved(spark, graph_path, work_path, iterations)
    write_tsv(sort_ranks(ranks), output, overwrite=True)
