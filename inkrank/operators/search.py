"""Scoring documents for free-text queries."""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import prod
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkrank.functions.text import case_variants, query_terms_of
from inkrank.functions.text import folded as folded_term
from inkrank.operators.postings import doc_word_count, tf_idf, tf_idf_of_terms, tokenize
from inkrank.operators.skew import lookup
from inkrank.session import scratch_path, session_with, settle, shuffle_width

# Bytes a row of the broadcast query terms needs beside its term.
_ROW_OVERHEAD = 48

# Beyond this many terms, looking for each costs more than it saves.
_SUBSTRING_TERMS = 16

_POSTINGS = "doc string, term string, tf_idf double"

# Pairs of a posting and a query term that one task adds up, about: all results of a
# task are in its memory at once. Fewer than the least are not dealt to more tasks.
_TASK_PAIRS = 4_000_000
_LEAST_PAIRS = 100_000

# In such a session rows that lie by cell need not be moved to be joined by cell and term.
CELL_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

# Beyond this many spellings of a term, the scan is not given any.
_SPELLINGS = 256


def query_weights(query: str) -> dict[str, int]:
    """Folded terms of a query with the number of times each occurs.

    Split and folded by Spark, as the terms of an index are.
    """
    terms = SparkSession.active().range(1).select(F.explode(query_terms_of(F.lit(query))).alias("term"))
    found = terms.groupBy(folded_term(F.col("term")).alias("term")).agg(F.count("*").alias("n"))
    # As many rows as the query has terms.
    return {row.term: row.n for row in found.orderBy("term").collect()}


def _spellings(term: str) -> list[str] | None:
    """The small-letter spellings that fold to a term; None if they are many."""
    variants = case_variants()
    choices = [variants.get(char, char) for char in term]
    if prod(map(len, choices)) > _SPELLINGS:
        return None
    return ["".join(chars) for chars in product(*choices)]


def _all_spellings(weights: dict[str, int]) -> list[str] | None:
    found = [_spellings(term) for term in weights]
    return None if None in found else sorted({spelling for x in found for spelling in x})


def _matches(weights: dict[str, int], lowered: bool) -> Column:
    """Whether ``term`` is any of the query's: by its spellings where the index is
    known to hold small letters, as a scan can use that, else by folding it."""
    every = _all_spellings(weights) if lowered else None
    if every is None:
        return folded_term(F.col("term")).isin(list(weights))
    return F.col("term").isin(every) if every else F.lit(False)


def _times(weights: dict[str, int]) -> Column:
    term, times = folded_term(F.col("term")), F.lit(1)
    for count in sorted({n for n in weights.values() if n > 1}):
        terms = [term for term, n in weights.items() if n == count]
        times = F.when(term.isin(terms), F.lit(count)).otherwise(times)
    return times


def _result_doc() -> Column:
    return F.lower(F.col("doc").cast("string")).alias("doc")


def search(index: DataFrame, query: str, folded: bool = False) -> DataFrame:
    """``(doc, score)`` of the documents that hold any of the query's terms.

    Any case matches, a repeated term counts once per repetition, and document
    names come out lower-case, names that differ in case only as one. ``folded``
    states that the index has lower-case terms, as ``read_index`` and the token
    rules guarantee; the filter on a term's spellings then reaches the parquet scan.
    """
    weights = query_weights(query)
    hits = index.where(_matches(weights, folded))
    return hits.groupBy(_result_doc()).agg(F.sum(F.col("tf_idf") * _times(weights)).alias("score"))


def search_tokens(tokens: DataFrame, n_docs: int | DataFrame, query: str) -> DataFrame:
    """Search a corpus that has no index: only the query's terms are ever counted."""
    weights = query_weights(query)
    counts = doc_word_count(tokens.where(_matches(weights, lowered=True)))
    every = _all_spellings(weights)
    index = tf_idf(counts, n_docs) if every is None else tf_idf_of_terms(counts, n_docs, every)
    return search(index, query, folded=True)


def search_texts(texts: DataFrame, n_docs: int | DataFrame, query: str) -> DataFrame:
    """Search ``(doc, text)`` rows that have no index.

    A text that does not contain any query term as a plain substring cannot hold
    it as a token, so only the others are split into tokens at all.
    """
    spellings = _all_spellings(query_weights(query))
    if spellings and len(spellings) <= _SUBSTRING_TERMS:
        small = F.lower("text")
        texts = texts.where(reduce(or_, [F.contains(small, F.lit(term)) for term in spellings]))
    return search_tokens(tokenize(texts), n_docs, query)


def search_many(
    index: DataFrame,
    queries: DataFrame,
    query_id: str = "query_id",
    text: str = "query_text",
    folded: bool = False,
    broadcast_bytes: int = 32 * 1024 * 1024,
) -> DataFrame:
    """``(query_id, doc, score)`` for a table of queries, in one job.

    Query terms that measure at most ``broadcast_bytes`` are broadcast. The
    postings they match are then partitioned by document before they meet the
    queries, so the far more numerous matches are added up where they arise; a
    document has at most one posting per query term to bring along. Beyond the
    limit the queries are shuffled too; see ``scored_in_cells``.
    """
    spark = index.sparkSession
    # Never null, and said so: a null check below the counting of the index would part
    # the postings from their frequencies, and every text would be split once for each.
    # No query asks for the empty term.
    term = F.coalesce(folded_term(F.col("term")), F.lit("")).alias("term")
    postings = index.select(_result_doc(), term, "tf_idf")
    wanted = _wanted(queries, query_id, text)
    if _size(wanted) > broadcast_bytes:
        path = scratch_path(spark, "postings")
        settle(postings, path)
        return scored_in_cells(spark, path, wanted, query_id)
    # Not a semi join, which would be moved below the counting of the index.
    hits = postings.join(F.broadcast(wanted.select("term").distinct()), "term")
    return scored_by_document(settle(hits, scratch_path(spark, "hits")), wanted, query_id)


def tasks_of(sizes: DataFrame, wanted: DataFrame) -> int:
    """In how many tasks postings meet query terms, so that none has many pairs to add up.
    ``sizes`` has the number ``n`` of each term's postings."""
    asked = wanted.groupBy("term").agg(F.count("*").alias("_asked"))
    pairs = sizes.join(asked, "term").agg(F.sum(F.col("n") * F.col("_asked"))).first()[0] or 0
    least = min(shuffle_width(sizes.sparkSession), 1 + pairs // _LEAST_PAIRS)
    return max(least, 1 + pairs // _TASK_PAIRS)


def _tasks(postings: DataFrame, wanted: DataFrame) -> int:
    return tasks_of(postings.groupBy("term").agg(F.count("*").alias("n")), wanted)


def _score() -> Column:
    return F.sum(F.col("tf_idf") * F.col("times")).alias("score")


def scored_by_document(hits: DataFrame, wanted: DataFrame, query_id: str, tasks: int | None = None) -> DataFrame:
    """Scores of the documents' postings for query terms that can be broadcast. Both
    sides are looked at twice: for the number of tasks if not given, and to be joined."""
    dealt = hits.repartition(tasks or _tasks(hits, wanted), "doc")
    return F.broadcast(wanted).join(dealt, "term").groupBy(query_id, "doc").agg(_score())


def scored_in_cells(
    spark: SparkSession, path: str, wanted: DataFrame, query_id: str, cell_bytes: int = 32 * 1024 * 1024
) -> DataFrame:
    """The same for query terms of any size, and ``(doc, term, tf_idf)`` saved at a path.

    Documents are dealt into rows and queries into columns of a grid. All matches of
    a document and a query arise in one of its cells and are added up there: none is
    moved. A cell's query terms measure about ``cell_bytes`` and are hashed. No term is
    hot, as a cell has each at most once per document and per query.
    """
    asked = scratch_path(spark, "query-terms")
    wanted = settle(wanted, asked)
    tasks = _tasks(spark.read.schema(_POSTINGS).parquet(path), wanted)
    own = session_with(spark, CELL_SETTINGS)
    left, right = own.read.schema(_POSTINGS).parquet(path), own.read.schema(wanted.schema).parquet(asked)
    return scored_in_grid(left, right, query_id, tasks, cell_bytes)


def scored_in_grid(
    postings: DataFrame, wanted: DataFrame, query_id: str, tasks: int, cell_bytes: int = 32 * 1024 * 1024
) -> DataFrame:
    """The same of frames of one session that has ``CELL_SETTINGS``; the query terms
    are looked at twice."""
    columns = 1 + _size(wanted) // cell_bytes
    rows = -(-tasks // columns)

    def placed(df: DataFrame, by: str, count: int, others: int, own_first: bool) -> DataFrame:
        place, other = F.pmod(F.xxhash64(by), F.lit(count)), F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        dealt = df.withColumn("_own", place).withColumn("_other", other)
        row, column = ("_own", "_other") if own_first else ("_other", "_own")
        cell = (F.col(row) * F.lit(columns) + F.col(column)).alias("_cell")
        return dealt.select(*df.columns, cell).repartition(rows * columns, "_cell")

    left = placed(postings, "doc", rows, columns, True)
    right = placed(wanted, query_id, columns, rows, False)
    matches = left.join(right.hint("shuffle_hash"), ["_cell", "term"])
    return matches.groupBy("_cell", query_id, "doc").agg(_score()).drop("_cell")


def _wanted(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """``(query_id, term, times)`` with folded terms."""
    terms = queries.select(query_id, F.explode(query_terms_of(F.col(text))).alias("term"))
    return terms.groupBy(query_id, folded_term(F.col("term")).alias("term")).agg(F.count("*").alias("times"))


def _size(terms: DataFrame) -> int:
    return terms.agg(F.sum(F.octet_length("term") + _ROW_OVERHEAD)).first()[0] or 0


def search_many_texts(
    texts: DataFrame,
    n_docs: int | DataFrame,
    queries: DataFrame,
    query_id: str = "query_id",
    text: str = "query_text",
    broadcast_bytes: int = 32 * 1024 * 1024,
) -> DataFrame:
    """``(query_id, doc, score)`` for a table of queries on ``(doc, text)`` rows that
    have no index: only tokens that some query asks for are ever counted.

    The vocabulary of the queries is broadcast up to ``broadcast_bytes``; beyond
    that the tokens are counted all and the counts joined.
    """
    vocabulary = _wanted(queries, query_id, text).select(F.col("term").alias("_term")).distinct()
    asked = folded_term(F.col("term")) == F.col("_term")
    tokens = tokenize(texts)
    if _size(vocabulary.withColumnRenamed("_term", "term")) <= broadcast_bytes:
        counts = doc_word_count(tokens.join(F.broadcast(vocabulary), asked, "left_semi"))
    else:
        counts = doc_word_count(tokens)
        frequency = counts.groupBy("term").agg(F.count("*").alias("df")).join(vocabulary, asked, "left_semi")
        counts = lookup(counts, frequency, "term", "doc").select("term", "doc", "n")
    return search_many(tf_idf(counts, n_docs), queries, query_id, text, True, broadcast_bytes)


def in_document_order(result: DataFrame) -> DataFrame:
    return result.orderBy("doc")
