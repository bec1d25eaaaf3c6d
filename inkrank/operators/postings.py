"""From texts to counted and weighted postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkrank.functions.text import inverse_frequency, log_weight, pieces_of, tokens_of
from inkrank.operators.scalars import scalar
from inkrank.session import shuffle_width

# Bytes a row of the broadcast document frequencies needs beside its term.
_ROW_OVERHEAD = 32


def tokenize(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row per token: the other columns of ``texts`` and ``term``."""
    others = [F.col(name) for name in texts.columns if name != text]
    pieces = texts.select(*others, F.explode(pieces_of(F.col(text))).alias(text))
    return pieces.select(*others, F.explode(tokens_of(F.col(text))).alias("term")).where("term != ''")


def doc_word_count(tokens: DataFrame) -> DataFrame:
    """``(term, doc, n)``; pre-aggregated in the map tasks, one shuffle."""
    return tokens.groupBy("term", "doc").agg(F.count("*").alias("n"))


def term_frequency(counts: DataFrame) -> DataFrame:
    """``(term, doc, tf)`` with the logarithmic weight."""
    return counts.select("term", "doc", log_weight(F.col("n")).alias("tf"))


def doc_frequency(counts: DataFrame, n_docs: int | DataFrame) -> DataFrame:
    """``(term, df, idf)``; counts hold each (term, document) once."""
    frequency = counts.groupBy("term").agg(F.count("*").alias("df"))
    return frequency.withColumn("idf", inverse_frequency(scalar(n_docs), F.col("df")))


def _posting_score(n_docs: int | DataFrame, weight: Column | None = None) -> Column:
    idf = inverse_frequency(scalar(n_docs), F.col("df"))
    return (idf * (log_weight(F.col("n")) if weight is None else weight)).alias("tf_idf")


def tf_idf_of_terms(counts: DataFrame, n_docs: int | DataFrame, terms: list[str]) -> DataFrame:
    """``(term, doc, tf_idf)`` of the given terms only.

    A term's weights depend on its own postings alone, so the filter goes below
    the counting and the broadcast has at most one row per given term.
    """
    wanted = counts.where(F.col("term").isin(terms))
    frequency = wanted.groupBy("term").agg(F.count_if(F.col("n") > 0).alias("df"))
    return wanted.join(F.broadcast(frequency), "term").select("term", "doc", _posting_score(n_docs))


def tf_idf(
    counts: DataFrame, n_docs: int | DataFrame, broadcast_bytes: int = 32 * 1024 * 1024
) -> DataFrame:
    """The index ``(term, doc, tf_idf)``.

    The document frequencies of the frequent terms are broadcast and the others
    joined by a shuffle. With W the bytes a full copy of the frequencies onto
    all postings would take, terms of df >= W / broadcast_bytes count as
    frequent: together these need at most ``broadcast_bytes``, whatever the
    vocabulary. They own most postings of natural text, which so stay where
    they are, and no term left for the shuffle is large enough to skew it.
    """
    return _index(counts, "n", _posting_score(n_docs), broadcast_bytes)


def tf_idf_of_weights(
    weights: DataFrame, n_docs: int | DataFrame, broadcast_bytes: int = 32 * 1024 * 1024
) -> DataFrame:
    """The same index from the saved output of ``term_frequency``, ``(term, doc, tf)``:
    the weights are taken as they are and no text is looked at again."""
    return _index(weights, "tf", _posting_score(n_docs, F.col("tf")), broadcast_bytes)


def _index(postings: DataFrame, value: str, score: Column, broadcast_bytes: int) -> DataFrame:
    # Counting through the value lets all uses below share the one shuffle of the counts.
    frequency = postings.groupBy("term").agg(F.count_if(F.col(value) > 0).alias("df"))
    row_bytes = F.octet_length("term") + _ROW_OVERHEAD
    copied = frequency.agg(F.sum(F.col("df") * row_bytes).cast("double").alias("bytes"))
    share = F.col("df") * F.lit(float(broadcast_bytes))
    frequent = frequency.where(share >= scalar(copied))
    rare = frequency.where(share < scalar(copied))

    near = postings.join(F.broadcast(frequent), "term").select("term", "doc", score)
    # An anti join would be moved below the counting and repeat the tokenizing.
    rest = postings.join(F.broadcast(frequent), "term", "left").where("df IS NULL").drop("df")
    far = rest.join(rare, "term").select("term", "doc", score)
    return near.unionByName(far)


def tf_idf_window(counts: DataFrame, n_docs: int | DataFrame, buckets: int | None = None) -> DataFrame:
    """The same index with the document frequency taken by a window.

    A window over all postings of a term would put a stop word into one task.
    Postings are therefore counted by (term, bucket of the document) first; the
    window adds up at most ``buckets`` rows per term, and its result goes back
    to the postings of that term and bucket.
    """
    buckets = buckets or shuffle_width(counts.sparkSession)
    # Never null, and said so: a null check on one use alone would part it from the other.
    bucket = F.coalesce(F.pmod(F.xxhash64("doc"), F.lit(buckets)), F.lit(0))
    placed = counts.withColumn("bucket", bucket)
    partial = placed.groupBy("term", "bucket").agg(F.count_if(F.col("n") > 0).alias("part"))
    whole_term = Window.partitionBy("term")
    frequency = partial.select("term", "bucket", F.sum("part").over(whole_term).alias("df"))
    return placed.join(frequency, ["term", "bucket"]).select("term", "doc", _posting_score(n_docs))
