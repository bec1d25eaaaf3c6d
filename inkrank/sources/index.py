"""Saving a TF-IDF index and reading it back, as parquet or as packed text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F

from inkrank.sources.sinks import as_text

# Fixed value: what stands between term and document in the packed text form.
PACK = "#####"


def write_index(index: DataFrame, path: str, overwrite: bool = False) -> None:
    """Save ``(term, doc, tf_idf)`` as parquet that a search by term can skip through.

    Rows are range-partitioned by term and document, so a term's rows lie in few
    files and row groups, while a term that has a large share of all rows still
    spreads over many. Each row group has a Bloom filter of its terms besides.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    ordered = index.withColumn("term", F.lower("term")).repartitionByRange("term", "doc")
    with_filters(ordered.sortWithinPartitions("term", "doc").write.mode(mode), "term").parquet(path)


def with_filters(writer: DataFrameWriter, column: str) -> DataFrameWriter:
    """Give each row group a Bloom filter of a column, so that a search for a value
    skips those without it even where the ranges of many files overlap, as those of
    batches do. The filter's size follows the number of different values."""
    writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A saved index; its terms are lower-case."""
    return spark.read.parquet(path)


def write_packed(postings: DataFrame, path: str, overwrite: bool = False) -> None:
    """Text lines ``term#####doc<TAB>value`` for ``(term, doc, value)`` postings,
    ordered by key within each file."""
    term, doc, value = postings.columns
    key = F.concat(as_text(F.col(term)), F.lit(PACK), as_text(F.col(doc)))
    rows = postings.select(key.alias("key"), as_text(F.col(value)).alias("value"))
    lines = rows.sortWithinPartitions("key").select(F.concat_ws("\t", "key", "value"))
    lines.write.mode("overwrite" if overwrite else "errorifexists").text(path)


def read_packed(spark: SparkSession, path: str, value: str = "tf_idf") -> DataFrame:
    """Read packed text. The split is at the last mark, so a term may end in ``#``.

    A line is cut at its last tab and there at the last mark, counted from the right:
    a pattern would go through the line once for each column and step back for each
    mark. A line without a tab or a mark is no posting: empty names and no value.
    """
    line = F.col("value")
    number = F.substring_index(line, "\t", -1)
    lines = spark.read.text(path).select(line, number.alias("_number"))
    key = F.left(line, F.char_length(line) - F.char_length("_number") - 1)
    keys = lines.select(F.when(F.contains(line, F.lit("\t")), key).alias("_key"), "_number")
    keys = keys.withColumn("_found", F.coalesce(F.contains("_key", F.lit(PACK)), F.lit(False)))
    parts = keys.withColumn("_doc", F.substring_index("_key", PACK, -1))
    term = F.left("_key", F.char_length("_key") - F.char_length("_doc") - len(PACK))
    return parts.select(
        F.when(F.col("_found"), term).otherwise("").alias("term"),
        F.when(F.col("_found"), F.col("_doc")).otherwise("").alias("doc"),
        F.when(F.col("_found"), F.col("_number").cast("double")).alias(value),
    )


def packed_order(spark: SparkSession, path: str) -> DataFrame:
    """``(ordered, n_lines)``: how many lines of packed text have a key that is not less
    than the one before it in its file.

    A task reads pieces of files from front to back and compares neighbours where they
    are. Only the ends of each piece are moved, to be compared with the next piece.
    """
    meta, line = F.col("_metadata"), F.col("value")
    key = F.left(line, F.char_length(line) - F.char_length(F.substring_index(line, "\t", -1)) - 1)
    # A file's name as two hashes: its path with each line would outweigh the keys.
    lines = spark.read.text(path).select(
        F.when(F.contains(line, F.lit("\t")), key).otherwise("").alias("key"),
        F.xxhash64(meta.file_path).alias("file"),
        F.hash(meta.file_path).alias("more"),
        meta.file_block_start.alias("block"),
    )
    pieces = lines.mapInArrow(_pieces, "file long, more int, block long, first string, last string, kept long, broken long")
    # As many rows as pieces; a block without lines has none and is stepped over.
    before = F.lag("last").over(Window.partitionBy("file", "more").orderBy("block"))
    joined = (F.coalesce(before, F.lit("")) <= F.col("first")).alias("joined")
    pieces = pieces.select("kept", "broken", joined)
    kept, broken = F.col("kept") + F.col("joined").cast("long"), F.col("broken") + (~F.col("joined")).cast("long")
    by_order = [F.struct(F.lit(order).alias("ordered"), n.alias("n")) for order, n in ((True, kept), (False, broken))]
    counted = pieces.select(F.explode(F.array(*by_order)).alias("x"))
    whole = counted.groupBy(F.col("x.ordered").alias("ordered")).agg(F.sum("x.n").alias("n_lines"))
    return whole.where("n_lines > 0")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per piece of a file: its ends and its pairs of neighbours in and out of order."""
    piece = None
    for batch in batches:
        key, *place = batch.columns
        n = batch.num_rows
        if not n:
            continue
        key = key.cast(pa.large_binary())
        same = reduce(pc.and_, [pc.equal(part[1:], part[:-1]) for part in place])
        ordered = pc.less_equal(key[:-1], key[1:])
        starts = [0, *(pc.indices_nonzero(pc.invert(same)).to_numpy() + 1).tolist()]
        for start, end in zip(starts, [*starts[1:], n], strict=True):
            at = [part[start].as_py() for part in place]
            first, last = key[start].as_py(), key[end - 1].as_py()
            kept = pc.sum(ordered[start : end - 1]).as_py() or 0
            counts = [kept, end - 1 - start - kept]
            if piece and piece[0] == at:
                counts[piece[2] > first] += 1
                piece[2] = last
                piece[3] = [a + b for a, b in zip(piece[3], counts, strict=True)]
                continue
            if piece:
                yield _piece_row(piece)
            piece = [at, first, last, counts]
    if piece:
        yield _piece_row(piece)


def _piece_row(piece: list) -> pa.RecordBatch:
    place, first, last, counts = piece
    values = [*place, first.decode(), last.decode(), *counts]
    names = ("file", "more", "block", "first", "last", "kept", "broken")
    types = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, types, strict=True)], names)
