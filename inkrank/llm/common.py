"""What the operators of this subpackage share: texts in, batches, rank offsets."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import inkrank
from inkrank.session import checkpoint_folder

# A task holds about this much text at a time, besides its largest single text.
BATCH_BYTES = 4 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` would, once per
    application; their Python need not have it installed."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(inkrank.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    # Not a scratch path: executors that start later still fetch it.
    path = f"{checkpoint_folder(spark).rstrip('/')}/code-{application}/inkrank.zip"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(packed.getvalue())
    out.close()
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def shared_files(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that driver and executors share."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("file:///", "file:/").replace("file:/", "file:///"))


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` of any table; a null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))


def sliced(
    batches: Iterator[pa.RecordBatch], text_at: int = 1, size: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        parts = max(1, -(-batch.column(text_at).nbytes // size))
        step = -(-rows // parts)
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def lowest(df: DataFrame, keys: list[str], count: int) -> DataFrame:
    """About ``count`` rows, never more: those whose keys hash lowest.

    Rows beyond a cut that leaves a few more than wanted are dropped where they
    are read, so that tasks do not each hand on ``count`` rows to be sorted.
    """
    total = df.count()
    share = min(1.0, (1.2 * count + 100) / max(1, total))
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << 30))
    return df.where(place < int(share * (1 << 30))).orderBy(place, *keys).limit(count)


def numbered(df: DataFrame, keys: list[str], order: list[str], salts: int, name: str) -> DataFrame:
    """Number the rows of each key from 0 without bringing a key into one task.

    Rows are dealt into salts by their order columns, numbered within (key,
    salt), and shifted by the number of rows that the key has in lower salts.
    That table of counts has at most keys x salts rows.
    """
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    local = Window.partitionBy(*keys, "_salt").orderBy(*order)
    dealt = dealt.withColumn("_local", F.row_number().over(local) - 1)
    counts = dealt.groupBy(*keys, "_salt").agg(F.count("*").alias("_n"))
    below = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*keys, "_salt", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_shift"))
    placed = dealt.join(shifts, [*keys, "_salt"])
    rank = (F.col("_shift") + F.col("_local")).cast("bigint").alias(name)
    return placed.select(*df.columns, rank)
