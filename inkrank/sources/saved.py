"""Saved tables: bucketed parquet at a path, and the notes that commit it.

A note is a small JSON file that is written behind a table, under its final name at
once. A table whose note is missing was never finished, whatever files it has.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """Write a note beside its table; an earlier one of the name is replaced."""
    draft, files = _file_system(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = files.create(draft)
    out.write(json.dumps(note).encode())
    out.close()
    target, _ = _file_system(spark, path)
    files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"cannot write {path}")


def read_note(spark: SparkSession, path: str) -> dict | None:
    """A note, or None where there is none."""
    target, files = _file_system(spark, path)
    if not files.exists(target):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def names_in(spark: SparkSession, pattern: str) -> list[str]:
    """Base names of the files and folders that a glob finds, in order."""
    target, files = _file_system(spark, pattern)
    return sorted(status.getPath().getName() for status in files.globStatus(target) or [])


#: A session with these settings writes the rows of a task in the order they have.
IN_ORDER = {"spark.sql.maxConcurrentOutputFileWriters": 2}

#: A session with these settings takes buckets of one file each to be in order.
BY_ORDER = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, in_order: bool = False) -> None:
    """Write ``df`` in files of which each holds one bucket of ``key``, in order.

    If ``df`` comes out of a shuffle by the key into as many partitions, each task
    writes the one file of its bucket. ``in_order`` states that tasks have their rows in
    order and the session is ``IN_ORDER``. The writer's own sort compares buckets
    first, so all rows of a task look alike until their keys are read in full.
    """
    name = f"inkrank_{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").bucketBy(buckets, key)
    if not in_order:
        writer = writer.sortBy(key)
    writer.option("path", path).saveAsTable(name)
    # The table is external: its files stay.
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int, schema: str) -> DataFrame:
    """A bucketed table of another session or program, with its partitioning known:
    a join or grouping by the key moves none of its rows, and sorts none if the
    session goes ``BY_ORDER``."""
    name = f"inkrank_{uuid.uuid4().hex}"
    place = path.replace("'", "\\'")
    layout = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet {layout} LOCATION '{place}'")
    table = spark.table(name)
    # The frame knows its files by now; only the catalog forgets them.
    spark.sql(f"DROP TABLE {name}")
    return table
