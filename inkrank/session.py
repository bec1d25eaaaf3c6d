"""Sessions, the shared scratch folder, and how widely a scan is spread."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Fewest cores per split from which a scan is rebalanced.
_SPREAD = 2


def local_session(cores: int | str = "*", name: str = "inkrank", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    partitions = "8" if cores == "*" else str(cores)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": partitions,
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a temporary folder. On a
    cluster a machine-local folder would be lost with its machine, so a missing
    setting is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="inkrank-"))
    return context.getCheckpointDir()


#: Scratch paths that this program has given out, by application.
_given: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses.

    What is written there backs frames that are still to be read, so it stays
    until ``drop_scratch``, or until the program ends with the session running.
    """
    path = f"{checkpoint_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    own = _given.setdefault(spark.sparkContext.applicationId, [])
    if not own:
        atexit.register(_drop_at_exit, spark)
    own.append(path)
    return path


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables; frames that read them can no longer be used."""
    for path in _given.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def _drop_at_exit(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        drop_scratch(spark)


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder of its own in the shared folder, removed when the block ends."""
    folder = f"{checkpoint_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        _delete(spark, folder)


def settle(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a new path in the shared folder and read it back.

    The result has no lineage, so a lost executor costs a re-read rather than a
    recomputation. Unlike ``checkpoint()`` it is compressed and columnar, which
    matters for the large tables.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a scan that has far fewer splits than the cluster has cores.

    Parsing text is CPU-bound, so a few unsplittable files (one parquet row
    group, gzip) would leave most cores idle. A scan that keeps one core in
    ``_SPREAD`` busy passes through: moving the raw text would cost more than the
    idle cores. Select the columns in use before.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * _SPREAD > cores:
        return df
    return df.repartition(cores)


def session_with(spark: SparkSession, settings: dict[str, object]) -> SparkSession:
    """A session beside ``spark`` that differs in some settings only.

    It shares the context and the cache. Changing a setting of ``spark`` itself
    would change what other threads plan meanwhile.
    """
    other = spark.newSession()
    for row in spark.sql("SET").collect():
        if row.key.startswith("spark.sql.") and spark.conf.isModifiable(row.key):
            other.conf.set(row.key, row.value)
    for name, value in settings.items():
        other.conf.set(name, str(value))
    return other


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
