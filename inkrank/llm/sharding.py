"""Shards of a corpus by jump consistent hashing.

A row's shard follows from its key and the number of shards alone, without a
table of ring positions: a generator seeded by the key names the shard counts at
which the key would jump, and the last one below the count is its shard. One more
shard thus takes some 1/n of the rows, and no row moves between old shards.

Integer keys seed the generator as they are, so other programs can tell a row's
shard; other keys by their 64-bit hash. A null key counts as key 0.

Within a shard rows stand in the order of (key, size, checksum), nulls first, and
``slot`` is the place there. That order is one range-partitioned sort of short rows
in which the place of a row among its equals is a sort key too, so neither a shard
nor a key, however common, meets in one task; partitions are then numbered by
their sizes.

Edge cases: a null text has no bytes and size 1, as an empty one; rows of equal key
share a shard and have slots of their own; extra columns stay out of ``assign`` and
are all kept by ``write_shards``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkrank.session import scratch_path, settle

LAW = "key"

# Fixed values of jump consistent hashing: the multiplier of its generator, and the
# range of the 31 bits that it draws.
MULTIPLIER = 2862933555777941757
DRAWS = 1 << 31


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key; some log(shards) steps over the whole array."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.int64).view(np.uint64).copy()
    found = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        drawn = state[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
        state[moving] = drawn
        ratio = DRAWS / ((drawn >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        landed = np.floor((found[moving] + 1) * ratio)
        inside = landed < shards
        moving = moving[inside]
        found[moving] = landed[inside].astype(np.int64)
    return found.astype(np.int32)


def _seed(docs: DataFrame, key: str) -> Column:
    kind = dict(docs.dtypes)[key]
    column = F.col(f"`{key}`")
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    seed = column.cast("bigint") if whole else F.when(column.isNotNull(), F.xxhash64(column))
    return F.coalesce(seed, F.lit(0).cast("bigint"))


def _shard(seed: Column, shards: int) -> Column:
    """``(shard, grown_shard)`` of a seed, the latter with one more shard. Only the
    seeds go through Python, in Arrow batches."""

    @F.pandas_udf("shard int, grown_shard int")
    def jumped(seeds: pd.Series) -> pd.DataFrame:
        keys = seeds.to_numpy(np.int64)
        return pd.DataFrame({"shard": jump(keys, shards), "grown_shard": jump(keys, shards + 1)})

    return jumped(seed)


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(<key>, size, text_crc32, law, shard, slot, grown_shard)``, one row per document.

    No text leaves the scan: size and checksum are taken there, and only these
    short rows are sorted.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col(f"`{text}`").cast("string").cast("binary"), F.lit(b""))
    short = docs.select(
        F.col(f"`{key}`").alias("key"),
        (F.octet_length(raw) + 1).cast("bigint").alias("size"),
        F.crc32(raw).alias("crc"),
        _seed(docs, key).alias("seed"),
    )

    def jumped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(3).to_numpy(zero_copy_only=False)
            found = [pa.array(jump(keys, n)) for n in (shards, shards + 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *found], names)

    names = ["key", "size", "crc", "shard", "grown_shard"]
    kind = short.schema["key"].dataType.simpleString()
    # Not the function of a column: texts would wait beside it.
    placed = short.mapInArrow(jumped, f"key {kind}, size long, crc long, shard int, grown_shard int")
    # Written before it is sorted: a task that is run again reads the same rows in the
    # same places.
    placed = settle(placed, scratch_path(spark, "shards")).withColumn("at", F.monotonically_increasing_id())
    order = ["shard", F.col("key").asc_nulls_first(), "size", "crc", "at"]
    ordered = placed.orderBy(*order).drop("at").withColumn("at", F.monotonically_increasing_id())
    ordered = settle(ordered, scratch_path(spark, "shards"))
    # Fixed value: monotonically_increasing_id has the row number in its lower 33 bits.
    part = F.shiftright("at", 33).alias("part")
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    cuts = ordered.groupBy("shard", part).agg(F.count("*").alias("n"), F.min(within).alias("first"))
    below = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition and shard, so at most partitions + shards rows.
    starts = cuts.select("shard", "part", (F.coalesce(F.sum("n").over(below), F.lit(0)) - F.col("first")).alias("shift"))
    slot = (F.col("shift") + within).cast("bigint").alias("slot")
    found = ordered.withColumn("part", part).join(F.broadcast(starts), ["shard", "part"])
    return found.select(
        F.col("key").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        slot,
        "grown_shard",
    )


def write_shards(docs: DataFrame, folder: str, shards: int, key: str = "doc_id") -> DataFrame:
    """Write whole documents to ``folder/shard=<n>`` and return them as read back,
    with the column ``shard``.

    Nothing is shuffled: each task writes its own rows of every shard, so a hot key
    makes no task longer. Documents must have no column ``shard``.
    """
    placed = docs.withColumn("shard", _shard(_seed(docs, key), shards)["shard"])
    placed.write.partitionBy("shard").parquet(folder)
    return docs.sparkSession.read.schema(placed.schema).parquet(folder)


def moved(docs: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """The documents that a further shard would take, whole, with the shard they leave:
    all that has to be written when shard number ``shards`` is appended."""
    placed = docs.withColumn("_to", _shard(_seed(docs, key), shards)).where("_to.grown_shard <> _to.shard")
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_to.shard").alias("old_shard"))
