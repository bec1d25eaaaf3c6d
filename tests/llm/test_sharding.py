"""Jump consistent hashing against the published loop, its law, slots, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import oracle_rows, same_rows, spark_rows
from inkrank.llm import queries, sharding


def plain_jump(key, shards):
    """One key, in Python integers."""
    state, at, landed = key % 2**64, -1, 0
    while landed < shards:
        at = landed
        state = (state * 2862933555777941757 + 1) % 2**64
        landed = int((at + 1) * (2**31 / ((state >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 1000])
def test_jump_equals_the_loop(shards):
    keys = np.array([0, 1, 2, 3, 255, 10**12, -1, -(2**63), 2**63 - 1, *range(5000, 5200)], np.int64)
    assert sharding.jump(keys, shards).tolist() == [plain_jump(int(k), shards) for k in keys]


@pytest.mark.parametrize("stride", [1, 2, 50, 1024, 1 << 20, 1 << 40])
def test_jump_is_even_and_moves_only_into_the_new_shard(stride):
    keys = np.arange(80_000, dtype=np.int64) * stride
    now, grown = sharding.jump(keys, 8), sharding.jump(keys, 9)
    assert np.abs(np.bincount(now, minlength=8) - 10_000).max() < 500
    assert set(grown[now != grown]) == {8}
    assert abs((now != grown).mean() - 1 / 9) < 0.01


def test_no_shard_is_an_error():
    with pytest.raises(ValueError):
        sharding.jump(np.zeros(1, np.int64), 0)


@pytest.mark.parametrize("size", ["small", "medium"])
def test_query_equals_sql(spark, request, size):
    sf_dir = request.getfixturevalue(size)
    names, rows = spark_rows(queries.queries()["op11_jump_shards"](spark, sf_dir))
    oracle_names, expected = oracle_rows(queries.oracle_sql()["op11_jump_shards"], sf_dir)
    assert names == oracle_names and rows and same_rows(rows, expected)


def test_odd_rows(spark, documents):
    texts = [None, "", "x" * 300_000, "é \n", "same", "same"]
    docs = documents([*enumerate(texts), (None, "a"), (None, None), (4, "same"), (4, "other"), (-7, "minus")])
    docs = docs.withColumns({name: F.lit(1) for name in ("shard", "slot", "key", "seed", "crc", "law")})
    rows = sharding.assign(docs, 8).collect()
    assert len(rows) == 11
    expected = {i: t for i, t in enumerate(texts) if i < 4}
    for row in rows:
        assert row.shard == plain_jump(row.doc_id or 0, 8) and row.grown_shard == plain_jump(row.doc_id or 0, 9)
        if row.doc_id in expected:
            raw = (expected[row.doc_id] or "").encode()
            assert (row["size"], row.text_crc32, row.law) == (len(raw) + 1, zlib.crc32(raw), "key")
    for shard in {row.shard for row in rows}:
        ordered = sorted((row for row in rows if row.shard == shard), key=lambda row: row.slot)
        assert [row.slot for row in ordered] == list(range(len(ordered)))
        keys = [(row.doc_id is not None, row.doc_id or 0, row["size"], row.text_crc32) for row in ordered]
        assert keys == sorted(keys)
    assert sharding.assign(documents([]), 8).count() == 0


def test_a_common_key_is_spread(spark):
    """A third of the rows are one document, copied."""
    docs = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text")
    )
    rows = sharding.assign(docs.repartition(4), 8)
    found = rows.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m"))
    for row in found.collect():
        assert row.n == row.d == row.m + 1
    ranges = spark.read.parquet(*sorted(_written(rows)))
    parts = ranges.groupBy(F.shiftright("at", 33).alias("part")).count().collect()
    assert len(parts) == 1 or max(p["count"] for p in parts) < 15_000


def _written(df):
    return [path for path in df.inputFiles()]


def test_other_keys(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", None), (None, "y"), ("a", "z")], "name string, body string")
    rows = sharding.assign(docs, 5, key="name", text="body").collect()
    assert {row.name for row in rows} == {"a", "b", None}
    assert len({row.shard for row in rows if row.name == "a"}) == 1


def test_written_shards_and_what_a_further_one_takes(spark, documents, tmp_path):
    docs = documents([f"text {i}" for i in range(200)])
    back = sharding.write_shards(docs, str(tmp_path / "eight"), 8)
    assert sorted(map(tuple, back.drop("shard").collect())) == sorted(map(tuple, docs.collect()))
    assert all(row.shard == plain_jump(row.doc_id, 8) for row in back.collect())
    moved = sharding.moved(docs, 8).collect()
    assert {row.doc_id for row in moved} == {i for i in range(200) if plain_jump(i, 8) != plain_jump(i, 9)}
    assert all(row.old_shard == plain_jump(row.doc_id, 8) and row.text for row in moved)
