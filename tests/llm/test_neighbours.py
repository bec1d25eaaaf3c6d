"""Graph search against brute force, and the query's edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkrank.llm import neighbours, queries

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, nearest=5):
    some = {}
    for vec_id, x in rows:
        if vec_id is None or x is None or not len(x) or any(v is None or not np.isfinite(v) for v in x) or not any(x):
            continue
        some[vec_id, tuple(x)] = np.array(x, float)
    out = {}
    for (own, key), q in some.items():
        if own % 50:
            continue
        found = sorted(
            (-float(q @ v / np.sqrt((q @ q) * (v @ v))), other)
            for (other, k), v in some.items()
            if other != own and len(k) == len(key)
        )
        out[own] = found[:nearest]
    return out


def run(spark, path, rows):
    table = spark.createDataFrame([(i, x, 0) for i, x in rows], ROWS).repartition(3)
    table.withColumn("vector", F.lit("clash")).withColumn("id", F.lit(1)).write.parquet(f"{path}/embeddings.parquet")
    found = {}
    for row in sorted(queries.op6_nearest_neighbours(spark, str(path)).collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    for rows in found.values():
        assert [r for r, _, _ in rows] == list(range(1, len(rows) + 1))
    return found


def test_few_vectors_are_found_exactly(spark, tmp_path):
    rng = np.random.default_rng(2)
    make = lambda d: rng.normal(size=d).astype(np.float32).tolist()
    rows = [(i, make(8)) for i in range(120)] + [(200 + i, make(3)) for i in range(3)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, rows[0][1]), (302, rows[0][1]), (350, rows[7][1])]
    rows += [(400, None), (450, []), (500, [0.0] * 8), (550, [None] + [1.0] * 7), (600, [float("nan")] + [1.0] * 7)]
    rows += [(650, [float("inf")] + [1.0] * 7), (None, make(8)), (700, [1e-30] * 8), (750, [1e30, -1e30] * 4), (800, make(5))]
    found, expected = run(spark, tmp_path, rows), brute(rows)
    expected = {k: v for k, v in expected.items() if v}
    assert set(found) == set(expected)
    for own, rows in expected.items():
        assert np.allclose([s for _, _, s in found[own]], [-s for s, _ in rows], atol=1e-12)
        scores = [round(-s, 9) for s, _ in rows]
        if len(set(scores)) == len(scores) or own in (0, 300):
            assert [v for _, v, _ in found[own]] == [v for _, v in rows]


def test_recall_over_several_shards(spark, medium):
    table = spark.read.parquet(f"{medium}/embeddings.parquet")
    index = neighbours.build_index(table, shard_rows=100)
    assert index.count() >= 4
    found = neighbours.search(index, table.where("vec_id % 50 = 0"), width=24, block_rows=3).collect()
    expected = brute([(r.vec_id, r.embedding) for r in table.collect()])
    right = sum(row.vec_id in {v for _, v in expected[row.query_id]} for row in found)
    assert len(found) == sum(map(len, expected.values()))
    assert right >= 0.95 * len(found)


def test_recall_of_one_larger_graph():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 24))
    x = centres[rng.integers(0, 30, 3000)] + 0.4 * rng.normal(size=(3000, 24))
    graph = neighbours.build(x)
    unit = neighbours.units(x)
    nearest = np.argsort(-(unit[::50] @ unit.T), axis=1, kind="stable")[:, :6]
    hits = [
        len(set(row.tolist()) & set(graph.search(q, neighbours.SEARCH_WIDTH)[:6]))
        for q, row in zip(unit[::50], nearest, strict=True)
    ]
    assert np.mean(hits) >= 0.9 * 6


def test_many_equal_vectors(spark, tmp_path):
    same = [0.5, -0.25, 1.0, 0.0]
    rows = [(i, same) for i in range(400)] + [(1000 + i, [1.0, float(i), 0.0, 2.0]) for i in range(60)]
    found = run(spark, tmp_path, rows)
    for own in (0, 50, 350):
        assert [v for _, v, _ in found[own]] == [i for i in range(6) if i != own][:5]
        assert all(abs(s - 1) < 1e-12 for _, _, s in found[own])


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_nothing_to_find(spark, tmp_path, rows):
    assert run(spark, tmp_path, rows) == {}
