"""Numbering without one task per key, bounded samples, and code for executors."""

import subprocess
import sys
from pathlib import Path


from inkrank.llm import queries
from inkrank.llm.common import lowest, numbered

REPO = Path(__file__).resolve().parents[2]


def test_numbers_of_a_hot_key(spark):
    rows = [("hot", i % 7, i) for i in range(900)] + [("cold", 1, i) for i in range(5)] + [(None, 2, 3)]
    df = spark.createDataFrame(rows, "key string, a int, b int").repartition(4)
    for salts in (1, 5):
        found = numbered(df, ["key"], ["a", "b"], salts, "rank").where("key is not null").collect()
        for key, size in (("hot", 900), ("cold", 5)):
            assert sorted(r["rank"] for r in found if r.key == key) == list(range(size))


def test_lowest_is_bounded_and_the_same_each_time(spark):
    df = spark.range(50_000).repartition(7)
    first = sorted(r.id for r in lowest(df, ["id"], 300).collect())
    assert len(first) == 300 and first == sorted(r.id for r in lowest(df.repartition(3), ["id"], 300).collect())
    assert lowest(df.where("id < 10"), ["id"], 300).count() == 10
    assert lowest(df.where("id < 0"), ["id"], 300).count() == 0


def test_executors_get_the_code(tmp_path):
    """A program that is not run from the repository, and does not export its path."""
    code = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from inkrank.session import local_session
import __spark_entry__
spark = local_session(2, "elsewhere", **{{"spark.driver.memory": "2g"}})
print(__spark_entry__.queries()["op4_decontamination"](spark, "/root/testdata/sf0.001").count() > 0)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("True"), done.stderr[-2000:]


def test_every_operator_is_registered():
    names = list(queries.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names
