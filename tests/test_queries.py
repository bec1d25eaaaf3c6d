"""Every registered query against its SQL, and what the plans must not hold."""

import builtins

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from compare import oracle_rows, same_rows, spark_rows

QUERIES = registered.own_queries()
ORACLE = registered.oracle_sql()


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(ORACLE)


def test_entry(spark):
    result = registered.entry(spark)
    assert result.columns == ["doc", "score"]
    assert result.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, small, plan, name):
    df = QUERIES[name](spark, small)
    names, rows = spark_rows(df)
    oracle_names, expected = oracle_rows(ORACLE[name], small)
    assert names == oracle_names
    assert rows
    assert same_rows(rows, expected)
    text = plan(df)
    for unwanted in ("CartesianProduct", "NestedLoop", "Python", "ArrowEval"):
        assert unwanted not in text


def hot_tables(spark, folder):
    """A third of the documents in one source, a third of the line items of one supplier."""
    rows = spark.range(6000)
    hot = F.col("id") % 3 == 0
    documents = rows.select(
        F.col("id").alias("doc_id"), F.lit("the cat").alias("text"),
        F.when(hot, F.lit("src0")).otherwise(F.concat(F.lit("src"), F.col("id") % 40)).alias("source"),
    )
    documents.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    items = rows.select(
        F.when(hot, F.lit(0)).otherwise(F.col("id")).cast("bigint").alias("l_suppkey"),
        (F.col("id") % 50).alias("l_partkey"), F.col("id").alias("l_orderkey"),
    )
    items.write.parquet(f"{folder}/lineitem.parquet")


def test_a_hot_source_is_several_files_and_a_hub_several_lines(spark, tmp_path):
    hot_tables(spark, str(tmp_path))
    files = spark.read.text(registered._corpus_files(spark, str(tmp_path)))
    sizes = files.groupBy(F.col("_metadata.file_path").alias("file")).count().collect()
    assert len([row for row in sizes if row.file.endswith("/src0")]) == 8
    assert max(row["count"] for row in sizes) <= registered.DOCS_PER_FOLDER
    lines = registered._hub_lines(spark, str(tmp_path)).where("line like '%<title>S0<%'")
    links = lines.select((F.size(F.split("line", r"\[\[P")) - 1).alias("n")).collect()
    assert len(links) == 6 and sum(row.n for row in links) == 2000
    edges = {(row.src, row.dst): row.n for row in QUERIES["wiki_hub_edges"](spark, str(tmp_path)).collect()}
    assert sum(edges.values()) == 6000 and edges["S0", "P0"] == 40


def test_only_a_missing_llm_folder_is_passed_over(monkeypatch):
    def missing(name):
        def load(module, *args, **kwargs):
            if module.startswith("inkrank.llm"):
                raise ModuleNotFoundError(name=name)
            return real(module, *args, **kwargs)

        return load

    real = builtins.__import__
    monkeypatch.setattr(builtins, "__import__", missing("inkrank.llm"))
    assert set(registered.queries()) == set(QUERIES)
    monkeypatch.setattr(builtins, "__import__", missing("zstandard"))
    with pytest.raises(ModuleNotFoundError):
        registered.queries()
