"""Queries of whole tables against their SQL."""

import pytest

from compare import oracle_rows, same_rows, spark_rows
from inkrank.llm import queries


@pytest.mark.parametrize("name", ["op1_suffix_array", "op4_decontamination", "op8_debruijn"])
def test_query_equals_sql(spark, medium, name):
    names, rows = spark_rows(queries.queries()[name](spark, medium))
    oracle_names, expected = oracle_rows(queries.oracle_sql()[name], medium)
    assert names == oracle_names
    assert rows and any(row[names.index("n_hit" if "n_hit" in names else "n_removed")] for row in rows)
    assert same_rows(rows, expected)
