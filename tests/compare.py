"""Run registered queries in Spark and their SQL in DuckDB and compare."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    arrow = con.sql(sql).to_arrow_table()
    names = sorted(arrow.column_names)
    columns = [arrow.column(name).to_pylist() for name in names]
    return names, sorted(zip(*columns), key=repr)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(row) for row in df.select(*names).collect()]
    return names, sorted(rows, key=repr)


def same_rows(left: list[tuple], right: list[tuple]) -> bool:
    if len(left) != len(right):
        return False
    return all(same_cell(a, b) for x, y in zip(left, right) for a, b in zip(x, y))


def same_cell(a, b) -> bool:
    return type(a) is type(b) and a == b
