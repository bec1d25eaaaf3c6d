"""Text sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def write_tsv(
    df: DataFrame,
    path: str,
    overwrite: bool = False,
    key_order: Sequence[str] = (),
) -> None:
    """Tab-separated lines; an existing target is an error unless ``overwrite``.

    Not the CSV writer, which would trim and quote tokens made of blanks or
    quotes. ``key_order`` orders the rows within each file.
    """
    if key_order:
        df = df.sortWithinPartitions(*key_order)
    line = F.concat_ws("\t", *[as_text(F.col(name)) for name in df.columns])
    df.select(line).write.mode("overwrite" if overwrite else "errorifexists").text(path)
