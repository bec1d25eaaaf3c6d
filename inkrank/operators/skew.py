"""Joins on keys of which one may hold a large share of all rows.

A key's rows are dealt into numbered cells so that no task gets more than about
its share; the other side's rows of that key are repeated for each cell. Only
keys above the fair share get more than one cell, and their number is bounded by
the number of shares. The table of cells is keyed by a 64-bit hash,
so its size in bytes is bounded too; two keys of equal hash merely share a cell
count, which both sides of a join see alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkrank.operators.scalars import scalar
from inkrank.session import shuffle_width

_SLOT = "_slot"

# Shares per task: cells smaller than a task's share even out better.
_GRAIN = 4

#: A cell has at least about this many rows, or, where two sides meet, pairs: below
#: it a task is short however many there are, and copies would only cost.
CELL_ROWS = 10_000
CELL_PAIRS = 1_000_000


def hot_keys(
    sizes: DataFrame, key: str, rows: str, width: int | None = None, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``(_slot, cells)`` of the keys that exceed a fair share of all rows.

    ``sizes`` has one row per key with its number of ``rows``; fewer than
    ``width`` keys can exceed the sum divided by ``width``, which is by default
    a small multiple of the shuffle partitions. No key gets more cells than it
    can fill with ``cell_rows`` rows.
    """
    width = width or _GRAIN * shuffle_width(sizes.sparkSession)
    total = sizes.agg(F.sum(F.col(rows).cast("double")).alias("total"))
    by_slot = sizes.groupBy(F.xxhash64(key).alias(_SLOT)).agg(
        F.sum(F.col(rows).cast("double")).alias("_rows")
    )
    share = F.least(F.col("_rows") * width / scalar(total), F.col("_rows") / cell_rows)
    shares = by_slot.select(_SLOT, share.alias("_shares"))
    return shares.where("_shares > 1").select(_SLOT, F.ceil("_shares").cast("int").alias("cells"))


def _with_cells(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    # Fewer rows than shares, of 12 bytes each: see hot_keys.
    return df.withColumn(_SLOT, F.xxhash64(key)).join(F.broadcast(hot), _SLOT, "left").drop(_SLOT)


def deal(df: DataFrame, key: str, by: str | Column, hot: DataFrame, cell: str = "cell") -> DataFrame:
    """Give each row the one cell its ``by`` column hashes to."""
    by = F.col(by) if isinstance(by, str) else by
    place = F.pmod(F.xxhash64(by), F.coalesce("cells", F.lit(1))).cast("int")
    dealt = _with_cells(df, key, hot).withColumn(cell, F.coalesce(place, F.lit(0)))
    return dealt.drop("cells")


def repeat(df: DataFrame, key: str, hot: DataFrame, cell: str = "cell") -> DataFrame:
    """Give each row all cells of its key, one copy for each."""
    all_cells = F.sequence(F.lit(0), F.coalesce("cells", F.lit(1)) - 1)
    return _with_cells(df, key, hot).withColumn(cell, F.explode(all_cells)).drop("cells")


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    by: str,
    how: str = "inner",
    hot: DataFrame | None = None,
    width: int | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Join ``rows`` to ``table``, which holds each key once; ``rows`` may be skewed.

    ``hot`` can be given if the hot keys of ``rows`` are known.
    """
    if hot is None:
        sizes = rows.groupBy(key).agg(F.count("*").alias("_n"))
        hot = hot_keys(sizes, key, "_n", width, cell_rows)
    dealt = deal(rows, key, by, hot)
    return dealt.join(repeat(table, key, hot), [key, "cell"], how).drop("cell")


def grids(
    left_sizes: DataFrame, right_sizes: DataFrame, key: str, width: int, cell_pairs: int = CELL_PAIRS
) -> DataFrame:
    """``(_slot, rows, columns)`` of the keys that get a grid of more than one cell.

    A key has as many cells as its share of all pairs deserves, and no more than
    it can fill with ``cell_pairs`` pairs. The left side is cut into rows and the
    right into columns; the larger side is cut more, by the square root of its
    ratio to the other, because each row is a copy of the right side and each
    column a copy of the left.
    """
    sides = []
    for sizes, name in ((left_sizes, "_l"), (right_sizes, "_r")):
        sides.append(sizes.groupBy(F.xxhash64(key).alias(_SLOT)).agg(F.sum(F.col("_n").cast("double")).alias(name)))
    both = sides[0].join(sides[1], _SLOT).withColumn("_pairs", F.col("_l") * F.col("_r"))
    total = both.agg(F.sum("_pairs").alias("total"))
    cells = F.least(F.col("_pairs") * width / scalar(total), F.col("_pairs") / cell_pairs)
    hot = both.withColumn("_cells", cells).where("_cells > 1")
    rows = F.ceil(F.greatest(F.lit(1.0), F.least(F.col("_cells"), F.sqrt(F.col("_cells") * F.col("_l") / F.col("_r")))))
    hot = hot.withColumn("rows", rows.cast("int"))
    return hot.select(_SLOT, "rows", F.ceil(F.col("_cells") / F.col("rows")).cast("int").alias("columns"))


def _in_grid(df: DataFrame, key: str, hot: DataFrame, by: str, own: str, other: str) -> DataFrame:
    """Each row in the one cell of ``own`` that ``by`` hashes to, in all of ``other``."""
    # Fewer rows than cells, of 16 bytes each: see grids.
    placed = df.withColumn(_SLOT, F.xxhash64(key)).join(F.broadcast(hot), _SLOT, "left").drop(_SLOT)
    place = F.pmod(F.xxhash64(by), F.coalesce(own, F.lit(1))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
    placed = placed.withColumn(f"_{own}", F.coalesce(place, F.lit(0))).withColumn(f"_{other}", every)
    return placed.drop("rows", "columns")


def in_grids(
    left: DataFrame, right: DataFrame, key: str, left_by: str, right_by: str, width: int | None = None,
    cell_pairs: int = CELL_PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_rows`` and ``_columns``: each pair of a key meets once."""
    width = width or _GRAIN * shuffle_width(left.sparkSession)
    sizes = [side.groupBy(key).agg(F.count("*").alias("_n")) for side in (left, right)]
    hot = grids(*sizes, key, width, cell_pairs)
    return (
        _in_grid(left, key, hot, left_by, "rows", "columns"),
        _in_grid(right, key, hot, right_by, "columns", "rows"),
    )


def grid_join(
    left: DataFrame, right: DataFrame, key: str, left_by: str, right_by: str, width: int | None = None,
    cell_pairs: int = CELL_PAIRS,
) -> DataFrame:
    """Inner many-to-many join on ``key`` where the key may be hot on both sides.

    A hot key becomes a grid: left rows go to one grid row and to all of its
    columns, right rows to one column and all of its rows. Each pair meets in
    exactly one grid field, and a field has so many pairs that the copies stay
    few beside them, whatever the number of partitions.
    """
    left, right = in_grids(left, right, key, left_by, right_by, width, cell_pairs)
    return left.join(right, [key, "_rows", "_columns"]).drop("_rows", "_columns")
