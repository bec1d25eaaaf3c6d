"""Codes of vectors: equal parts, each replaced by the nearest entry of its codebook.

Components become integers, so that means, distances and ties are exact whatever
the order of addition. Codebooks start as the parts of the vectors with the
smallest ids and are refined by rounds of assigning and averaging.

The nearest entry is found by equal-average search. By the inequality of Cauchy and
Schwarz the squared difference of two component sums, divided by the dimension, is
at most the squared distance. So entries stand in the order of their sums, and a
part looks at them outward from its own sum, until the next gap alone is strictly
more than the best distance; a tie is still looked at and goes to the lower index.

One round reads the written integers once; a task hands on one sum and count per
part and entry, and only the codebooks, whose size is that of their parameters, reach the
driver. Nothing else is collected.

Edge cases: vectors that are null, empty, of another length than that of the
smallest kept id or hold null or non-finite components are left out; components
beyond ``LARGEST`` count as that, which keeps squared distances within 64 bits; a
length that the parts don't divide is filled up with zeros; null ids come after all
others among the smallest, and equal ids in the order of their components; with
fewer vectors than entries the codebooks are smaller; null labels are one label; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkrank.operators.skew import lookup
from inkrank.session import scratch_path, settle

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

#: Integers are held within this; 2**30 squared times a part's length fits 64 bits.
LARGEST = 1 << 28

#: Rows per step of a search; the arrays of a step stay small.
_STEP = 1 << 14

#: Up to so many labels their sums are broadcast, some 50 bytes each.
_BROADCAST_LABELS = 200_000


class Codebook:
    """The entries of one part, searched by their sums."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        sums = entries.sum(axis=1)
        self._order = np.argsort(sums, kind="stable")
        self._sums = sums[self._order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """``(index, squared distance)`` of each row's nearest entry, and how many
        distances were taken for it."""
        index = np.empty(len(parts), np.int64)
        error = np.empty(len(parts), np.int64)
        taken = 0
        for start in range(0, len(parts), _STEP):
            step = slice(start, start + _STEP)
            index[step], error[step], n = self._search(parts[step])
            taken += n
        return index, error, taken

    def _search(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        size = len(self._sums)
        dimension = parts.shape[1]
        own = parts.sum(axis=1)
        above = np.searchsorted(self._sums, own)
        below = above - 1
        best = np.full(len(parts), np.iinfo(np.int64).max)
        index = np.full(len(parts), size)
        rows = np.arange(len(parts))
        taken = 0
        while len(rows):
            # Of the two entries next to the looked-at range, the one of the smaller gap.
            up, down = above[rows], below[rows]
            gap_up = np.where(up < size, self._sums[np.minimum(up, size - 1)] - own[rows], np.iinfo(np.int64).max)
            gap_down = np.where(down >= 0, own[rows] - self._sums[np.maximum(down, 0)], np.iinfo(np.int64).max)
            upward = gap_up <= gap_down
            gap = np.where(upward, gap_up, gap_down)
            # gap squared over dimension > best, in floating point with room for its
            # rounding: a pair too many is looked at, never one too few.
            open_ = (gap < np.iinfo(np.int64).max) & (gap.astype(float) ** 2 / dimension <= best[rows] * (1 + 1e-9) + 1e-9)
            rows, upward = rows[open_], upward[open_]
            at = np.where(upward, above[rows], below[rows])
            entry = self._order[at]
            far = parts[rows] - self.entries[entry]
            distance = np.einsum("ij,ij->i", far, far)
            taken += len(rows)
            better = (distance < best[rows]) | ((distance == best[rows]) & (entry < index[rows]))
            best[rows] = np.where(better, distance, best[rows])
            index[rows] = np.where(better, entry, index[rows])
            above[rows] += upward
            below[rows] -= ~upward
        return index, best, taken


def _whole(component: Column) -> Column:
    """floor(4096 x), held within ``LARGEST``."""
    scaled = component.cast("double") * SCALE
    bound = F.lit(float(LARGEST))
    return F.floor(F.least(F.greatest(scaled, -bound), bound)).cast("long")


def integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None, parts: int) -> DataFrame:
    """``(id, label, x)``: the kept vectors as integers, written once."""
    vector = F.col(f"`{vector_col}`")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col(f"`{label_col}`") if label_col else F.lit(None).cast("int")
    kept = vectors.where(vector.isNotNull() & (F.size(vector) > 0) & sound).select(
        F.col(f"`{id_col}`").alias("id"), label.alias("label"), vector.alias("x")
    )
    first = _smallest(kept, 1)
    length = len(first[0]["x"]) if first else parts
    short = F.array_repeat(F.lit(0).cast("long"), -length % parts)
    whole = kept.where(F.size("x") == length).withColumn("x", F.concat(F.transform("x", _whole), short))
    return settle(whole, scratch_path(vectors.sparkSession, "integers"))


def _smallest(rows: DataFrame, count: int) -> list:
    """The rows of the ``count`` smallest ids, as many as a codebook has entries."""
    return rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(count).collect()


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(rows: DataFrame, books: np.ndarray) -> list:
    """``(part, entry, n, total)`` of the entries in use."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(book) for book in books]
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0))
            for p in range(parts):
                own = x[:, p * width : (p + 1) * width]
                entry, _, _ = search[p].nearest(own)
                n[p] += np.bincount(entry, minlength=entries)
                for i in np.unique(entry):
                    total[p, i] += own[entry == i].sum(axis=0)
        used = np.argwhere(n)
        columns = [pa.array(used[:, i].astype(np.int32)) for i in (0, 1)]
        totals = pa.array(list(total[n > 0]), pa.list_(pa.int64()))
        names = ["part", "entry", "n", "total"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(n[n > 0]), totals], names)

    found = rows.select("x").mapInArrow(add, "part int, entry int, n long, total array<long>")
    places = [F.sum(F.col("total")[i]) for i in range(width)]
    # One row per part and entry.
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*places).alias("total")).collect()


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks, ``(part, entry, component)``, of ``integers``."""
    first = _smallest(rows, entries)
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    start = np.array([row["x"] for row in first], np.int64)
    books = np.ascontiguousarray(start.reshape(len(first), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        for row in _sums(rows, books):
            books[row.part, row.entry] = [total // row.n for total in row.total]
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``(id, label, codes, error)``: an entry's index for each part, and the sum of
    the squared distances."""
    parts, _, width = books.shape
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("id", "label")}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(book) for book in books]
        for batch in batches:
            x = _matrix(batch.column(2)) if batch.num_rows else np.zeros((0, parts * width), np.int64)
            codes = np.empty((len(x), parts), np.uint8 if parts and books.shape[1] <= 256 else np.uint16)
            error = np.zeros(len(x), np.int64)
            for p in range(parts):
                entry, far, _ = search[p].nearest(x[:, p * width : (p + 1) * width])
                codes[:, p] = entry
                error += far
            packed = pa.array([row.tobytes() for row in codes], pa.binary())
            names = ["id", "label", "codes", "error"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, pa.array(error)], names)

    schema = f"id {kinds['id']}, label {kinds['label']}, codes binary, error long"
    return rows.select("id", "label", "x").mapInArrow(assign, schema)


def decode(codes: bytes, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, in the units of the input."""
    entry = np.frombuffer(codes, np.uint8 if books.shape[1] <= 256 else np.uint16)
    return np.concatenate([book[i] for book, i in zip(books, entry, strict=True)]) / SCALE


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``(id, label, codes, error, label_error)`` of every kept vector, and the codebooks.

    ``label_error`` is the error summed over all vectors of the label.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, id_col, vector_col, label_col, parts)
    books = train(rows, parts, entries, rounds)
    coded = settle(encode(rows, books), scratch_path(spark, "codes"))
    # Every label as a string that is never null, a null one as one that no other is.
    coded = coded.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    sums = coded.groupBy("_key").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n"))
    sums = settle(sums, scratch_path(spark, "label-errors"))
    totals = sums.select("_key", "label_error")
    if sums.count() <= _BROADCAST_LABELS:
        found = coded.join(F.broadcast(totals), "_key")
    else:
        found = lookup(coded, totals, "_key", "id")
    return found.select("id", "label", "codes", "error", "label_error"), books
