"""Best-fit packing of tokenized documents into sequences of a fixed length.

The plan is made on the histogram of piece lengths, not on the pieces: best fit
by falling length, moving whole groups of like sequences at once. Its size
depends on the sequence length alone. Pieces then take the planned slots of
their length by rank, which is numbered in salts so that no length, however
common, meets in one task.

Edge cases: a null or empty text is one piece, the end id; documents of equal id
are packed each for itself; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkrank.llm.common import numbered, sliced, texts
from inkrank.llm.tokens import default_tokenizer, encoder, release
from inkrank.session import scratch_path, settle, shuffle_width

SEQUENCE = 2048
END_ID = 0


def pieces(
    docs: DataFrame,
    sequence: int = SEQUENCE,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` of all documents.

    A document longer than ``sequence`` is cut into pieces of that length, the
    first taking what is over. ``ids`` are little-endian 32-bit integers.
    """
    tokenizer = tokenizer or default_tokenizer()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        for batch in sliced(batches):
            rows = []
            found = words.encode(batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                over = len(ids) % sequence or sequence
                starts = [0, *range(over, len(ids), sequence)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    data = ids[a:b].tobytes()
                    rows.append((doc, piece, a, b - a, zlib.crc32(data), data)[: len(names)])
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return texts(docs).mapInArrow(cut, schema)


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Slots by best fit over counts: ``(length, rank, count, sequence, offset)``.

    Pieces ``rank .. rank + count - 1`` of a length go, in turn, to sequences
    ``sequence ..`` at ``offset``. A group is a run of sequences filled alike;
    only the last of the groups that a length fills is split, so each length
    adds at most one group beside those it opens.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = {}  # room left -> runs (first sequence, count)
    rooms: list[int] = []  # the keys of free, ascending
    opened = 0

    def put(room: int, run: tuple[int, int]) -> None:
        if room and room not in free:
            bisect.insort(rooms, room)
            free[room] = []
        if room:
            free[room].append(run)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        at = bisect.bisect_left(rooms, length)
        # Rooms made by this very length are smaller by it, and may still fit it.
        while left and at < len(rooms):
            room = rooms[at]
            first, count = free[room].pop()
            taken = min(left, count)
            if taken < count:
                free[room].append((first + taken, count - taken))
            if not free[room]:
                del free[room], rooms[at]
            slots.append((length, rank, taken, first, sequence - room))
            rank, left = rank + taken, left - taken
            put(room - length, (first, taken))
            at = bisect.bisect_left(rooms, length)
        each = sequence // length
        if left:
            full, rest = divmod(left, each)
            for i in range(each if full else 0):
                slots.append((length, rank, full, opened, i * length))
                rank += full
            if full:
                put(sequence - each * length, (opened, full))
                opened += full
            for i in range(rest):
                slots.append((length, rank, 1, opened, i * length))
                rank += 1
            if rest:
                put(sequence - rest * length, (opened, 1))
                opened += 1
    return slots


def pack(cut: DataFrame, sequence: int = SEQUENCE, salts: int | None = None) -> DataFrame:
    """Give each row of ``pieces`` its ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    cut = settle(cut, scratch_path(spark, "pieces"))
    # At most ``sequence`` rows, whatever the input.
    counted = cut.groupBy("length").agg(F.count("*").alias("n")).collect()
    slots = pd.DataFrame(
        plan({row.length: row.n for row in counted}, sequence),
        columns=["length", "rank", "count", "first", "offset"],
    ).sort_values(["length", "rank"])
    # The plan has a few slots per length: some 10 kB to 1 MB, grown by lengths only.
    order = slots["length"].to_numpy(np.int64), slots["rank"].to_numpy(np.int64)
    first, offset = slots["first"].to_numpy(np.int64), slots["offset"].to_numpy(np.int64)
    shift = np.int64(40)
    keys = (order[0] << shift) | order[1]
    planned = spark.sparkContext.broadcast((keys, order[1], first, offset))

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        release()
        keys, ranks, first, offset = planned.value
        at = np.searchsorted(keys, (length.to_numpy() << shift) | rank.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": first[at] + rank.to_numpy() - ranks[at], "offset": offset[at]})

    salts = salts or shuffle_width(spark)
    order_by = ["doc_id", "piece", "ids_crc32", "start"]
    ranked = numbered(cut, ["length"], order_by, salts, "rank")
    return ranked.withColumn("slot", slot("length", "rank")).select(*cut.columns, "slot.*")
