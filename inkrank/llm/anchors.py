"""Where texts may repeat: minimizer anchors of all windows, and text groups.

A window is ``window`` consecutive units (bytes or words) of one document. Its
anchor is the run of ``gram`` units in it that hashes lowest, the first of
several. Equal windows have equal anchors at equal places, so comparing windows
with one anchor compares all that can be equal; neighbouring windows mostly share
theirs, so there are far fewer anchors than windows.

Texts are dealt once into groups of bounded size by id and text, compressed, and every
pass over them reads that one shuffle again. Rows without an id, or of one id, spread
over the groups as others do; only equal rows share one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkrank.llm.common import sliced, texts
from inkrank.session import shuffle_width

#: Text in a group, about; and in one slice of a group, about.
GROUP_BYTES = 8 << 20
SLICE_BYTES = 256 << 10

#: Rows without an id count as one document before all others.
NO_ID = -(1 << 63)

_ODD = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


def group_of(doc: Column, text: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(doc, text), F.lit(groups)).cast("int")


def grouped(docs: DataFrame) -> tuple[DataFrame, int]:
    """``(grp, doc, packed)``, compressed texts shuffled by group, and the number
    of groups."""
    docs = texts(docs)
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    width = shuffle_width(docs.sparkSession)
    groups = max(width, math.ceil(total / GROUP_BYTES))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in sliced(batches, 2):
            packed = [packer.compress(text.encode("utf-8", "surrogatepass")) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(packed, pa.binary())], ["grp", "doc", "packed"])

    key = F.coalesce("doc_id", F.lit(NO_ID))
    dealt = docs.select(group_of(key, F.col("text"), groups).alias("grp"), key.alias("doc"), "text")
    return dealt.mapInArrow(compress, "grp int, doc long, packed binary").repartition(width, "grp"), groups


def slices(table: pa.Table) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """A group's ids and texts (UTF-8), about ``SLICE_BYTES`` at a time."""
    unpacker = zstandard.ZstdDecompressor()
    docs, held, size = [], [], 0
    for doc, packed in zip(table.column("doc").to_pylist(), table.column("packed").to_pylist(), strict=True):
        docs.append(doc)
        held.append(unpacker.decompress(packed))
        size += len(held[-1])
        if size >= SLICE_BYTES:
            yield np.array(docs, np.int64), held
            docs, held, size = [], [], 0
    if docs:
        yield np.array(docs, np.int64), held


# --- units and their hashes -------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


@cache
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, np.uint64(base % (1 << 64)))
    out[0] = 1
    return np.cumprod(out)


def powers(base: int, size: int) -> np.ndarray:
    return _powers(base, 1 << max(4, (size - 1).bit_length()))[:size]


class Ranges:
    """Hashes of any ranges of an array of 64-bit units."""

    def __init__(self, units: np.ndarray, base: int = _ODD):
        size = len(units) + 1
        self._back = powers(pow(base, -1, 1 << 64), size)
        self._sums = np.zeros(size, np.uint64)
        np.cumsum(units * powers(base, size)[:-1], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._back[starts])

    def grams(self, size: int) -> np.ndarray:
        """The hash of every run of ``size`` units."""
        count = max(0, len(self._sums) - size)
        return mixed((self._sums[size:] - self._sums[:count]) * self._back[:count])


@cache
def byte_units() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


#: Hashes are compared by all but these low bits, which hold places meanwhile.
_PLACE_BITS = 24


def lowest_of(hashes: np.ndarray, wide: int) -> np.ndarray:
    """For each run of ``wide`` hashes, the place of its lowest, the first of equals."""
    count = len(hashes) - wide + 1
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    if len(hashes) > int(mask):
        return _lowest_of_many(hashes >> np.uint64(_PLACE_BITS), wide)
    both = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    # Minima of blocks from either end; a run is the end of one block and the
    # beginning of the next.
    blocks = -(-len(both) // wide)
    table = np.full(blocks * wide, ~np.uint64(0))
    table[: len(both)] = both
    table = table.reshape(blocks, wide)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(back[:count], ahead[wide - 1 : wide - 1 + count]) & mask).astype(np.int64)


def _lowest_of_many(hashes: np.ndarray, wide: int) -> np.ndarray:
    """The same by doubling, for more places than the low bits can hold."""
    low, place, reach = hashes, np.arange(len(hashes)), 1
    while reach < wide:
        step = min(reach, wide - reach)
        right = low[step:] < low[:-step]
        place = np.where(right, place[step:], place[:-step])
        low = np.where(right, low[step:], low[:-step])
        reach += step
    return place


class Anchors:
    """The anchors of some texts: where they are, and the windows each stands for.

    ``starts`` are the places of the texts in the array of units, with its end.
    Of anchor ``i``, ``at[i]`` is the place, ``text[i]`` the text, and its windows
    start from ``first[i]`` to ``last[i]``.
    """

    def __init__(self, units: np.ndarray, starts: np.ndarray, gram: int, window: int):
        self.ranges = Ranges(units)
        self.starts, self.window = starts, window
        count = len(units) - window + 1
        empty = np.zeros(0, np.int64)
        self.at = self.first = self.last = self.text = empty
        self.key = self.context = empty.astype(np.uint64)
        if count <= 0:
            return
        grams = self.ranges.grams(gram)
        place = lowest_of(grams, window - gram + 1)
        whole = np.ones(count, bool)
        for cut in starts[1:-1]:
            whole[max(0, cut - window + 1) : cut] = False
        windows = np.flatnonzero(whole)
        if not len(windows):
            return
        owner = place[windows].astype(np.int64)
        fresh = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (windows[1:] != windows[:-1] + 1)]))
        self.first = windows[fresh]
        self.last = windows[np.append(fresh[1:], len(windows)) - 1]
        self.at = owner[fresh]
        self.text = np.searchsorted(starts, self.first, "right") - 1
        self.key = grams[self.at]
        inside = self.ranges(self.first, self.last + window)
        offset = ((self.at - self.first) << 20) + (self.last - self.first)
        self.context = mixed(inside + offset.astype(np.uint64) * np.uint64(_ODD))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by some ranges (touching ranges are one run)."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
    return starts[fresh], ends[np.append(fresh[1:], len(starts)) - 1]
