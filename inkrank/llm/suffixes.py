"""Exact removal of bytes that repeat from earlier documents, by sorted suffixes.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts in a
document of smaller id; strings are judged on the input. Only suffixes that start
at anchors (see ``anchors``) are sorted, with deep-shallow sorting: what follows
an anchor, and, read backwards, what precedes it. Two occurrences of an anchor
share a window just if their common prefix and suffix together are long enough.

The passes, all but the last of which move a few bytes per anchor:

1. Each group of texts reports its distinct anchors with hashes of their windows
   and the least id; copies within a group are one row.
2. Where an anchor has the same windows in several groups, the least id settles
   it. Where it has different windows, the least document of each kind is asked
   for their bytes. A group is told only of such anchors.
3. Those bytes meet by anchor, are sorted, and each window found again in a
   smaller document is marked.
4. Each group cuts its texts.

An anchor's different windows meet in one task, each kind once, some 100 bytes
each; equal ones, however many, never do.

Edge cases: null and empty texts stay empty; texts shorter than a window lose
nothing; rows of null id count as one document before all others, and rows of
equal id as one document, so neither removes from the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkrank.llm import deepshallow
from inkrank.llm.anchors import GROUP_BYTES, NO_ID, Anchors, byte_units, grouped, merged, slices
from inkrank.session import shuffle_width

WINDOW = 50
GRAM = 16

#: Text whose anchors share a bucket, about. A bucket is held in memory, with some 1.2
#: bytes of classes per byte of text.
BUCKET_BYTES = 256 << 20

_TAG = np.uint64((1 << 32) - 1)

_CLASSES = "grp int, bucket int, tags binary, contexts binary, docs binary"


def planes(values: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit values, byte by byte, which compresses better."""
    return values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view(np.uint64).reshape(-1)


def _by_class(anchor: np.ndarray, context: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """An order by anchor, windows and id. Most anchors are there once, so they are sorted
    alone, and only rows that share one are sorted by all three."""
    order = np.argsort(anchor)
    a = anchor[order]
    same = a[1:] == a[:-1]
    shared = np.zeros(len(order), bool)
    shared[1:] = same
    shared[:-1] |= same
    at = np.flatnonzero(shared)
    rows = order[at]
    order[at] = rows[np.lexsort((doc[rows], context[rows], anchor[rows]))]
    return order


class _Group:
    """The anchors of one group of texts, by class: anchor and windows."""

    def __init__(self, table: pa.Table, buckets: int, gram: int, window: int):
        self.parts: list[tuple[np.ndarray, list[bytes], np.ndarray, Anchors]] = []
        keys, contexts, docs = [], [], []
        for ids, held in slices(table):
            raw = np.frombuffer(b"".join(held), np.uint8)
            starts = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int64)
            found = Anchors(byte_units()[raw], starts, gram, window)
            del found.ranges
            self.parts.append((ids, held, raw, found))
            keys.append(found.key)
            contexts.append(found.context)
            docs.append(ids[found.text])
        none = np.zeros(0, np.uint64)
        key = np.concatenate([none, *keys])
        bucket = (key >> np.uint64(32)) % np.uint64(buckets)
        self.anchor = (bucket << np.uint64(32)) | (key & _TAG)
        self.context = np.concatenate([none, *contexts])
        self.doc = np.concatenate([none.astype(np.int64), *docs])
        order = _by_class(self.anchor, self.context, self.doc)
        a, c = self.anchor[order], self.context[order]
        fresh = np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (c[1:] != c[:-1])])
        #: One row per class: an anchor of it in a least document.
        self.classes = order[fresh]
        self._own = a[fresh], c[fresh]
        self.class_of = np.zeros(len(order), np.int64)
        self.class_of[order] = np.cumsum(fresh) - 1

    def find(self, anchor: np.ndarray, context: np.ndarray) -> np.ndarray:
        """The class of each (anchor, windows) pair, all of which are there."""
        # Classes are in order of anchor and windows: an anchor's are halved until one is left.
        anchors, contexts = self._own
        low = np.searchsorted(anchors, anchor)
        high = np.searchsorted(anchors, anchor, "right")
        several = np.flatnonzero(high - low > 1)
        while len(several):
            middle = (low[several] + high[several]) >> 1
            above = contexts[middle] <= context[several]
            low[several[above]] = middle[above]
            high[several[~above]] = middle[~above]
            several = several[high[several] - low[several] > 1]
        return low


def _by_bucket(anchor: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    bucket = (anchor >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        yield int(bucket[rows[0]]), rows


def _class_rows(rows: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    """``(group, bucket, anchors, windows, ids)`` as compact rows."""
    columns = [
        pa.array([row[0] for row in rows], pa.int32()),
        pa.array([row[1] for row in rows], pa.int32()),
        pa.array([planes(row[2] & _TAG, 4) for row in rows], pa.binary()),
        pa.array([planes(row[3], 8) for row in rows], pa.binary()),
        pa.array([planes(row[4].astype(np.uint64), 8) for row in rows], pa.binary()),
    ]
    return pa.Table.from_arrays(columns, ["grp", "bucket", "tags", "contexts", "docs"])


def _unpacked(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Group and bucket of every class in some rows, anchors, windows, ids."""
    tags = [from_planes(x, 4) for x in table.column("tags").to_pylist()]
    none = np.zeros(0, np.uint64)
    sizes = [len(x) for x in tags]
    bucket = np.repeat(np.array(table.column("bucket").to_pylist(), np.uint64), sizes)
    anchor = (bucket << np.uint64(32)) | np.concatenate([none, *tags])
    context = np.concatenate([none, *(from_planes(x, 8) for x in table.column("contexts").to_pylist())])
    doc = np.concatenate([none, *(from_planes(x, 8) for x in table.column("docs").to_pylist())]).astype(np.int64)
    return np.repeat(np.array(table.column("grp").to_pylist(), np.int64), sizes), anchor, context, doc


def _settled(table: pa.Table) -> pa.Table:
    """Of one bucket: what the groups need to know, with the least id overall."""
    grp, anchor, context, doc = _unpacked(table)
    order = _by_class(anchor, context, doc)
    a, c = anchor[order], context[order]
    new_anchor = np.concatenate([np.ones(min(1, len(a)), bool), a[1:] != a[:-1]])
    fresh = new_anchor.copy()
    fresh[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, len(a)))
    least = np.repeat(doc[order][starts], sizes)
    kinds = np.bincount(np.cumsum(new_anchor)[starts] - 1, minlength=0)
    branching = np.repeat(kinds, np.bincount(np.cumsum(new_anchor) - 1, minlength=0)) > 1
    told = branching | (doc[order] > least)
    rows = order[told]
    least = least[told]
    out = []
    by_group = np.argsort(grp[rows], kind="stable")
    cuts = np.flatnonzero(np.diff(grp[rows][by_group])) + 1
    for some in np.split(by_group, cuts) if len(by_group) else ():
        own = rows[some]
        out.append((int(grp[own[0]]), int(anchor[own[0]] >> np.uint64(32)), anchor[own], context[own], least[some]))
    return _class_rows(out)


def _marks(left: np.ndarray, right: np.ndarray, doc: np.ndarray, before: np.ndarray, count: np.ndarray, window: int):
    """For each context, a bit per window of it that a smaller document has too.

    ``left`` holds the bytes before the anchor, read backwards, ``right`` those
    from it on; window ``i`` of a context begins ``before - i`` bytes before it.
    """
    sorted_left, sorted_right = deepshallow.sort(left), deepshallow.sort(right)

    def same(sides: tuple[np.ndarray, np.ndarray], length: int) -> np.ndarray:
        order, shared = sides
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(shared < length)
        return out

    marks = np.zeros(len(doc), np.uint64)
    for reach in range(int(before.max()) + 1 if len(before) else 0):
        at = before - reach
        rows = np.flatnonzero((at >= 0) & (at < count))
        if len(rows) < 2:
            continue
        both = same(sorted_right, window - reach)[rows] * (len(doc) + 1) + same(sorted_left, reach)[rows]
        order = np.lexsort((doc[rows], both))
        fresh = np.concatenate([[True], both[order][1:] != both[order][:-1]])
        starts = np.flatnonzero(fresh)
        least = np.repeat(doc[rows][order][starts], np.diff(np.append(starts, len(rows))))
        found = rows[order[doc[rows][order] > least]]
        marks[found] |= np.uint64(1) << at[found].astype(np.uint64)
    return marks


def removable(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` of every row of ``docs``.

    ``spans`` are the removed runs of bytes, ``kept`` the other bytes joined.
    """
    if not 0 < gram <= window <= 64:
        raise ValueError("windows have up to 64 bytes, and an anchor lies in one")
    texts, groups = grouped(docs)
    width = shuffle_width(docs.sparkSession)
    # A task takes its buckets one at a time, so memory follows the bucket's size, which
    # follows the input and not the setting.
    buckets = max(width, math.ceil(groups * GROUP_BYTES / BUCKET_BYTES))

    def classes(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = _Group(table, buckets, gram, window)
        anchor, context, doc = (x[own.classes] for x in (own.anchor, own.context, own.doc))
        rows = [(key[0].as_py(), b, anchor[r], context[r], doc[r]) for b, r in _by_bucket(anchor)]
        return _class_rows(rows)

    def contexts(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        own = _Group(table, buckets, gram, window)
        _, anchor, context, least = _unpacked(told)
        at = own.find(anchor, context)
        asked = own.classes[at[own.doc[own.classes[at]] == least]]
        left, right, before, count = _sides(own, asked, gram, window)
        rows = []
        for bucket, some in _by_bucket(own.anchor[asked]):
            rows.append(
                {
                    "grp": key[0].as_py(),
                    "bucket": bucket,
                    "tags": planes(own.anchor[asked][some] & _TAG, 4),
                    "contexts": planes(own.context[asked][some], 8),
                    "docs": planes(own.doc[asked][some].astype(np.uint64), 8),
                    "shape": np.stack([before[some], count[some]]).astype(np.uint8).tobytes(),
                    "bytes": np.concatenate([left[some], right[some]], axis=1).tobytes(),
                }
            )
        names = [*_names(_CLASSES), "shape", "bytes"]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.Table.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)

    def mark(table: pa.Table) -> pa.Table:
        grp, anchor, context, doc = _unpacked(table)
        shape = np.concatenate([np.frombuffer(x, np.uint8).reshape(2, -1) for x in table.column("shape").to_pylist()], axis=1)
        before, count = shape.astype(np.int64)
        reach = window - gram
        data = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("bytes").to_pylist()])
        data = data.reshape(-1, reach + window)
        marks = _marks(data[:, :reach], data[:, reach:], doc, before, count, window)
        out = []
        found = np.flatnonzero(marks)
        by_group = found[np.argsort(grp[found], kind="stable")]
        cuts = np.flatnonzero(np.diff(grp[by_group])) + 1
        for some in np.split(by_group, cuts) if len(by_group) else ():
            bucket = int(anchor[some[0]] >> np.uint64(32))
            out.append((int(grp[some[0]]), bucket, anchor[some], context[some], marks[some].view(np.int64)))
        return _class_rows(out).append_column("marked", pa.array([True] * len(out), pa.bool_()))

    def cut(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        own = _Group(table, buckets, gram, window)
        least = own.doc[own.classes].copy()
        marks = np.zeros(len(least), np.uint64)
        marked = np.array(told.column("marked").to_pylist(), bool)
        for kind, into in ((False, least), (True, marks)):
            _, anchor, context, values = _unpacked(told.filter(pa.array(marked == kind)))
            into[own.find(anchor, context)] = values if not kind else values.view(np.uint64)
        return _cut(own, own.doc > least[own.class_of], np.where(own.doc == least[own.class_of], marks[own.class_of], np.uint64(0)), window)

    by_class = texts.groupBy("grp").applyInArrow(classes, _CLASSES)
    settled = by_class.repartition(width, "bucket").groupBy("bucket").applyInArrow(_settled, _CLASSES)
    asked = texts.groupBy("grp").cogroup(settled.groupBy("grp"))
    asked = asked.applyInArrow(contexts, f"{_CLASSES}, shape binary, bytes binary")
    marked = asked.repartition(width, "bucket").groupBy("bucket").applyInArrow(mark, f"{_CLASSES}, marked boolean")
    told = settled.withColumn("marked", F.lit(False)).unionByName(marked)
    schema = "doc long, n_bytes long, spans array<struct<first:int,last:int>>, kept binary"
    out = texts.groupBy("grp").cogroup(told.groupBy("grp")).applyInArrow(cut, schema)
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")
    return out.select(doc_id, "n_bytes", "spans", "kept")


def _names(schema: str) -> list[str]:
    return [item.split()[0] for item in schema.split(", ")]


def _sides(own: _Group, rows: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, ...]:
    """The bytes before (backwards) and after some anchors, as far as their windows
    reach, with the reach before the anchor and the number of windows."""
    reach = window - gram
    left, right = np.zeros((len(rows), reach), np.uint8), np.zeros((len(rows), window), np.uint8)
    before, count = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    ends = np.cumsum([len(found.at) for *_, found in own.parts])
    part = np.searchsorted(ends, rows, "right")
    for number in np.unique(part):
        _, _, raw, found = own.parts[number]
        mine = np.flatnonzero(part == number)
        at = rows[mine] - (ends[number] - len(found.at))
        place, first, last = found.at[at], found.first[at], found.last[at]
        before[mine], count[mine] = place - first, last - first + 1
        for side, steps in ((left, -1 - np.arange(reach)), (right, np.arange(window))):
            where = place[:, None] + steps
            inside = (where >= first[:, None]) & (where < (last + window)[:, None])
            side[mine] = np.where(inside, raw[np.clip(where, 0, len(raw) - 1)], 0)
    return left, right, before, count


def _cut(own: _Group, whole: np.ndarray, marks: np.ndarray, window: int) -> pa.Table:
    """Each text without what is covered: whole anchors, and marked windows."""
    docs, sizes, spans, kept, done = [], [], [], [], 0
    for ids, held, _, found in own.parts:
        some = slice(done, done + len(found.at))
        done += len(found.at)
        all_of = np.flatnonzero(whole[some])
        marked = np.flatnonzero(marks[some])
        bits = (marks[some][marked][:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        row, bit = np.nonzero(bits)
        row = marked[row]
        starts = np.concatenate([found.first[all_of], found.first[row] + bit]).astype(np.int64)
        ends = np.concatenate([found.last[all_of] + window, found.first[row] + bit + window]).astype(np.int64)
        text = np.concatenate([found.text[all_of], found.text[row]]).astype(np.int64)
        order = np.argsort(text, kind="stable")
        cuts = np.searchsorted(text[order], np.arange(len(held) + 1))
        for i, data in enumerate(held):
            mine = order[cuts[i] : cuts[i + 1]]
            a, b = merged(starts[mine] - found.starts[i], ends[mine] - found.starts[i])
            edges = [0, *np.stack([a, b], axis=1).reshape(-1).tolist(), len(data)]
            docs.append(int(ids[i]))
            sizes.append(len(data))
            spans.append([{"first": x, "last": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            kept.append(b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
    span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    columns = [pa.array(docs, pa.int64()), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())]
    return pa.Table.from_arrays(columns, ["doc", "n_bytes", "spans", "kept"])
