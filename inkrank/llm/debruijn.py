"""Exact removal of repeated word windows by a compacted De Bruijn graph.

A word goes if a window of ``WINDOW`` words that covers it also starts earlier,
in a document of smaller id or earlier in the same one; windows are judged on the
input. The graph's edges are such windows. It is never written out whole: its
edges are taken together by the run of ``GRAM`` words that anchors them (see
``anchors``), and each run with what its windows hold is one path of edges.

1. Each group of texts reports its distinct paths, with their first place.
2. The runs seen again are found. One that always carries the same path does not
   branch: the path is compacted, and all but its first place are copies. Where
   paths differ, the first place of each is joined with its text for its edges.
3. Of each of those edges, the later places are copies.
4. Each group joins copies that follow each other at one distance from their
   source into long spans, and sends them, with a digest of their words, to the
   group of the source, which compares them with its own words at those places.
5. Each group cuts its texts by the spans that were confirmed.

Copies within a group are one row before they are shuffled. What meets in one task
is a run's different paths, or the paths that hold an edge: one short row for each
and group, which can spill. A copy's source is the place before it, so that no
document becomes the source of all copies.

Edge cases: null and empty texts have no words; texts shorter than a window lose
nothing; rows of equal id count as one document, as do all rows without an id,
which come before all others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from inkrank.llm.anchors import NO_ID, Anchors, Ranges, byte_units, grouped, merged, slices
from inkrank.session import scratch_path, settle

WINDOW = 20
GRAM = 6

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FIRST = 0x9E3779B97F4A7C15
_SECOND = 0xC2B2AE3D27D4EB4F
_COPY = "source long, source_at int, size int, digest binary, grp int, doc long, at int, home int"


class _Words:
    """The words of some texts: their hashes and where each text's begin."""

    def __init__(self, held: list[bytes]):
        self.lists = [text.split() for text in held]
        raw = np.frombuffer(b" ".join(held), np.uint8)
        edges = np.diff(np.concatenate([[1], _SPACE[raw].astype(np.int8), [1]]))
        begins, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        self.units = Ranges(byte_units()[raw], _SECOND)(begins, ends)
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in self.lists])]).astype(np.int64)


class _Group:
    """The paths of one group of texts: run, path, document and first word."""

    def __init__(self, table: pa.Table, gram: int, window: int):
        self.parts: list[tuple[np.ndarray, _Words, Anchors]] = []
        rows: list[list[np.ndarray]] = [[], [], [], []]
        for ids, held in slices(table):
            words = _Words(held)
            found = Anchors(words.units, words.starts, gram, window)
            del found.ranges
            self.parts.append((ids, words, found))
            own = (found.key, found.context, ids[found.text], found.first - words.starts[found.text])
            for column, values in zip(rows, own, strict=True):
                column.append(values)
        kinds = (np.uint64, np.uint64, np.int64, np.int64)
        columns = [np.concatenate([np.zeros(0, k), *c]) for c, k in zip(rows, kinds, strict=True)]
        self.run, self.path, self.doc, self.place = columns
        order = np.lexsort((self.place, self.doc, self.path, self.run))
        a, b = self.run[order], self.path[order]
        fresh = np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        #: One row per path: its first place in the group.
        self.paths = order[fresh]
        self.path_of = np.zeros(len(order), np.int64)
        self.path_of[order] = np.cumsum(fresh) - 1

    def find(self, run: np.ndarray, path: np.ndarray) -> np.ndarray:
        """The number of each (run, path) pair, all of which are there."""
        own = self.run[self.paths], self.path[self.paths]
        runs, paths = np.unique(own[0]), np.unique(own[1])
        wide = lambda a, b: (np.searchsorted(runs, a) << 32) | np.searchsorted(paths, b)
        mine = wide(*own)
        order = np.argsort(mine)
        return order[np.searchsorted(mine[order], wide(run, path))]

    def first(self, told: pa.Table, grp: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Source of each path, by what this group ``grp`` was told: its document,
        place and group."""
        doc, place = self.doc[self.paths].copy(), self.place[self.paths].copy()
        home = np.full(len(self.paths), grp, np.int64)
        at = self.find(*_paths_of(told))
        doc[at], place[at], home[at] = (told.column(c).to_numpy() for c in ("doc", "place", "home"))
        return doc, place, home


def _paths_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    run, path = (table.column(c).to_numpy().view(np.uint64) for c in ("run", "path"))
    return run, path


def _table(schema: str, *columns) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [item.split() for item in schema.split(", ")]
    arrays = [
        pa.array(c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == np.uint64 else c, kinds[kind])
        for (_, kind), c in zip(fields, columns, strict=True)
    ]
    return pa.Table.from_arrays(arrays, [name for name, _ in fields])


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def removable(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_words, spans, kept)`` of every row of ``docs``.

    ``spans`` are the removed runs of words, ``kept`` the UTF-8 of the other words
    joined by blanks.
    """
    if not 0 < gram <= window:
        raise ValueError("an anchor lies in a window")
    texts, _ = grouped(docs)

    def paths(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = _Group(table, gram, window)
        grp = np.full(len(own.paths), key[0].as_py(), np.int32)
        first = own.paths
        return _table("grp int, run long, path long, doc long, place int", grp, own.run[first], own.path[first],
                      own.doc[first], own.place[first].astype(np.int32))

    def edges(key: tuple[pa.Scalar, ...], table: pa.Table, wanted: pa.Table) -> pa.Table:
        own = _Group(table, gram, window)
        asked = np.zeros(len(own.doc), bool)
        asked[own.paths[own.find(*_paths_of(wanted))]] = True
        out, done = [], 0
        for ids, words, found in own.parts:
            mine = np.flatnonzero(asked[done : done + len(found.at)])
            done += len(found.at)
            count = found.last[mine] - found.first[mine] + 1
            begins = np.repeat(found.first[mine], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            text = np.repeat(found.text[mine], count)
            hashes = [Ranges(words.units, base)(begins, begins + window) for base in (_FIRST, _SECOND)]
            out.append((*hashes, ids[text], begins - words.starts[text]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
        grp = np.full(len(columns[0]), key[0].as_py(), np.int32)
        return _table("grp int, edge long, edge2 long, doc long, at int", grp, *columns[:3], columns[3].astype(np.int32))

    def copies(key: tuple[pa.Scalar, ...], table: pa.Table, told: pa.Table) -> pa.Table:
        own = _Group(table, gram, window)
        is_edge = told.column("is_edge").to_numpy()
        doc, place, home = own.first(told.filter(pa.array(~is_edge)), key[0].as_py())
        # Later places of known edges, as (document, first word, source, its word, group).
        later = [told.filter(pa.array(is_edge)).column(c).to_numpy() for c in ("own", "own_at", "doc", "place", "home")]
        source, source_at, source_grp = doc[own.path_of], place[own.path_of], home[own.path_of]
        copied = (source != own.doc) | (source_at != own.place)
        rows, done = [], 0
        for ids, words, found in own.parts:
            some = slice(done, done + len(found.at))
            done += len(found.at)
            mine = np.flatnonzero(copied[some])
            size = (found.last - found.first)[mine] + window
            by_doc = [x[some][mine] for x in (own.doc, own.place, source, source_at, source_grp)] + [size]
            here = np.isin(later[0], ids)
            by_doc = [np.concatenate([a, b[here]]) for a, b in zip(by_doc, [*later, np.full(len(later[0]), window)], strict=True)]
            rows += _long_spans(key[0].as_py(), ids, words, by_doc)
        return _table(_COPY, *(list(c) for c in zip(*rows, strict=True)) if rows else [[]] * 8)

    def confirm(key: tuple[pa.Scalar, ...], table: pa.Table, sent: pa.Table) -> pa.Table:
        wanted: dict[int, list[dict]] = {}
        for row in sent.to_pylist():
            wanted.setdefault(row["source"], []).append(row)
        good = []
        for ids, held in slices(table):
            for doc, text in zip(ids.tolist(), held, strict=True):
                if doc in wanted:
                    words = text.split()
                    for row in wanted[doc]:
                        a = row["source_at"]
                        if _digest(words[a : a + row["size"]]) == row["digest"]:
                            good.append((row["grp"], row["doc"], row["at"], row["size"], row["digest"]))
        schema = "grp int, doc long, at int, size int, digest binary"
        return _table(schema, *(list(c) for c in zip(*good, strict=True)) if good else [[]] * 5)

    def cut(key: tuple[pa.Scalar, ...], table: pa.Table, spans: pa.Table) -> pa.Table:
        found: dict[int, list[tuple[int, int, bytes]]] = {}
        for row in spans.to_pylist():
            found.setdefault(row["doc"], []).append((row["at"], row["at"] + row["size"], row["digest"]))
        out = []
        for ids, held in slices(table):
            for doc, text in zip(ids.tolist(), held, strict=True):
                words = text.split()
                # Rows of one id may differ: a span counts where its words stand.
                own = [(a, b) for a, b, digest in found.get(doc, []) if _digest(words[a:b]) == digest]
                a, b = merged(*(np.array([x[i] for x in own], np.int64) for i in (0, 1)))
                edges = [0, *np.stack([a, b], axis=1).reshape(-1).tolist(), len(words)]
                kept = [w for x, y in zip(edges[::2], edges[1::2], strict=True) for w in words[x:y]]
                runs = [{"first": x, "last": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                out.append((doc, len(words), runs, b" ".join(kept)))
        span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        kinds = (pa.int64(), pa.int64(), span, pa.binary())
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
        return pa.Table.from_arrays(columns, ["doc", "n_words", "spans", "kept"])

    seen = texts.groupBy("grp").applyInArrow(paths, "grp int, run long, path long, doc long, place int")
    # One shuffle by run serves both windows. A group has one row per path, so copies
    # of a path are few here, however many documents hold it.
    of_run = Window.partitionBy("run")
    of_path = Window.partitionBy("run", "path").orderBy("doc", "place")
    again = seen.withColumns({"n": F.count("*").over(of_run), "branching": F.min("path").over(of_run) != F.max("path").over(of_run)})
    again = _with_source(again.where("n > 1").drop("n"), of_path, "doc", "place").where("branching or source is not null")
    again = settle(again, scratch_path(docs.sparkSession, "paths"))
    asked = again.where("branching and source is null").select("grp", "run", "path")
    told = again.where("source is not null")
    told = told.select("grp", "run", "path", F.col("source").alias("doc"), F.col("source_at").alias("place"), "home")

    listed = texts.groupBy("grp").cogroup(asked.groupBy("grp"))
    listed = listed.applyInArrow(edges, "grp int, edge long, edge2 long, doc long, at int")
    # Of an edge, too, each place but the first is a copy of the one before it.
    of_edge = Window.partitionBy("edge", "edge2").orderBy("doc", "at")
    later = _with_source(listed, of_edge, "doc", "at").where("source is not null")
    later = later.select(
        "grp", F.lit(0).cast("bigint").alias("run"), F.lit(0).cast("bigint").alias("path"),
        F.col("source").alias("doc"), F.col("source_at").alias("place"), "home", F.lit(True).alias("is_edge"),
        F.col("doc").alias("own"), F.col("at").alias("own_at"),
    )
    both = told.withColumns({"is_edge": F.lit(False), "own": F.lit(0).cast("bigint"), "own_at": F.lit(0)}).unionByName(later)
    sent = texts.groupBy("grp").cogroup(both.groupBy("grp")).applyInArrow(copies, _COPY)
    good = texts.groupBy("grp").cogroup(sent.groupBy("home"))
    good = good.applyInArrow(confirm, "grp int, doc long, at int, size int, digest binary")
    schema = "doc long, n_words long, spans array<struct<first:int,last:int>>, kept binary"
    out = texts.groupBy("grp").cogroup(good.groupBy("grp")).applyInArrow(cut, schema)
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")
    return out.select(doc_id, "n_words", "spans", "kept")


def _with_source(rows: DataFrame, window: WindowSpec, doc: str, at: str) -> DataFrame:
    """``source``, ``source_at`` and ``home`` of each place: document, word and group of
    the place before it, null for the first. Rows of one id may stand at the same place
    in several groups; they all have the source of the first of them."""
    before = F.struct(F.lag(doc).over(window).alias("doc"), F.lag(at).over(window).alias("at"), F.lag("grp").over(window).alias("grp"))
    same = F.col("_before.doc").eqNullSafe(F.col(doc)) & F.col("_before.at").eqNullSafe(F.col(at))
    fresh = F.last(F.when(~same, F.col("_before")), ignorenulls=True).over(window)
    found = rows.withColumn("_before", before).withColumn("_before", fresh)
    source = {"source": F.col("_before.doc"), "source_at": F.col("_before.at"), "home": F.col("_before.grp")}
    return found.withColumns(source).drop("_before")


def _long_spans(grp: int, ids: np.ndarray, words: _Words, rows: list[np.ndarray]) -> list[tuple]:
    """Copies that follow each other at one distance from their source, as one."""
    doc, at, source, source_at, home, size = rows
    if not len(doc):
        return []
    shift = source_at - at
    order = np.lexsort((at, shift, home, source, doc))
    doc, at, source, home, shift, size = (x[order] for x in (doc, at, source, home, shift, size))
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (source[1:] != source[:-1]) | (home[1:] != home[:-1]) | (shift[1:] != shift[:-1])])
    # Within one distance, a copy that begins past the end so far begins a span.
    key = np.cumsum(fresh) - 1
    far = np.int64(1) << 32
    ends = np.maximum.accumulate(key * far + at + size) - key * far
    fresh[1:] |= at[1:] > ends[:-1]
    starts = np.flatnonzero(fresh)
    lasts = np.append(starts[1:], len(at)) - 1
    texts: dict[int, list[int]] = {}
    for i, one in enumerate(ids.tolist()):
        texts.setdefault(one, []).append(i)
    out = []
    for i, last in zip(starts.tolist(), lasts.tolist(), strict=True):
        a, b = int(at[i]), int(ends[last])
        for text in texts[int(doc[i])]:
            own = words.lists[text]
            if b <= len(own):
                out.append((int(source[i]), a + int(shift[i]), b - a, _digest(own[a:b]), grp, int(doc[i]), a, int(home[i])))
    return out
