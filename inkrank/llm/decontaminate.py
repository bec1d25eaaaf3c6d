"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Texts are reduced to lower-case words. A window is ``WINDOW`` consecutive words of
a benchmark item, or the whole of a shorter item. Every window of a longer item
holds one of the blocks of ``(WINDOW + 1) // 2`` words that start at multiples of
that number, so the automaton holds those blocks (and the short items): it grows
with the benchmark's text, not with the text times the window. A block that
occurs in a document is extended word by word on both sides, and counts from
``WINDOW`` equal words on. A block at more than ``FEW`` places of the items is not tried
at each of them: the windows that hold it are looked up by their words.

Edge cases: null or empty texts have no words and hit nothing; an item without
words occurs nowhere; items of equal id count once, items of null id not at all
in the list of items though their words are hit; an empty benchmark hits nothing.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkrank.llm.common import sliced
from inkrank.session import scratch_path, settle

WINDOW = 13

#: A document is contaminated if one in so many of its words is hit.
SHARE = 20

#: Places of a block that are tried one by one.
FEW = 8

#: Benchmark text in one automaton (about fifty times this in memory). A larger
#: benchmark is dealt into parts of this size, one pass over the texts for each.
PART_BYTES = 4 << 20

# Letters and digits of ASCII in lower case and every byte beyond; else a blank.
_WORD_BYTES = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def folded(text: str | None) -> bytes:
    """The text's UTF-8 with word bytes in lower case and all others as blanks."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)


def words_of(text: str | None) -> list[str]:
    """Its words, one character per byte."""
    return [word.decode("latin-1") for word in folded(text).split()]


class Matcher:
    """The automaton of some items, and how a document is held against it."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        import ahocorasick

        self._window, block = window, (window + 1) // 2
        # Items of equal words are one, with all their names.
        named: dict[tuple[str, ...], set[str]] = {}
        for name, text in items:
            if words := tuple(words_of(text)):
                named.setdefault(words, set()).update(() if name is None else (name,))
        self._items = [(names, list(words)) for words, names in named.items()]
        self._automaton = ahocorasick.Automaton()
        for item, (_, words) in enumerate(self._items):
            size = len(words) if len(words) < window else block
            for at in range(0, len(words) - size + 1, size):
                key = f" {' '.join(words[at : at + size])} "
                places = self._automaton.get(key, None)
                if places is None:
                    self._automaton.add_word(key, places := (len(key), size, []))
                places[2].append((item, at))
        #: Of blocks at many places, the names of each window by its place before the block.
        self._windows: dict[str, list[dict[str, set[str]]]] = {}
        for key, (_, size, places) in self._automaton.items():
            if size == block and len(places) > FEW:
                self._windows[key] = self._windows_around(places, window - size)
        self._automaton.make_automaton()

    def _windows_around(self, places: list[tuple[int, int]], reach: int) -> list[dict[str, set[str]]]:
        found: list[dict[str, set[str]]] = [{} for _ in range(reach + 1)]
        for item, at in places:
            names, own = self._items[item]
            for before in range(min(at, reach) + 1):
                words = own[at - before : at - before + self._window]
                if len(words) == self._window:
                    found[before].setdefault(f" {' '.join(words)}", set()).update(names)
        return found

    def hits(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """The number of words, the runs of hit words, and the items that occur."""
        words = folded(text).split()
        if not words or not self._items:
            return len(words), [], set()
        line = f" {b' '.join(words).decode('latin-1')} "
        starts: list[int] = []
        done: dict[tuple[int, int], int] = {}
        runs, names = [], set()
        for end, (length, size, places) in self._automaton.iter(line):
            if not starts:
                plain = [word.decode("latin-1") for word in words]
                starts = [0, *np.cumsum([len(word) + 1 for word in words]).tolist()]
            first = bisect.bisect_left(starts, end - length + 1)
            if len(places) > FEW and (known := self._windows.get(line[end - length + 1 : end + 1])):
                for before, table in enumerate(known):
                    a = first - before
                    if a >= 0 and a + self._window < len(starts):
                        found = table.get(line[starts[a] : starts[a + self._window]])
                        if found is not None:
                            runs.append((a, a + self._window))
                            names |= found
                continue
            for item, at in places:
                own_names, own = self._items[item]
                a, b = first, first + size
                if len(own) >= self._window:
                    if done.get((item, first - at), -1) >= b:
                        continue
                    shift = at - first
                    while a > 0 and a + shift > 0 and plain[a - 1] == own[a + shift - 1]:
                        a -= 1
                    while b < len(plain) and b + shift < len(own) and plain[b] == own[b + shift]:
                        b += 1
                    done[item, -shift] = b
                    if b - a < self._window:
                        continue
                runs.append((a, b))
                names |= own_names
        return len(words), _merged(runs), names


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def word_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as offsets into the text as it is, in code points."""
    if not runs:
        return []
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    is_word = np.frombuffer(folded(text), np.uint8) != 32
    edges = np.diff(np.concatenate([[0], is_word.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in runs]


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The documents with ``_n_words``, ``_runs`` of hit words and ``_items``."""
    spark = docs.sparkSession
    items = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    part = F.pmod(F.xxhash64("name", "text"), F.lit(parts))
    names = docs.columns
    at = names.index(text_col)
    runs_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def one_pass(df: DataFrame, number: int) -> DataFrame:
        # About PART_BYTES of text: see parts.
        chosen = items.where(part == number).collect()
        held = spark.sparkContext.broadcast([(row.name, row.text) for row in chosen])

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(held.value, window)
            for batch in sliced(batches, at):
                found = [matcher.hits(text) for text in batch.column(at).to_pylist()]
                counts = pa.array([n for n, _, _ in found], pa.int64())
                old = batch.column("_runs").to_pylist() if number else [[]] * len(found)
                old_items = batch.column("_items").to_pylist() if number else [[]] * len(found)
                merged = [
                    _merged(runs + [(x["first"], x["last"]) for x in more])
                    for (_, runs, _), more in zip(found, old, strict=True)
                ]
                runs = [[{"first": a, "last": b} for a, b in row] for row in merged]
                ids = [sorted(ids | set(more)) for (_, _, ids), more in zip(found, old_items, strict=True)]
                columns = [batch.column(name) for name in names]
                columns += [counts, pa.array(runs, runs_type), pa.array(ids, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, [*names, "_n_words", "_runs", "_items"])

        schema = docs.limit(0).selectExpr(
            "*",
            "0L as _n_words",
            "cast(array() as array<struct<first:int,last:int>>) as _runs",
            "cast(array() as array<string>) as _items",
        ).schema
        return df.mapInArrow(find, schema)

    out = one_pass(docs, 0)
    for number in range(1, parts):
        out = one_pass(settle(out, scratch_path(spark, "passages")), number)
    return out


def contaminated(docs: DataFrame, items: DataFrame, share: int = SHARE, **names: str) -> DataFrame:
    """Flag documents of whose words one in ``share`` or more is hit.

    Adds ``n_words``, ``n_hit``, ``item_ids``, ``runs`` and ``contaminated``.
    """
    found = find_passages(docs, items, **names)
    hit = F.aggregate("_runs", F.lit(0).cast("bigint"), lambda n, run: n + run.last - run.first)
    return found.select(
        *docs.columns,
        F.col("_n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.col("_items").alias("item_ids"),
        F.col("_runs").alias("runs"),
        ((hit > 0) & (hit * share >= F.col("_n_words"))).alias("contaminated"),
    )
