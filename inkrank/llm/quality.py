"""Quality and toxicity of documents by co-training two views, text and page.

The text view sees the content: which words of a vocabulary occur in the whole
text, how many words with a beginning of it do, and what its characters and
repetitions are like. The page view sees the
metadata alone: language, source and size. Each is a logistic regression on
labelled documents. In every round each view labels unlabelled documents it is sure
of, and those join the other view's training rows. At the end both views are
calibrated on labelled rows held out from training, and one logistic regression on
the two calibrated log-odds scores every document. This is done for two labels,
quality and toxicity; a document is kept if it is good and not toxic.

The vocabulary is learnt from the labelled documents: the words and beginnings, by
a checksum of their small letters, that tell the classes of either label apart most.

Bounds, all of them parameters: ``MAX_LABELLED`` labelled rows (those whose ids
hash lowest), ``MAX_WORDS`` words per label, and about ``MAX_PSEUDO`` pseudo-labels
per label, view and round. Scores cover every document, whatever those bounds are.

Edge cases: a null text counts as empty; null or absent page columns are a value
of their own; labels without a document, or null, are ignored, and contradicting
labels of one id are averaged; rows of one id train as one, that of the least
checksum, and each has its own score; without labels of both classes of a label
there is nothing to learn: the score is the labels' mean (quality 0.5 and toxicity 0
without any) and no document is dropped for it.
"""

from __future__ import annotations

import math
import zlib
from collections .abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkrank.llm.common import lowest, sliced
from inkrank.session import scratch_path, settle

MAX_LABELLED = 20_000
MAX_WORDS = 1_000
MAX_PSEUDO = 1_000
ROUNDS = 3
SURE = 0.95
KEEP = 0.5

#: The labels and the score of each without any.
LABELS = {"quality": 0.5, "toxic": 0.0}

#: Words whose sums are made at a time.
_PART = 1 << 17

_LANGS, _SOURCES = 8, 32
_PENALTY = 1e-2

#: Spread that the weights of words are expected to have, as a variance; and the
#: likelihood ratio (as a chi-square) that a word needs, as there are many words.
_WORD_VARIANCE = 16.0
_TELLING = 18.0

#: Letters of a word's beginning, and how many different words with it make a step.
_BEGINNING = 5
_LEVELS = (1, 2, 3, 5, 8)

_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) | (_BYTES >= 128)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_STOP = np.isin(_BYTES, [ord(c) for c in ".,;:!?"])
_MARK = ~(_LETTER | _DIGIT | _SPACE | _STOP)

TEXT_FEATURES = 14
PAGE_FEATURES = 4 + _LANGS + _SOURCES


_EDGES = "\"'`.,;:!?()[]{}<>*#$%&+-_=/\\|~^@0123456789«»“”„‘’…–—"


#: Checksums have 40 bits: a polynomial of the bytes, mixed.
_BASE, _MIX, _MASK = 0x100000001B3, 0x9E3779B97F4A7C15, (1 << 40) - 1


def checksums(words: pa.Array) -> np.ndarray:
    """A number for each word, the same everywhere; 0 for an empty one."""
    starts = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]].astype(np.uint64)
    starts -= starts[0]
    sizes = np.diff(starts)
    powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, _BASE, np.uint64))
    place = np.arange(len(data)) - np.repeat(starts[:-1], sizes)
    found = np.zeros(len(words), np.uint64)
    if len(data):
        found[sizes > 0] = np.add.reduceat((data + np.uint64(1)) * powers[place], starts[:-1][sizes > 0])
        mixed = (found ^ (found >> np.uint64(32))) * np.uint64(_MIX)
        found = np.where(sizes > 0, (mixed >> np.uint64(24)) | np.uint64(1), np.uint64(0))
    return found.astype(np.int64)


def _step(begun: np.ndarray, level: int) -> np.ndarray:
    return (begun + level * _BASE) & _MASK


def _among(values: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    at = np.searchsorted(vocabulary, values)
    return vocabulary[np.minimum(at, len(vocabulary) - 1)] == values if len(vocabulary) else np.zeros(len(values), bool)


def contents(texts: pa.Array, vocabulary: np.ndarray | None = None) -> list[np.ndarray]:
    """What different words each text has, and of which beginnings it has how many: a
    step of ``_LEVELS`` is a feature of its own.

    As checksums, or as places in a sorted vocabulary, where words that tell nothing
    there are put aside before anything is sorted. A batch's different words are
    looked at once.
    """
    cut = pc.ascii_split_whitespace(texts)
    sizes = np.diff(cut.offsets.to_numpy())
    coded = cut.flatten().dictionary_encode()
    letters = pc.utf8_trim(pc.utf8_lower(coded.dictionary), _EDGES)
    plain, first, of = np.unique(checksums(letters), return_index=True, return_inverse=True)
    longer = pc.greater(pc.utf8_length(letters), _BEGINNING)
    begun = checksums(pc.if_else(longer, pc.utf8_slice_codeunits(letters, 0, _BEGINNING), ""))[first]
    telling = plain != 0
    if vocabulary is not None:
        steps = [_among(_step(begun, level), vocabulary) & (begun != 0) for level in _LEVELS]
        telling &= _among(plain, vocabulary) | np.logical_or.reduce(steps)
    word = of[coded.indices.to_numpy()]
    doc = np.repeat(np.arange(len(texts)), sizes)
    kept = telling[word]
    each = np.unique(doc[kept] * len(plain) + word[kept]) if len(plain) else np.zeros(0, np.int64)
    doc, word = each // max(1, len(plain)), each % max(1, len(plain))
    docs, features = [doc], [plain[word]]
    started = begun[word] != 0
    starts, number = np.unique(begun[word[started]], return_inverse=True)
    group, n = np.unique(doc[started] * len(starts) + number, return_counts=True)
    for level in _LEVELS:
        own = group[n >= level]
        docs.append(own // max(1, len(starts)))
        features.append(_step(starts[own % max(1, len(starts))], level))
    doc, feature = np.concatenate(docs), np.concatenate(features)
    if vocabulary is not None:
        inside = _among(feature, vocabulary)
        doc, feature = doc[inside], np.searchsorted(vocabulary, feature[inside])
    order = np.lexsort((feature, doc))
    counts = np.bincount(doc, minlength=len(texts))
    return np.split(feature[order], np.cumsum(counts)[:-1]) if len(texts) else []


def text_view(text: str) -> list[float]:
    """Shares of kinds of characters and of repeated words and lines."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(1, len(raw))
    words = raw.split()
    n = max(1, len(words))
    distinct = len(set(words))
    same = sum(map(bytes.__eq__, words, words[1:])) if len(words) > 1 else 0
    lines = raw.split(b"\n")
    letters = int(counts[_LETTER].sum())
    long_words = sum(len(word) > 25 for word in words) if size / n > 6 else 0
    return [
        letters / size,
        int(counts[_UPPER].sum()) / max(1, letters),
        int(counts[_DIGIT].sum()) / size,
        int(counts[_MARK].sum()) / size,
        min(1.0, int(counts[_MARK].sum()) / n),
        min(1.0, int(counts[_STOP].sum()) / n),
        distinct / n,
        math.log1p(n) - math.log1p(distinct),
        same / n,
        float(same > 0.05 * n),
        len(set(lines)) / len(lines),
        min(40.0, size / n) / 10,
        long_words / n,
        float(not words),
    ]


def page_view(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Size as the page states it, and the language and source by hash."""
    size = math.log1p(max(0, n_chars or 0)) / 5
    row = [size, size**2, float(lang is None), float(source is None)] + [0.0] * (_LANGS + _SOURCES)
    if lang is not None:
        row[4 + zlib.crc32(lang.encode("utf-8", "surrogatepass")) % _LANGS] = 1.0
    if source is not None:
        row[4 + _LANGS + zlib.crc32(source.encode("utf-8", "surrogatepass")) % _SOURCES] = 1.0
    return row


def _page_column(docs: DataFrame, name: str, kind: str) -> Column:
    return (F.col(name) if name in docs.columns else F.lit(None)).cast(kind)


def _inputs(docs: DataFrame, keep_rows: bool) -> DataFrame:
    """What the views are made of and, as one column ``row``, the document itself, so
    that extra columns clash with nothing."""
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] * keep_rows
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        _page_column(docs, "lang", "string").alias("lang"),
        _page_column(docs, "source", "string").alias("source"),
        _page_column(docs, "n_chars", "bigint").alias("n_chars"),
        *row,
    )


def _features(batch: pa.RecordBatch, vocabulary: np.ndarray | None) -> tuple[list[list[float]], list[np.ndarray]]:
    langs, sources, sizes, texts = (batch.column(i).to_pylist() for i in (2, 3, 4, 1))
    pages = map(page_view, langs, sources, sizes)
    dense = [[*text_view(text), *page] for text, page in zip(texts, pages, strict=True)]
    return dense, contents(batch.column(1), vocabulary)


def views_of(docs: DataFrame, vocabulary: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, views, words)`` of each document: the features of both views, and
    the places of its words in a sorted vocabulary; without one, all their
    checksums."""

    def view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows, kept = _features(batch, vocabulary)
            columns = [batch.column(0), pa.array(rows, pa.list_(pa.float32())), pa.array(kept, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "views", "words"])

    return _inputs(docs, keep_rows=False).mapInArrow(view, "doc_id long, views array<float>, words array<long>")


def _one_per_id(views: DataFrame) -> DataFrame:
    """One row of each id, the same whenever it is asked for."""
    row = F.struct(F.xxhash64("views", "words").alias("h"), "views", "words")
    return views.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(row).alias("r")).select("doc_id", "r.views", "r.words")


# --- the classifiers --------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Logistic:
    """Logistic regression on standardized columns."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = _PENALTY) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
        weights = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], penalty)
        ridge[-1] = 1e-6
        loss = np.inf
        for _ in range(30):
            p = _sigmoid(z @ weights)
            grad = z.T @ (p - y) / len(y) + ridge * weights
            bend = (z * (p * (1 - p))[:, None]).T @ z / len(y) + np.diag(ridge + 1e-9)
            weights = weights - np.linalg.solve(bend, grad)
            p = np.clip(_sigmoid(z @ weights), 1e-12, 1 - 1e-12)
            now = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() + (ridge * weights**2).sum() / 2
            if abs(loss - now) < 1e-9:
                break
            loss = now
        return cls(mean, scale, weights)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]


@dataclass
class Rows:
    """Training or scoring rows: the features of both views, how many words each row
    has, and all their words. The driver holds them for each label and view, so they
    stay as small as they came, and sums over words are made in parts."""

    dense: np.ndarray
    counts: np.ndarray
    word: np.ndarray

    @classmethod
    def of(cls, views, words) -> Rows:
        dense = np.stack([np.asarray(x, np.float32) for x in views]) if len(views) else np.zeros((0, TEXT_FEATURES + PAGE_FEATURES), np.float32)
        counts = np.array([len(x) for x in words], np.int64)
        flat = np.concatenate([np.asarray(x, np.int64) for x in words]) if len(words) else np.zeros(0, np.int64)
        return cls(dense, counts, flat)

    @classmethod
    def of_table(cls, table: pa.Table) -> Rows:
        """Of the columns ``views`` and ``words``, without a Python object for each value."""
        views, words = (table[name].combine_chunks() for name in ("views", "words"))
        dense = views.flatten().to_numpy().reshape(len(views), TEXT_FEATURES + PAGE_FEATURES)
        return cls(dense, np.diff(words.offsets.to_numpy()).astype(np.int64), words.flatten().to_numpy())

    def take(self, chosen: np.ndarray) -> Rows:
        return Rows(self.dense[chosen], self.counts[chosen], self.word[np.repeat(chosen, self.counts)])

    def plus(self, other: Rows) -> Rows:
        both = ((getattr(self, name), getattr(other, name)) for name in ("dense", "counts", "word"))
        return Rows(*map(np.concatenate, both))

    def wordless(self) -> Rows:
        """What the page view needs of them."""
        return Rows(self.dense, np.zeros_like(self.counts), self.word[:0].copy())

    def text(self) -> np.ndarray:
        return self.dense[:, :TEXT_FEATURES].astype(np.float64)

    def page(self) -> np.ndarray:
        return self.dense[:, TEXT_FEATURES:].astype(np.float64)

    def _parts(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs of rows with some ``_PART`` words: their bounds and their words."""
        ends = np.concatenate([[0], np.cumsum(self.counts)])
        cuts = np.searchsorted(ends, np.arange(_PART, ends[-1], _PART))
        bounds = np.unique([0, *cuts, len(self.counts)])
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield a, b, self.word[ends[a] : ends[b]]

    def by_row(self, of_words: np.ndarray) -> np.ndarray:
        """The sum of a value of words over each row."""
        found = np.zeros(len(self.counts))
        for a, b, words in self._parts():
            found[a:b] = np.bincount(np.repeat(np.arange(b - a), self.counts[a:b]), of_words[words], b - a)
        return found

    def by_word(self, of_rows: np.ndarray, n_words: int) -> np.ndarray:
        """The sum of a value of rows over each word; a part goes on from the sums before
        it, so that how the rows are parted changes no digit."""
        found, each = np.zeros(n_words), np.arange(n_words)
        for a, b, words in self._parts():
            values = np.repeat(of_rows[a:b], self.counts[a:b])
            found = np.bincount(np.concatenate([each, words]), np.concatenate([found, values]), n_words)
        return found


@dataclass
class TextView:
    """Logistic regression on the shape of a text and the words that occur in it."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    of_words: np.ndarray
    bias: float

    @classmethod
    def fit(cls, rows: Rows, y: np.ndarray, n_words: int) -> TextView:
        x = rows.text()
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = (x - mean) / scale
        ridge = np.concatenate([np.full(TEXT_FEATURES, _PENALTY), np.full(n_words, 1 / (_WORD_VARIANCE * len(y))), [1e-6]])

        def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
            odds = z @ w[:TEXT_FEATURES] + rows.by_row(w[TEXT_FEATURES:-1]) + w[-1]
            wrong = _sigmoid(odds) - y
            grad = np.concatenate([z.T @ wrong, rows.by_word(wrong, n_words), [wrong.sum()]])
            value = (np.logaddexp(0, odds) - y * odds).mean() + (ridge * w * w).sum() / 2
            return value, grad / len(y) + ridge * w

        w = _minimum(loss, np.zeros(len(ridge)))
        return cls(mean, scale, w[:TEXT_FEATURES], w[TEXT_FEATURES:-1], float(w[-1]))

    def odds(self, rows: Rows) -> np.ndarray:
        shape = ((rows.text() - self.mean) / self.scale) @ self.weights
        return shape + rows.by_row(self.of_words) + self.bias


def _minimum(loss, w: np.ndarray, steps: int = 200, memory: int = 10) -> np.ndarray:
    """Of a smooth convex function, by quasi-Newton steps of limited memory."""
    value, grad = loss(w)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way = grad.copy()
        parts = []
        for moved, turned in reversed(pairs):
            part = moved @ way / (moved @ turned)
            parts.append(part)
            way -= part * turned
        if pairs:
            moved, turned = pairs[-1]
            way *= moved @ turned / (turned @ turned)
        for (moved, turned), part in zip(pairs, reversed(parts), strict=True):
            way += moved * (part - turned @ way / (moved @ turned))
        size = 1.0
        while True:
            next_value, next_grad = loss(w - size * way)
            if next_value <= value - 1e-4 * size * (grad @ way) or size < 1e-10:
                break
            size /= 2
        moved, turned = -size * way, next_grad - grad
        done = value - next_value < 1e-9
        w, value, grad = w + moved, next_value, next_grad
        if done:
            break
        if moved @ turned > 1e-12:
            pairs = [*pairs, (moved, turned)][-memory:]
    return w


@dataclass
class PageView:
    """Logistic regression on the metadata."""

    model: Logistic

    @classmethod
    def fit(cls, rows: Rows, y: np.ndarray, n_words: int) -> PageView:
        return cls(Logistic.fit(rows.page(), y))

    def odds(self, rows: Rows) -> np.ndarray:
        return self.model.odds(rows.page())


_VIEWS = (TextView, PageView)


@dataclass
class Model:
    """Both views of one label, their calibrations and the combination; or a constant."""

    views: list = field(default_factory=list)
    calibrations: list[Logistic] = field(default_factory=list)
    combination: Logistic | None = None
    constant: float = 0.5

    def calibrated(self, rows: Rows) -> np.ndarray:
        both = zip(self.calibrations, self.views, strict=True)
        return np.stack([c.odds(view.odds(rows)[:, None]) for c, view in both], axis=1)

    def scores(self, rows: Rows) -> np.ndarray:
        """Rows of: score, the text view's probability, the page view's."""
        if self.combination is None:
            return np.full((len(rows.dense), 3), self.constant)
        odds = self.calibrated(rows)
        return np.column_stack([_sigmoid(self.combination.odds(odds)), _sigmoid(odds)])


@dataclass
class Training:
    """What one label's views are trained on so far."""

    label: str
    rows: list[Rows]
    y: list[np.ndarray]
    held: Rows
    held_y: np.ndarray
    count: tuple[int, int]
    views: list = field(default_factory=list)
    taken: list[set[int]] = field(default_factory=lambda: [set(), set()])

    def train(self, n_words: int) -> None:
        self.views = [kind.fit(r, y, n_words) for kind, r, y in zip(_VIEWS, self.rows, self.y, strict=True)]

    def model(self) -> Model:
        found = Model(self.views)
        # Few held-out rows say little, and then clean documents should stay.
        penalty = 1 / len(self.held_y)
        for view in self.views:
            found.calibrations.append(Logistic.fit(view.odds(self.held)[:, None], self.held_y, penalty))
        found.combination = Logistic.fit(found.calibrated(self.held), self.held_y, penalty)
        return found


def _sure(pool: DataFrame, trainings: list[Training], turn: int) -> pa.Table:
    """Of each label and view, about its ``count`` unlabelled rows of each class that
    the view is sure of: ``(kind, doc_id, views, words)``."""
    held = pool.sparkSession.sparkContext.broadcast([view for t in trainings for view in t.views])

    @F.pandas_udf("array<double>")
    def probabilities(views: pd.Series, words: pd.Series) -> pd.Series:
        rows = Rows.of(views, words)
        return pd.Series(list(np.stack([_sigmoid(view.odds(rows)) for view in held.value], axis=1)))

    scored = pool.withColumn("p", probabilities("views", "words"))
    places = [(view, y) for view in range(2 * len(trainings)) for y in (0, 1)]
    sure = {(v, y): F.col("p")[v] >= SURE if y else F.col("p")[v] <= 1 - SURE for v, y in places}
    found = scored.agg(*[F.count_if(sure[place]).alias(f"n{i}") for i, place in enumerate(places)]).first()
    # The rows that hash lowest of each kind, cut off where they are read.
    picked = []
    for i, (view, y) in enumerate(places):
        share = min(1.0, trainings[view // 2].count[y] / max(1, found[i]))
        low = F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.lit(1 << 30)) < int(share * (1 << 30))
        picked.append(F.when(sure[view, y] & low, F.lit(i)))
    kinds = F.array_compact(F.array(*picked))
    # About four times MAX_PSEUDO rows of each label, one per id and kind.
    words = F.col("words").cast("array<int>").alias("words")
    return scored.select(F.explode(kinds).alias("kind"), "doc_id", "views", words).toArrow()


def _vocabulary(labelled: DataFrame, names: list[str], most: int) -> np.ndarray:
    """The words that tell a label's classes apart most, by the likelihood ratio of
    their occurrence, of each label, as far as it is beyond chance; sorted.

    Words are counted where they are read, and at most ``most`` of each label come
    to the driver."""
    found = [np.zeros(0, np.int64)]
    words = labelled.select(F.explode("words").alias("word"), *[f"y_{name}" for name in names])
    for name in names:
        one, zero = (F.count_if(F.col(f"y_{name}") >= 0.5), F.count_if(F.col(f"y_{name}") < 0.5))
        n_one, n_zero = labelled.agg(one, zero).first()
        if not n_one or not n_zero:
            continue
        seen = words.groupBy("word").agg(one.alias("one"), zero.alias("zero"))
        parts = []
        for column, n in (("one", n_one), ("zero", n_zero)):
            expected = (F.col("one") + F.col("zero")) * (n / (n_one + n_zero))
            parts.append(F.when(F.col(column) > 0, F.col(column) * F.log(F.col(column) / expected)).otherwise(0.0))
        told = seen.select("word", (2 * (parts[0] + parts[1])).alias("told")).where(F.col("told") >= _TELLING)
        best = told.orderBy(F.desc("told"), "word").limit(most).collect()
        found.append(np.array([row.word for row in best], np.int64))
    return np.unique(np.concatenate(found))


def _labelled(docs: DataFrame, labels: DataFrame, names: list[str], most: int) -> DataFrame:
    """At most ``most`` documents with a label: ``doc_id``, a column per label,
    ``views`` and the checksums of all their ``words``."""
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = _known_labels(labels, names).join(ids, "doc_id", "left_semi")
    # At most ``most`` rows of some 30 bytes.
    chosen = settle(lowest(settle(known, scratch_path(spark, "labels")), ["doc_id"], most), scratch_path(spark, "labelled"))
    own = docs.withColumn("doc_id", F.col("doc_id").cast("bigint")).join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    return settle(_one_per_id(views_of(own)).join(F.broadcast(chosen), "doc_id"), scratch_path(spark, "labelled-views"))


def _known_labels(labels: DataFrame, names: list[str]) -> DataFrame:
    """``(doc_id, y_<label>, …)``: the mean of each label of each id that has any."""
    present = [name for name in names if name in labels.columns]
    means = [(F.avg(name) if name in present else F.any_value(F.lit(None).cast("double"))).alias(f"y_{name}") for name in names]
    by_id = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(*means)
    return by_id.where(" OR ".join(f"y_{name} IS NOT NULL" for name in names))


def _in_vocabulary(labelled: DataFrame, names: list[str], vocabulary: np.ndarray) -> pa.Table:
    """The labelled rows with the places of their words, in the order of ids: some
    700 bytes each."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for own in batch.column(2):
                found = np.sort(own.values.to_numpy())
                kept.append(np.searchsorted(vocabulary, found[_among(found, vocabulary)]))
            words = pa.array(kept, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], words, *batch.columns[3:]], batch.schema.names)

    rows = labelled.select("doc_id", "views", "words", *[f"y_{name}" for name in names])
    schema = rows.withColumn("words", F.col("words").cast("array<int>")).schema
    return rows.mapInArrow(look_up, schema).orderBy("doc_id").toArrow()


def _training(label: str, rows: Rows, y: np.ndarray, max_pseudo: int) -> Training | float:
    """A label's training and held-out rows; the mean if it has one class only."""
    known = ~np.isnan(y)
    if not known.any():
        return LABELS[label]
    binary = (y >= 0.5).astype(float)
    if binary[known].min() == binary[known].max():
        return float(y[known].mean())
    # Every fifth of each class is held out; with very few rows they serve twice.
    apart = np.zeros(len(y), bool)
    for value in (0.0, 1.0):
        apart[np.flatnonzero(known & (binary == value))[::5]] = True
    own, held = known & ~apart, apart
    if min((own & (binary == v)).sum() for v in (0.0, 1.0)) == 0:
        own = held = known
    share = binary[known].mean()
    count = (max(1, int(max_pseudo * (1 - share))), max(1, int(max_pseudo * share)))
    mine = rows.take(own)
    return Training(label, [mine, mine.wordless()], [binary[own]] * 2, rows.take(held), binary[held], count)


def _started(table: pa.Table, names: list[str], max_pseudo: int) -> dict[str, Training | float]:
    """Of each label; what the table holds beside it can go."""
    rows = Rows.of_table(table)
    return {name: _training(name, rows, table[f"y_{name}"].to_numpy().astype(float), max_pseudo) for name in names}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rounds: int = ROUNDS,
    max_labelled: int = MAX_LABELLED,
    max_words: int = MAX_WORDS,
    max_pseudo: int = MAX_PSEUDO,
) -> tuple[np.ndarray, dict[str, Model]]:
    """Co-train on the documents and ``labels(doc_id, quality, toxic)``: the
    vocabulary, and the model of each label."""
    names = list(LABELS)
    labelled = _labelled(docs, labels, names, max_labelled)
    vocabulary = _vocabulary(labelled, names, max_words)
    started = _started(_in_vocabulary(labelled, names, vocabulary), names, max_pseudo)
    trainings = [x for x in started.values() if isinstance(x, Training)]
    for training in trainings:
        training.train(len(vocabulary))
    if trainings and rounds:
        pool = _one_per_id(views_of(docs, vocabulary)).join(_known_labels(labels, names), "doc_id", "left_anti")
        pool = settle(pool, scratch_path(docs.sparkSession, "views"))
        for turn in range(rounds):
            if not _exchange(_sure(pool, trainings, turn), trainings, len(vocabulary)):
                break
    return vocabulary, {
        name: x.model() if isinstance(x, Training) else Model(constant=x) for name, x in started.items()
    }


def _exchange(sure: pa.Table, trainings: list[Training], n_words: int) -> bool:
    """Hand each view's sure rows to the other view and train again."""
    kinds, ids = sure["kind"].to_numpy(), sure["doc_id"].to_numpy()
    order = np.lexsort((ids, kinds))
    moved = False
    for at, training in enumerate(trainings):
        for view in (0, 1):
            # A view is sure of one class of an id at most, so no id comes twice.
            chosen = order[kinds[order] // 2 == 2 * at + 1 - view]
            chosen = chosen[[i not in training.taken[view] for i in ids[chosen].tolist()]]
            if not len(chosen):
                continue
            moved = True
            training.taken[view].update(ids[chosen].tolist())
            more = Rows.of_table(sure.take(chosen))
            training.rows[view] = training.rows[view].plus(more.wordless() if view else more)
            training.y[view] = np.append(training.y[view], kinds[chosen] % 2.0)
    for training in trainings if moved else []:
        training.train(n_words)
    return moved


_FOUND = ["score", "p_text", "p_page", "toxic", "toxic_text", "toxic_page"]


def classify(docs: DataFrame, labels: DataFrame, keep_rows: bool = True, **bounds: int) -> DataFrame:
    """``(doc_id, found[, row])`` of every document: ``found`` has ``score``, ``p_text``
    and ``p_page`` of quality, ``toxic``, ``toxic_text`` and ``toxic_page``, and
    ``keep``; ``row`` is the document as it is."""
    vocabulary, models = fit(docs, labels, **bounds)
    held = docs.sparkSession.sparkContext.broadcast((vocabulary, models))
    kinds = [*[(name, pa.float64()) for name in _FOUND], ("keep", pa.bool_())]
    names = ["doc_id", "found"] + ["row"] * keep_rows

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, models = held.value
        for batch in sliced(batches):
            views, words = _features(batch, vocabulary)
            rows = Rows.of(np.asarray(views, np.float32), words)
            good, bad = (models[name].scores(rows) for name in ("quality", "toxic"))
            keep = (good[:, 0] >= KEEP) | (models["quality"].combination is None)
            keep &= (bad[:, 0] < KEEP) | (models["toxic"].combination is None)
            columns = [pa.array(x, kind) for x, (_, kind) in zip([*good.T, *bad.T, keep], kinds, strict=True)]
            struct = pa.StructArray.from_arrays(columns, [name for name, _ in kinds])
            row = batch.columns[5:]
            yield pa.RecordBatch.from_arrays([batch.column(0), struct, *row], names)

    taken = _inputs(docs, keep_rows)
    found = F.struct(*[F.lit(None).cast("boolean" if n == "keep" else "double").alias(n) for n, _ in kinds])
    schema = taken.select("doc_id", found.alias("found"), *["row"] * keep_rows).schema
    return taken.mapInArrow(score, schema)
