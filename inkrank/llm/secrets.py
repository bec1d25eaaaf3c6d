"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

Candidates are long runs of key characters, values assigned to names such as
``password``, and private key headers, anywhere in a text. The forest sees each
candidate's length, its kinds of characters and changes between them, how much of
it dictionary words cover, the words beside it and the path it comes from.

It is trained on labelled findings: a small table made by rule from well-known
key formats and from look-alikes (digests, identifiers, placeholders), and, of
the corpus itself, the candidates that carry a provider's prefix or are assigned
to a credential's name. A table of reviewed findings can be given instead.

Edge cases: null and empty texts have no candidates; a null or absent path is a
path of its own; repeated rows get the same answer each.
"""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkrank.llm.common import lowest, sliced
from inkrank.session import scratch_path, settle

#: Bounds of the training table.
TRAINING_DOCS = 500
TRAINING_FINDINGS = 4000
#: The dictionary has the words in more than one of all documents and at least this share
#: of them, so at most a mean document's distinct words divided by it, whatever the input.
DICTIONARY_SHARE = 1e-4

TREES, DEPTH, LEAF = 40, 9, 3
SECRET = 0.5

_RUN = re.compile(r"(?<![A-Za-z0-9+/_.~-])[A-Za-z0-9+/_.~-]{16,}+={0,2}")
_NAMED = re.compile(
    r"(?i)(?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|bearer)"
    r"[\"']?[ \t]{0,3}[:= ][ \t]{0,3}[\"']?([^\s\"',;]{8,})"
)
_HEADER = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
#: Prefixes that providers give their keys.
_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "sk_live_", "rk_live_", "xoxb-", "xoxp-",
             "AIza", "SG.", "npm_", "hf_", "-----BEGIN")
_NAMES = ("password", "passwd", "pwd", "secret", "token", "key", "bearer", "credential")
_DUMMIES = ("example", "changeme", "placeholder", "xxxx", "dummy", "sample", "test", "your", "1234567890", "<", "${")
_DIGESTS = ("sha", "md5", "commit", "checksum", "digest", "hash", "etag", "uuid", "rev", "id")
_WORDS = re.compile(r"[A-Za-z]{3,}")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_HASHED = 8

Finding = tuple[int, int]


def candidates(text: str) -> list[Finding]:
    """Spans that may be secrets, left to right and free of overlaps."""
    found = [m.span() for m in _HEADER.finditer(text)] if "-----BEGIN" in text else []
    found += [m.span(1) for m in _NAMED.finditer(text)]
    for m in _RUN.finditer(text):
        run = m.group().rstrip(".")
        if any(map(str.isdigit, run)) and any(map(str.isalpha, run)):
            found.append((m.start(), m.start() + len(run)))
    out: list[Finding] = []
    for a, b in sorted(found, key=lambda s: (s[0], -s[1])):
        if out and a < out[-1][1]:
            continue
        out.append((a, b))
    return out


def _kinds(value: str) -> np.ndarray:
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)
    digit, upper = (codes >= 48) & (codes <= 57), (codes >= 65) & (codes <= 90)
    lower = (codes >= 97) & (codes <= 122) | (codes > 127)
    return np.where(digit, 0, np.where(upper, 1, np.where(lower, 2, 3)))


def _entropy(value: str) -> float:
    counts = np.array(list(Counter(value).values()), float)
    shares = counts / counts.sum()
    return float(-(shares * np.log2(shares)).sum())


def _slots(name: str) -> list[float]:
    out = [0.0] * _HASHED
    out[zlib.crc32(name.encode("utf-8", "surrogatepass")) % _HASHED] = 1.0
    return out


def features(text: str, span: Finding, path: str | None, dictionary: frozenset[str]) -> list[float]:
    a, b = span
    value = text[a:b]
    kinds = _kinds(value)
    shares = [float((kinds == k).mean()) for k in range(4)]
    changes = float((kinds[1:] != kinds[:-1]).mean()) if len(kinds) > 1 else 0.0
    lowered = value.lower()
    covered = sum(len(w) for w in _WORDS.findall(lowered) if w in dictionary)
    letters = [c for c in lowered if c.isalpha()]
    vowels = sum(c in "aeiou" for c in letters) / max(1, len(letters))
    left, right = text[max(0, a - 40) : a], text[b : b + 40]
    before, after = left.split()[-1:] or [""], right.split()[:1] or [""]
    near = left.lower()[-24:]
    return [
        float(len(value)),
        *shares,
        changes,
        _entropy(value),
        len(set(value)) / len(value),
        covered / len(value),
        vowels,
        float(all(c in "0123456789abcdef" for c in lowered)),
        float(bool(_UUID.search(value))),
        float(value.startswith(_PREFIXES)),
        float(any(x in lowered for x in _DUMMIES)),
        float(any(x in near for x in _NAMES)),
        float(any(x in near for x in _DIGESTS)),
        float(left.rstrip(" \"'")[-1:] in (":", "=")),
        float(left[-1:] in ("\"", "'")),
        float(lowered.count(".") + lowered.count("/")),
        *_slots(before[0].lower()[-20:]),
        *_slots(after[0].lower()[:20]),
        *_slots(path or ""),
        float(path is None),
        float(any(x in (path or "").lower() for x in ("test", "example", "doc"))),
    ]


# --- the forest -------------------------------------------------------------


@dataclass
class Tree:
    """Nodes as flat arrays: feature (-1 at a leaf), threshold, children, share."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def shares(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                break
            value = x[np.arange(len(x)), np.maximum(feature, 0)]
            at = np.where(inner, np.where(value <= self.threshold[at], self.left[at], self.right[at]), at)
        return self.share[at]


def _split(x: np.ndarray, y: np.ndarray, columns: np.ndarray) -> tuple[int, float] | None:
    """The column and threshold with the lowest Gini impurity."""
    best, n, total = (2 * y.mean() * (1 - y.mean()) * len(y) - 1e-9, None), len(y), y.sum()
    for column in columns:
        order = np.argsort(x[:, column], kind="stable")
        value, ones = x[order, column], np.cumsum(y[order])[:-1]
        size = np.arange(1, n)
        cut = (value[1:] > value[:-1]) & (size >= LEAF) & (n - size >= LEAF)
        if not cut.any():
            continue
        rest = total - ones
        impurity = 2 * ones * (1 - ones / size) + 2 * rest * (1 - rest / (n - size))
        impurity = np.where(cut, impurity, np.inf)
        i = int(impurity.argmin())
        if impurity[i] < best[0]:
            best = (impurity[i], (int(column), float((value[i] + value[i + 1]) / 2)))
    return best[1]


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> Tree:
    nodes: list[list[float]] = []
    tries = max(1, int(2 * math.sqrt(x.shape[1])))

    def add(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y[rows].mean())])
        if depth < DEPTH - 1 and 0 < nodes[at][4] < 1 and len(rows) >= 2 * LEAF:
            found = _split(x[rows], y[rows], rng.choice(x.shape[1], tries, replace=False))
            if found:
                low = x[rows, found[0]] <= found[1]
                nodes[at][:2] = found
                nodes[at][2] = add(rows[low], depth + 1)
                nodes[at][3] = add(rows[~low], depth + 1)
        return at

    add(rng.integers(0, len(x), len(x)), 0)
    table = np.array(nodes)
    return Tree(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4])


@dataclass
class Forest:
    trees: list[Tree]
    dictionary: frozenset[str]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.mean([tree.shares(x) for tree in self.trees], axis=0)


def train(rows: list[list[float]], secret: list[int], dictionary: frozenset[str], seed: int = 7) -> Forest:
    x, y = np.array(rows, float), np.array(secret, float)
    rng = np.random.default_rng(seed)
    return Forest([_grow(x, y, rng) for _ in range(TREES)], dictionary)


# --- labelled findings ------------------------------------------------------


def made_findings(count: int = 600, seed: int = 11) -> list[tuple[str, int, int, str, int]]:
    """Findings ``(text, start, end, path, secret)`` of known formats and look-alikes."""
    rng = random.Random(seed)
    alnum, hexa, upper = string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_uppercase + string.digits
    some = lambda chars, n: "".join(rng.choices(chars, k=n))
    plain = lambda: rng.choice(["the value", "we use", "see", "and so on", "of it", "line"])
    long_words = lambda n: "".join(rng.choices(["config", "service", "manager", "data", "item", "load", "user"], k=n))

    def secret() -> tuple[str, str]:
        name = rng.choice(["password", "secret", "token", "api_key", "access_key", "auth_token", "client_secret"])
        sign = rng.choice(["=", " = ", ": ", ":", "=\"", " = \"", ": '"])
        value = rng.choice([some(hexa, rng.choice([18, 24, 32, 40, 64])), some(alnum, rng.randint(16, 48)), some(alnum + "+/", 40)])
        key = rng.choice(["AKIA" + some(upper, 16), "ghp_" + some(alnum, 36), "sk_live_" + some(alnum, 24),
                          "xoxb-" + some(string.digits, 12) + "-" + some(alnum, 24), "AIza" + some(alnum + "_-", 35)])
        return rng.choice([(f"{name}{sign}", value), (f"{name}{sign}", value), (f"{plain()} ", key)])

    def other() -> tuple[str, str]:
        return rng.choice([
            lambda: (rng.choice(["sha256:", "md5 ", "commit ", "checksum: ", "etag=", "rev "]), some(hexa, rng.choice([32, 40, 64]))),
            lambda: (rng.choice(["id=", "uuid ", plain() + " "]), "-".join(some(hexa, n) for n in (8, 4, 4, 4, 12))),
            lambda: (rng.choice(["password=", "token: ", "secret = \""]), rng.choice(["changeme12345678", "your_token_here_1", "xxxxxxxxxxxx1", "example-password-1"])),
            lambda: (f"{plain()} ", f"{long_words(3)}{rng.randint(1, 99)}"),
            lambda: (f"{plain()} ", f"src/{long_words(2)}/{long_words(1)}_{rng.randint(1, 9)}.py"),
            lambda: (rng.choice(["token ", "password ", "secret "]), long_words(2)),
            lambda: (f"{plain()} ", f"www.{long_words(2)}.com/page/{rng.randint(1, 9999)}"),
        ])()

    out = []
    for i in range(count):
        label = i % 2
        lead, value = secret() if label else other()
        text = f"{plain()} {lead}{value}"
        out.append((f"{text}\" {plain()}" if lead.endswith('"') else f"{text} {plain()}", len(text) - len(value), len(text),
                    f"src{rng.randint(0, 20)}", label))
    return out


def _corpus_label(text: str, span: Finding) -> int | None:
    """1 where the form or the name settles it, 0 where it reads as words or a
    digest, None where it takes a judgement."""
    value, left = text[slice(*span)], text[max(0, span[0] - 24) : span[0]].lower()
    if any(x in value.lower() for x in _DUMMIES) or _UUID.search(value):
        return 0
    if value.startswith(_PREFIXES) and (len(value) >= 16 or value.startswith("-----")):
        return 1
    kinds = _kinds(value)
    if any(x in left for x in _NAMES) and left.rstrip(" \"'")[-1:] in (":", "="):
        return 1 if len(value) >= 12 and (kinds == 0).mean() >= 0.1 else None
    if (kinds == 0).mean() < 0.05 or (kinds == 2).mean() > 0.9:
        return 0
    return 0 if any(x in left for x in _DIGESTS[:6]) else None


def _with_path(docs: DataFrame) -> DataFrame:
    path = next((c for c in ("path", "url", "source") if c in docs.columns), None)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (F.col(path) if path else F.lit(None)).cast("string").alias("path"),
    )


def dictionary_of(docs: DataFrame) -> frozenset[str]:
    """The words of enough documents, counted over all of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            columns = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in sliced(batches, 0):
            for text in batch.column(0).to_pylist():
                seen[""] += 1  # the documents
                seen.update(set(_WORDS.findall(text.lower())))
            if len(seen) > 200_000:
                yield rows()
                seen.clear()
        if seen:
            yield rows()

    counts = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = settle(counts, scratch_path(docs.sparkSession, "word-counts"))
    total = counts.where("word = ''").first()
    if total is None:
        return frozenset()
    least = max(2, math.ceil(DICTIONARY_SHARE * total.n))
    return frozenset(row.word for row in counts.where((F.col("word") != "") & (F.col("n") >= least)).collect())


def fit(docs: DataFrame, findings: DataFrame | None = None) -> Forest:
    """Train on ``findings(text, start, end, path, secret)``, by default the made
    ones with those of ``TRAINING_DOCS`` documents (the lowest by hash of id)."""
    docs = _with_path(docs)
    ids = docs.where("doc_id is not null").where(F.col("text").rlike("[0-9]")).select("doc_id")
    ids = [row.doc_id for row in lowest(ids, ["doc_id"], TRAINING_DOCS).collect()]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["text", "start", "end", "path", "secret"]
        for batch in batches:
            rows = []
            for text, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for a, b in candidates(text):
                    if (secret := _corpus_label(text, (a, b))) is not None:
                        cut = max(0, a - 40)
                        rows.append((text[cut : b + 40], a - cut, b - cut, path, secret))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    own = []
    if ids:
        schema = "text string, start long, end long, path string, secret long"
        table = docs.where(F.col("doc_id").isin(ids)).mapInArrow(label, schema)
        table = settle(table, scratch_path(docs.sparkSession, "labelled-findings"))
        keys = ["text", "start", "end", "path"]
        own = lowest(table, keys, TRAINING_FINDINGS).collect()
    dictionary = dictionary_of(docs)
    if findings is not None:
        keys = ["text", "start", "end", "path"]
        own = lowest(findings.select(*keys, "secret"), keys, TRAINING_FINDINGS).collect()
        rows = [tuple(row) for row in own]
    else:
        rows = made_findings() + [(row.text, row.start, row.end, row.path, row.secret) for row in own]
    x = [features(text, (a, b), path, dictionary) for text, a, b, path, _ in rows]
    return train(x, [secret for *_, secret in rows], dictionary)


def scan(docs: DataFrame, forest: Forest | None = None) -> DataFrame:
    """``(doc_id, text, findings)``: each candidate's start, end and score."""
    held = docs.sparkSession.sparkContext.broadcast(forest or fit(docs))
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Forest = held.value
        for batch in sliced(batches):
            spans, rows = [], []
            for text, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans.append(candidates(text))
                rows += [features(text, span, path, own.dictionary) for span in spans[-1]]
            scores = iter(own.scores(np.array(rows, float)).tolist() if rows else [])
            found = [[{"start": a, "end": b, "score": next(scores)} for a, b in row] for row in spans]
            columns = [*batch.columns[:2], pa.array(found, pa.list_(item))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "findings"])

    schema = "doc_id long, text string, findings array<struct<start:bigint,end:bigint,score:double>>"
    return _with_path(docs).mapInArrow(find, schema)
