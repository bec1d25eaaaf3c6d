"""Deep-shallow sorting, anchors, and removal against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkrank.llm import anchors, deepshallow, queries, suffixes


@pytest.mark.parametrize("seed", range(6))
def test_sort(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, rng.choice([2, 3, 256]), (rng.choice([0, 1, 2, 700]), 50)).astype(np.uint8)
    if len(rows) > 2:
        shared = rng.integers(0, 50, len(rows))
        for i in range(1, len(rows)):
            rows[i, : shared[i]] = rows[rng.integers(0, i), : shared[i]]
    order, common = deepshallow.sort(rows)
    strings = [row.tobytes() for row in rows]
    assert sorted(order.tolist()) == list(range(len(rows)))
    assert [strings[i] for i in order] == sorted(strings)
    for k in range(1, len(rows)):
        a, b = strings[order[k - 1]], strings[order[k]]
        assert common[k] == next((i for i in range(50) if a[i] != b[i]), 50)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(2)
    units = anchors.byte_units()[rng.integers(0, 3, 3000)]
    starts = np.array([0, 10, 10, 900, 1000, 3000])
    found = anchors.Anchors(units, starts, 4, 12)
    covered = {}
    for at, first, last in zip(found.at, found.first, found.last, strict=True):
        for i in range(first, last + 1):
            assert i <= at <= i + 8 and i not in covered
            covered[i] = at - i
    inside = [i for a, b in zip(starts[:-1], starts[1:], strict=True) for i in range(a, b - 11)]
    assert sorted(covered) == inside
    by_content = {}
    for i in inside:
        assert by_content.setdefault(units[i : i + 12].tobytes(), covered[i]) == covered[i]


def test_lowest_of_runs():
    rng = np.random.default_rng(4)
    for size, wide in ((1, 1), (5, 5), (100, 7), (1000, 35), (64, 13)):
        hashes = rng.integers(0, 4, size).astype(np.uint64) << np.uint64(60)
        hashes |= rng.integers(0, 1 << 20, size).astype(np.uint64)
        key = hashes >> np.uint64(24)
        expected = [i + int(np.argmin(key[i : i + wide])) for i in range(size - wide + 1)]
        assert anchors.lowest_of(hashes, wide).tolist() == expected
        assert anchors._lowest_of_many(key, wide).tolist() == expected


def brute(docs, window=50):
    first = {}
    for doc, text in docs:
        key = -(1 << 63) if doc is None else doc
        data = (text or "").encode()
        for i in range(len(data) - window + 1):
            part = data[i : i + window]
            first[part] = min(key, first.get(part, key))
    out = []
    for doc, text in docs:
        key = -(1 << 63) if doc is None else doc
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            if first[data[i : i + window]] < key:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed, docs=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("ab é", k=rng.randint(1, 6)))
    make = lambda n: " ".join(word() for _ in range(n))
    passages = [make(rng.choice([8, 12, 30, 80])) for _ in range(8)] + ["x" * 300, "ab" * 60, "\0" * 70]
    out = []
    for i in range(docs):
        parts = [rng.choice([make(rng.randint(0, 20)), rng.choice(passages)]) for _ in range(rng.randint(0, 6))]
        text = rng.choice(["", " ", "\n"]).join(parts)
        if out and rng.random() < 0.2:
            text = rng.choice(out)[1] or ""
            cut = rng.randint(0, len(text))
            text = text[:cut] + rng.choice(["", "z", "zz"]) + text[cut + rng.randint(0, 2) :]
        out.append((rng.choice([i, i, i * 7 % 50 + 100]), text))
    return [*out, (None, passages[2]), (None, None), (500, passages[2] + "q" + passages[3])]


def run(spark, path, docs):
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    table.withColumn("doc", F.lit("clash")).withColumn("grp", F.lit(9)).write.parquet(f"{path}/documents.parquet")
    rows = queries.op1_suffix_array(spark, str(path)).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(anchors, "SLICE_BYTES", 400)
    docs = made(seed)
    assert run(spark, tmp_path, docs) == brute(docs)


def test_given_documents(spark, small, tmp_path):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, tmp_path, docs) == brute(docs)


def test_long_and_hot_texts(spark, tmp_path):
    line = "the same line stands in very many of these documents, word for word. "
    docs = [(i, f"{i * 7919} before {line}{i * 104729} after") for i in range(400)]
    docs += [(1000, "ab " * 100_000), (1001, "ab " * 50_000), (1002, "a" * 200_000)]
    docs += [(2000 + i, line * 3) for i in range(100)]
    assert run(spark, tmp_path, docs) == brute(docs)


def test_no_rows(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_a_third_of_the_rows_without_id(spark, tmp_path, monkeypatch):
    """They spread over the groups, and still count as one document before all others."""
    monkeypatch.setattr(anchors, "GROUP_BYTES", 2000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 500)
    line = "one line of more than fifty bytes that stands in every document here"
    docs = [(None if i % 3 == 0 else i, f"{'n' * (i % 5)} {i} {line} {i * 31}") for i in range(240)]
    assert run(spark, tmp_path, docs) == brute(docs)


@pytest.mark.parametrize("kinds", [1, 3, 40])
def test_classes_in_order_and_found_among_many(kinds):
    """Anchors of one row and of many, with equal windows and equal ids among them."""
    rng = np.random.default_rng(kinds)
    anchor = rng.integers(0, 60, 500).astype(np.uint64) << np.uint64(58)
    context = rng.integers(0, kinds, 500).astype(np.uint64) << np.uint64(57)
    doc = rng.integers(-3, 3, 500)
    order = suffixes._by_class(anchor, context, doc)
    by_hand = np.lexsort((doc, context, anchor))
    for column in (anchor, context, doc):
        assert (column[order] == column[by_hand]).all()
    pairs = sorted(set(zip(anchor.tolist(), context.tolist(), strict=True)))
    group = object.__new__(suffixes._Group)
    group._own = tuple(np.array(column, np.uint64) for column in zip(*pairs, strict=True))
    found = group.find(anchor, context)
    assert [pairs[i] for i in found] == list(zip(anchor.tolist(), context.tolist(), strict=True))
    assert len(suffixes._by_class(anchor[:0], context[:0], doc[:0])) == len(group.find(anchor[:0], context[:0])) == 0
