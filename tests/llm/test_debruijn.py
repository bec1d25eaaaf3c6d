"""Removal of repeated word windows against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from inkrank.llm import anchors, queries

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(docs, window=20):
    first = {}
    rows = [(-(1 << 63) if doc is None else doc, doc, WORD.findall((text or "").encode())) for doc, text in docs]
    for key, _, words in rows:
        for i in range(len(words) - window + 1):
            part = tuple(words[i : i + window])
            first[part] = min((key, i), first.get(part, (key, i)))
    out = []
    for key, doc, words in rows:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (key, i):
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, path, docs):
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    table.withColumn("doc", F.lit("clash")).withColumn("grp", F.lit(9)).write.parquet(f"{path}/documents.parquet")
    rows = queries.op8_debruijn(spark, str(path)).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


def made(seed, docs=60):
    rng = random.Random(seed)
    make = lambda n: " ".join(rng.choices(["a", "b", "c", "é", "dd", "\x1c", "x\u0085"], k=n))
    passages = [make(rng.choice([15, 19, 20, 21, 30, 80])) for _ in range(8)] + ["x " * 60, "a b " * 40]
    out = []
    for i in range(docs):
        parts = [rng.choice([make(rng.randint(0, 12)), rng.choice(passages)]) for _ in range(rng.randint(0, 6))]
        text = rng.choice([" ", "\n", " \t "]).join(parts)
        if out and rng.random() < 0.2:
            words = (rng.choice(out)[1] or "").split(" ")
            words[rng.randint(0, len(words)) : rng.randint(0, len(words))] = [rng.choice(["z", "zz"])]
            text = " ".join(words)
        out.append((i * 7 % 61, text))
    return [*out, (None, passages[2]), (None, None), (500, passages[2] + " q " + passages[3]), (501, "")]


@pytest.mark.parametrize("seed", range(4))
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(anchors, "SLICE_BYTES", 400)
    docs = made(seed)
    assert run(spark, tmp_path, docs) == brute(docs)


def test_given_documents(spark, small, tmp_path):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, tmp_path, docs) == brute(docs)


def test_long_and_hot_texts(spark, tmp_path):
    line = "the same line of words stands in very many of these documents and it has more than twenty words in it all told . "
    docs = [(i, f"{i * 7919} before {line}{i * 104729} after") for i in range(400)]
    docs += [(1000, "ab " * 100_000), (1001, "ab cd " * 20_000), (1002, "a" * 200_000)]
    docs += [(2000 + i, line * 3) for i in range(100)]
    assert run(spark, tmp_path, docs) == brute(docs)


def test_rows_of_one_id_count_as_one_document(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(30))
    found = run(spark, tmp_path, [(1, text), (1, text), (2, text + " end")])
    assert [(doc, removed) for doc, _, removed, _ in found] == [(1, 0), (1, 0), (2, 30)]


def test_no_rows(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_a_third_of_the_rows_without_id(spark, tmp_path, monkeypatch):
    """They spread over the groups, and still count as one document before all others."""
    monkeypatch.setattr(anchors, "GROUP_BYTES", 2000)
    line = " ".join(f"w{i}" for i in range(25))
    docs = [(None if i % 3 == 0 else i, f"{'n' * (i % 5)} {i} {line} {i * 31}") for i in range(240)]
    assert run(spark, tmp_path, docs) == brute(docs)
    texts, groups = anchors.grouped(spark.createDataFrame(docs, "doc_id long, text string"))
    sizes = [row["count"] for row in texts.where(F.col("doc") == anchors.NO_ID).groupBy("grp").count().collect()]
    assert groups > 10 and len(sizes) > 10 and max(sizes) < 25
