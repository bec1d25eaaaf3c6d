"""Passages against a scan of every window."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from inkrank.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items, window=13):
    words = WORD.findall(lower(text))
    hit, names = set(), set()
    for name, other in items:
        own = WORD.findall(lower(other))
        size = min(window, len(own))
        for at in range(len(own) - size + 1) if own else ():
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[at : at + size]:
                    hit |= set(range(i, i + size))
                    names.add(str(name))
    return len(words), len(hit), sorted(names), sorted(hit)


def cases(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "B", "ab", "é", "É", "12", "x_y", "日本", "a-b"])
    make = lambda n: "".join(word() + rng.choice([" ", "  ", ", ", "\n", "\x00"]) for _ in range(n))
    items = [(i, make(rng.choice([0, 1, 3, 12, 13, 14, 20, 27, 40]))) for i in range(12)]
    items += [(3, make(15)), (20, items[5][1]), (21, None), (22, "a " * 30), (23, "?!")]
    texts = [None, "", "?!", "a " * 40, "B"]
    for _ in range(40):
        part = rng.choice(items)[1] or ""
        cut = rng.randint(0, 30)
        texts.append(make(rng.randint(0, 30)) + part[cut : cut + rng.randint(0, 200)] + make(rng.randint(0, 30)))
    return items, texts


@pytest.mark.parametrize("seed", range(12))
def test_matcher_equals_every_window(seed):
    items, texts = cases(seed)
    matcher = decontaminate.Matcher([(str(i), t) for i, t in items])
    for text in texts:
        n, runs, names = matcher.hits(text)
        hit = [w for a, b in runs for w in range(a, b)]
        assert (n, len(hit), sorted(names), hit) == brute(text, items)


def test_spans_point_into_the_text_as_it_is():
    text = "É, Ein  Wort—日本 12x y"
    assert [text[a:b] for a, b in decontaminate.word_spans(text, [(0, 2), (2, 3)])] == ["É, Ein", "Wort—日本"]


@pytest.mark.parametrize("part_bytes", [4 << 20, 100])
def test_query_equals_every_window(spark, documents, tmp_path, monkeypatch, part_bytes):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part_bytes)
    items, texts = cases(99)
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = queries.op4_decontamination(spark, str(tmp_path)).collect()
    found = {row.doc_id: tuple(row)[1:] for row in rows}
    assert len(rows) == len(texts)
    for doc, text in enumerate(texts):
        n, hits, names, _ = brute(text, items)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert found[doc] == (n, hits, len(names), digest, hits > 0 and 20 * hits >= n)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    some = decontaminate.contaminated(documents(["a b", None]), none).collect()
    assert [(r.n_hit, r.item_ids, r.contaminated) for r in some] == [(0, [], False)] * 2
    assert decontaminate.contaminated(documents([]), none).count() == 0


def test_other_names_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "one two", 5)], "key int, body string, item_id int")
    items = spark.createDataFrame([(7, "One  two", "x")], "n int, q string, text string")
    row = decontaminate.contaminated(docs, items, text_col="body", item_id="n", item_text="q").first()
    assert (row.key, row.item_id, row.n_hit, row.item_ids, row.contaminated) == (1, 5, 2, ["7"], True)


def test_long_text(spark, documents):
    text = "w " * 300_000 + "benchmark words " * 10
    items = spark.createDataFrame([(1, "benchmark words " * 10)], "item_id long, text string")
    row = decontaminate.contaminated(documents([text]), items).select("n_words", "n_hit", F.col("contaminated")).first()
    assert tuple(row) == (300_020, 20, False)


def test_items_that_begin_alike_are_not_tried_one_by_one():
    head = "one two three four five six seven"
    rng = random.Random(5)
    tails = [" ".join(rng.choices("abcdefgh", k=10)) for _ in range(20_000)]
    items = [(str(i), f"{head} {tail}") for i, tail in enumerate(tails)] + [("same", f"{head} {tails[7]}")]
    matcher = decontaminate.Matcher(items)
    text = " x ".join([f"{head} no more"] * 200 + [f"{head} {tails[7]}"])
    started = time.process_time()
    n, runs, names = matcher.hits(text)
    assert time.process_time() - started < 0.2
    start = len(text.split()) - 17
    assert (n, runs) == (len(text.split()), [(start, start + 17)])
    assert names >= {"7", "same"} and all(tails[int(i)][:11] == tails[7][:11] for i in names - {"same"})


@pytest.mark.parametrize("seed", range(12))
def test_every_block_by_its_windows(seed, monkeypatch):
    monkeypatch.setattr(decontaminate, "FEW", 0)
    test_matcher_equals_every_window(seed)
