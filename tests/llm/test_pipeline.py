"""Stages of the pipeline: their columns, their decisions, and odd rows."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from inkrank.llm import decontaminate, pii, simhash

STAGES = dict(corpus_pipeline.STAGES)


def fingerprints(texts):
    return [simhash.fingerprint(t or "") for t in texts]


def test_stages_in_order(spark, small):
    assert list(STAGES) == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    matcher = decontaminate.Matcher(items)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, small).cache()
        assert after.columns == columns and after.schema.simpleString() == docs.schema.simpleString()
        old = {r.doc_id: r for r in before.collect()}
        new = {r.doc_id: r for r in after.collect()}
        assert len(new) == after.count() and set(new) <= set(old)
        if name == "quality":
            labels = spark.read.parquet(f"{small}/labels.parquet").where("quality = 1 AND coalesce(toxic, 0) = 0").collect()
            good = [r.doc_id for r in labels if r.doc_id in old]
            assert sum(d in new for d in good) >= 0.97 * len(good)
        if name == "near_duplicates":
            fps = fingerprints([r.text for r in old.values()])
            kept = set(fingerprints([r.text for r in new.values()]))
            assert len(kept) == len(new)
            far = [f for f in fps if all(bin(f ^ g).count("1") > 2 for g in set(fps) - {f})]
            assert set(far) <= kept
            assert not any(0 < bin(a ^ b).count("1") <= 2 for a in kept for b in kept)
        if name == "decontamination":
            for doc, row in old.items():
                n, runs, _ = matcher.hits(row.text)
                hit = sum(b - a for a, b in runs)
                assert (doc in new) == (not (hit and 20 * hit >= n))
        if name == "personal_data":
            assert set(new) == set(old)
            assert not any(pii.base_spans(r.text) for r in new.values())
            for doc, row in new.items():
                if not pii.base_spans(old[doc].text) and not re.search("[0-9]", old[doc].text):
                    assert row.text == old[doc].text
                assert row.n_chars == len(row.text)
        before = after
    packed = STAGES["packing"](spark, before, small).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in before.collect()}
    whole = corpus_pipeline.run(spark, small).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed))


@pytest.fixture(scope="module")
def odd(spark, documents):
    texts = [None, "", "a b c d", "a b c d", "Other words " * 20_000, "mail x@y.zz now"]
    pairs = [*enumerate(texts), (None, "no id at all"), (None, "no id at all"), (3, "third text here"), (5, "mail x@y.zz now")]
    docs = documents(pairs)
    return docs.withColumn("row", F.lit("clash")).withColumn("content", F.lit(1)).withColumn("views", F.lit(2))


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_rows(spark, odd, small, name):
    found = STAGES[name](spark, odd, small)
    rows = found.collect()
    if name == "packing":
        assert len(rows) >= odd.count()
        return
    assert found.columns == odd.columns
    if name == "near_duplicates":
        texts = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in rows)
        assert texts == sorted([(0, ""), (2, "a b c d"), (3, "third text here"), (4, "Other words " * 20_000),
                                (5, "mail x@y.zz now"), (-1, "no id at all")])
    else:
        assert len(rows) == odd.count()
    if name == "personal_data":
        assert {r.text for r in rows if r.doc_id == 5} == {"mail [EMAIL] now"}
        assert [r.text for r in rows if r.doc_id == 0] == [None]


@pytest.mark.parametrize("name", list(STAGES))
def test_no_rows(spark, documents, small, name):
    assert STAGES[name](spark, documents([]), small).count() == 0
