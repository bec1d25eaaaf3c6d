"""Co-training on held-out labels, and its edge cases."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkrank.llm import quality, queries


def test_logistic_finds_a_plane():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.0] + 0.5)))).astype(float)
    found = quality.Logistic.fit(x, y, 1e-6)
    raw = found.weights[:-1] / found.scale
    assert np.allclose(raw, [2, -1, 0], atol=0.2)


def test_held_out_accuracy(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet").where("quality is not null")
    known, held = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")
    held = held.withColumnRenamed("toxic", "toxic_label")
    rows = quality.classify(docs, known).select("doc_id", "found.*").join(held, "doc_id").collect()
    assert len(rows) > 50
    right = np.mean([(row.score >= 0.5) == (row.quality == 1) for row in rows])
    usual = np.mean([row.quality for row in rows])
    assert right >= 0.95 and right > usual
    clean = [row.keep for row in rows if row.quality == 1 and row.toxic_label == 0]
    assert np.mean(clean) >= 0.98


def test_held_out_toxic_documents_are_dropped(spark):
    """In four languages; some hundred labelled toxic documents are enough."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1")
    known, held = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("y"))
    known = known.unionByName(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 0"))
    rows = quality.classify(docs, known).select("doc_id", "found.keep").join(held, "doc_id").collect()
    toxic = [row.keep for row in rows if row.y == 1]
    assert len(toxic) > 100 and np.mean(toxic) <= 0.1
    assert np.mean([row.keep for row in rows if row.y == 0]) >= 0.98


def test_the_least_of_a_convex_function():
    rng = np.random.default_rng(2)
    half = rng.normal(size=(30, 30))
    bend, least = half @ half.T + np.eye(30), rng.normal(size=30)

    def loss(w):
        return (w - least) @ bend @ (w - least) / 2, bend @ (w - least)

    assert np.allclose(quality._minimum(loss, np.zeros(30)), least, atol=1e-3)


def training_table(rng, n, n_words, **columns):
    """Rows as the driver gets them: words that tell the label, and many that don't."""
    words = [np.flatnonzero(rng.random(n_words) < 0.3).astype(np.int32) for _ in range(n)]
    views = rng.random((n, quality.TEXT_FEATURES + quality.PAGE_FEATURES)).astype(np.float32)
    kinds = {"views": pa.list_(pa.float32()), "words": pa.list_(pa.int32())}
    table = {"doc_id": pa.array(range(n)), "views": pa.array(list(views), kinds["views"]), "words": pa.array(words, kinds["words"]), **columns}
    return pa.table(table), np.array([float(0 in row) for row in words])


def test_training_takes_a_few_times_its_table(monkeypatch):
    rng = np.random.default_rng(6)
    n, n_words = 4000, 400
    table, y = training_table(rng, n, n_words)
    sure, _ = training_table(rng, n // 2, n_words, kind=pa.array(np.arange(n // 2, dtype=np.int32) % 8))
    monkeypatch.setattr(quality, "_PART", 1 << 12, raising=False)
    tracemalloc.start()
    rows = quality.Rows.of_table(table)
    trainings = [quality._training(label, rows, y, 1000) for label in ("quality", "toxic")]
    for training in trainings:
        training.train(n_words)
    assert quality._exchange(sure, trainings, n_words)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 4 * (table.nbytes + sure.nbytes)
    assert [len(y) for t in trainings for y in t.y] == [n - len(trainings[0].held_y) + n // 8] * 4
    assert np.argmax(np.abs(trainings[0].views[0].of_words)) == 0


def test_sure_rows_join_the_other_view_once():
    rng = np.random.default_rng(8)
    table, y = training_table(rng, 200, 20)
    sure, _ = training_table(rng, 12, 20, kind=pa.array([3, 2, 1, 0, 7, 6, 5, 4, 0, 1, 2, 2], pa.int32()))
    trainings = [quality._training(label, quality.Rows.of_table(table), y, 100) for label in ("quality", "toxic")]
    before = [len(y) for t in trainings for y in t.y]
    assert quality._exchange(sure, trainings, 20) and not quality._exchange(sure, trainings, 20)
    assert [t.taken for t in trainings] == [[{0, 1, 10, 11}, {2, 3, 8, 9}], [{4, 5}, {6, 7}]]
    added = [y[n:].tolist() for y, n in zip([y for t in trainings for y in t.y], before, strict=True)]
    assert added == [[0, 0, 0, 1], [0, 0, 1, 1], [0, 1], [0, 1]]
    # By class and id: 1, 10, 11, 0.
    views = np.array(sure["views"].to_pylist(), np.float32)
    assert np.array_equal(trainings[0].rows[0].dense[-4:], views[[1, 10, 11, 0]])
    assert trainings[0].rows[0].word[-len(sure["words"][0]) :].tolist() == sure["words"][0].as_py()


@pytest.mark.parametrize("size", [1, 7, 1 << 17])
def test_sums_of_words_in_parts_are_the_same(monkeypatch, size):
    rng = np.random.default_rng(7)
    words = [[], *[np.flatnonzero(rng.random(30) < 0.4) for _ in range(50)], [], []]
    rows = quality.Rows.of([np.zeros(3)] * len(words), words)
    row, word = np.repeat(np.arange(len(words)), [len(x) for x in words]), np.concatenate(words).astype(int)
    of_words, of_rows = rng.normal(size=30), rng.normal(size=len(words))
    monkeypatch.setattr(quality, "_PART", size)
    assert np.array_equal(rows.by_row(of_words), np.bincount(row, of_words[word], len(words)))
    assert np.array_equal(rows.by_word(of_rows, 30), np.bincount(word, of_rows[row], 30))
    none = quality.Rows.of([], [])
    assert none.by_row(of_words).tolist() == [] and none.by_word(np.zeros(0), 2).tolist() == [0, 0]


def words_of(*texts, vocabulary=None):
    return [set(found.tolist()) for found in quality.contents(pa.array(texts, pa.string()), vocabulary)]


def sums(*words):
    return set(quality.checksums(pa.array(words)).tolist())


def test_words_are_those_of_the_whole_text():
    late = sums("x", "late", "é")
    one, none, words, two = words_of("beginnings", "", "x " * 100_000 + "“Late”, LATE! 12 é. É", "Beginnings begin... begins, beginner")
    assert words == late and none == set()
    assert len(one) == 2 and one < two and len(two) == 4 + 3
    vocabulary = np.unique([*two, 5, *late])
    places = words_of("late", "Beginnings begin... begins, beginner 12", vocabulary=vocabulary)
    assert [{int(vocabulary[i]) for i in found} for found in places] == [sums("late"), two]
    assert 0 not in late and len(late) == 3 and sums("", "") == {0}
    assert quality.checksums(pa.array(["", "a", "", "bc", ""]).slice(1, 3)).tolist() == quality.checksums(pa.array(["a", "", "bc"])).tolist()
    assert words_of("late", "x", vocabulary=np.zeros(0, np.int64)) == [set(), set()]


def test_vocabulary_takes_the_telling_words(spark):
    rows = [([1, 2, 9 + i], 1.0, None) for i in range(20)] + [([1, 3], 0.0, None) for _ in range(20)]
    table = spark.createDataFrame(rows, "words array<long>, y_quality double, y_toxic double")
    assert quality._vocabulary(table, ["quality", "toxic"], 2).tolist() == [2, 3]
    assert quality._vocabulary(table, ["quality", "toxic"], 1).tolist() == [2]


def test_a_word_in_toxic_documents_only(spark, documents):
    """Nothing but the word tells them apart, and it stands among many others."""
    rng = np.random.default_rng(4)
    plain = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(plain, 60)) for _ in range(600)]
    texts = [t + " Vile, " + " ".join(rng.choice(plain, 60)) if i % 5 == 0 else t for i, t in enumerate(texts)]
    docs = documents(texts)
    labels = docs.where("doc_id < 300").selectExpr("doc_id", "1 quality", "cast(doc_id % 5 = 0 as int) toxic")
    found = quality.classify(docs, labels).select("doc_id", "found.keep").collect()
    held = [row for row in found if row.doc_id >= 300]
    assert np.mean([row.keep for row in held if row.doc_id % 5]) >= 0.98
    assert np.mean([row.keep for row in held if row.doc_id % 5 == 0]) <= 0.1


def test_many_rows_of_one_id_change_nothing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    more = spark.range(5000).select(F.lit(-5).cast("bigint").alias("doc_id"), F.concat(F.lit("same text "), "id").alias("text"))
    wider = docs.unionByName(more, allowMissingColumns=True)
    taken = []

    def counted(table, trainings, n_words):
        taken.append(table.num_rows)
        return real(table, trainings, n_words)

    real = quality._exchange
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "_exchange", counted)
        quality.fit(docs, labels, rounds=1)
        quality.fit(wider, labels, rounds=1)
    assert abs(taken[0] - taken[1]) <= 4


def test_query_scores_every_document(spark, small):
    rows = queries.op5_quality(spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert sorted(row.doc_id for row in rows) == sorted(row.doc_id for row in docs.select("doc_id").collect())
    assert all(0 <= value <= 1 for row in rows for value in (row.score, row.p_text, row.p_page))
    assert rows[0].__fields__ == ["doc_id", "score", "p_text", "p_page", "toxic", "toxic_text", "toxic_page", "keep"]
    again = queries.op5_quality(spark, small).collect()
    assert {r.doc_id: round(r.score, 9) for r in rows} == {r.doc_id: round(r.score, 9) for r in again}


@pytest.mark.parametrize("labels", [[], [(0, None), (None, 1), (99, 0)], [(0, 1), (1, 1)]])
def test_without_both_classes_all_are_kept(spark, documents, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = quality.classify(documents([None, "", "a b c"]), table).select("found.*").collect()
    assert len(rows) == 3 and all(row.keep for row in rows)
    assert {row.score for row in rows} == {1.0 if len(labels) == 2 else 0.5}


def test_odd_rows(spark, documents):
    texts = ["word " * 50_000, None, "", "%%% &&&", "a b", "퟿ é", "x" * 100_000]
    docs = documents([*enumerate(texts), (None, "a"), (4, "a b"), (4, "a b")])
    docs = docs.withColumn("views", F.lit("clash")).withColumn("found", F.lit(1)).withColumn("row", F.lit(2))
    labels = spark.createDataFrame([(0, 0, 0), (4, 1, 0), (4, 1, 1), (6, 0, 1)], "doc_id long, quality int, views int")
    found = quality.classify(docs, labels).select("row.*", F.col("found.score").alias("s"))
    assert found.columns[: len(docs.columns)] == docs.columns
    rows = found.collect()
    assert len(rows) == len(texts) + 3 and len({row.s for row in rows if row.doc_id == 4}) == 1
    assert quality.classify(documents([]), labels).count() == 0


def test_without_page_columns(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c", "%%% %%%"] * 10)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 = 0 as int) quality")
    rows = quality.classify(docs, labels).select("doc_id", "found.keep").collect()
    assert all(row.keep == (row.doc_id % 2 == 0) for row in rows)
