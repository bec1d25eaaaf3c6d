"""Searching, with the published scores among the cases."""

import math

import pytest
from pyspark.sql import functions as F

import inkrank as ink
from inkrank.functions.text import folded
from inkrank.operators.search import _wanted, scored_in_cells
from inkrank.operators.search import query_weights

GOLDEN_COUNTS = [
    ("computer", "cp.html", 1),
    ("science", "cp.html", 1),
    ("computer", "plrabn12.txt", 1),
    ("science", "plrabn12.txt", 1),
    ("computer", "lcet10.txt", 6),
    ("science", "lcet10.txt", 259),
    ("data", "cp.html", 1),
    ("analysis", "cp.html", 8),
    ("data", "lcet10.txt", 6),
    ("analysis", "lcet10.txt", 396),
]
GOLDEN = {
    "computer science": {
        "cp.html": 1.128542860877125,
        "lcet10.txt": 2.9293874899838332,
        "plrabn12.txt": 1.128542860877125,
    },
    "data analysis": {"cp.html": 2.029172820795612, "lcet10.txt": 3.757555406896782},
    "data data": {"cp.html": 1.3979400086720377, "lcet10.txt": 2.4857487743815057},
}


@pytest.fixture(scope="module")
def index(spark):
    counts = spark.createDataFrame(GOLDEN_COUNTS, "term STRING, doc STRING, n BIGINT")
    return ink.tf_idf(counts, 8).cache()


def scores(df):
    return {row.doc: row.score for row in df.collect()}


@pytest.mark.parametrize("query", GOLDEN)
def test_golden_scores(index, query):
    assert scores(ink.search(index, query)) == pytest.approx(GOLDEN[query], abs=1e-12)


def test_case_does_not_matter(spark, index):
    assert scores(ink.search(index, "COMPUTER Science")) == pytest.approx(
        GOLDEN["computer science"], abs=1e-12
    )
    upper = spark.createDataFrame(
        [("Data", "X.txt", 1.0), ("data", "x.TXT", 2.0)], "term STRING, doc STRING, tf_idf DOUBLE"
    )
    assert scores(ink.search(upper, "dATA")) == {"x.txt": 3.0}


@pytest.mark.parametrize("query", ["", "   ", "absent", "computer,science"])
def test_no_match(index, query):
    assert scores(ink.search(index, query)) == {}


def test_leading_blanks_add_no_term(index):
    assert scores(ink.search(index, "  data data ")) == pytest.approx(
        GOLDEN["data data"], abs=1e-12
    )


def test_query_weights():
    assert query_weights(" A b\ta\x0bA ") == {"a": 3, "b": 1}


def test_result_order(index):
    docs = [row.doc for row in ink.in_document_order(ink.search(index, "data science")).collect()]
    assert docs == ["cp.html", "lcet10.txt", "plrabn12.txt"]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_table_of_queries(spark, index, broadcast_bytes):
    texts = [(i, text) for i, text in enumerate(GOLDEN)] + [(8, ""), (9, "absent")]
    queries = spark.createDataFrame(texts, "query_id BIGINT, query_text STRING")
    result = ink.search_many(index, queries, broadcast_bytes=broadcast_bytes)
    found = {(r.query_id, r.doc): r.score for r in result.collect()}
    expected = {(i, doc): s for i, q in enumerate(GOLDEN) for doc, s in GOLDEN[q].items()}
    assert found == pytest.approx(expected, abs=1e-12)


def test_table_of_queries_equals_single_queries(spark, small):
    docs = ink.table_corpus(spark.read.parquet(f"{small}/documents.parquet"), "doc_id")
    tokens = ink.tokenize(docs)
    index = ink.tf_idf(ink.doc_word_count(tokens), ink.corpus_size(docs)).cache()
    texts = {1: "the of and", 2: "thtion attion the", 3: "der die und"}
    queries = spark.createDataFrame(list(texts.items()), "query_id INT, query_text STRING")
    one_by_one = {
        (i, doc): score
        for i, text in texts.items()
        for doc, score in scores(ink.search_tokens(tokens, ink.corpus_size(docs), text)).items()
    }
    for limit in (0, 1 << 20):
        result = ink.search_many(index, queries, folded=True, broadcast_bytes=limit)
        found = {(r.query_id, r.doc): r.score for r in result.collect()}
        assert found == pytest.approx(one_by_one, abs=1e-9)


@pytest.mark.parametrize("query", ["the", "thtion attion", "THE the.", ". ,", "nowhere", ""])
def test_texts_without_the_terms_can_be_skipped(spark, small, query):
    docs = ink.table_corpus(spark.read.parquet(f"{small}/documents.parquet"), "doc_id")
    size = ink.corpus_size(docs)
    skipping = scores(ink.search_texts(docs, size, query))
    assert skipping == pytest.approx(scores(ink.search_tokens(ink.tokenize(docs), size, query)), abs=1e-9)


def test_matches_are_added_up_without_another_shuffle(spark, index, plan):
    queries = spark.createDataFrame([(1, "data")], "query_id BIGINT, query_text STRING")
    after_documents = plan(ink.search_many(index, queries)).split("REPARTITION_BY_COL")[0]
    assert after_documents.count("Exchange hashpartitioning") == 1


def test_saved_index(spark, index, plan, tmp_path):
    path = str(tmp_path / "index")
    ink.write_index(index, path)
    saved = ink.read_index(spark, path)
    result = ink.search(saved, "computer science", folded=True)
    assert scores(result) == pytest.approx(GOLDEN["computer science"], abs=1e-12)
    assert "PushedFilters: [In(term, [computer,science,ſcience,scıence,ſcıence])]" in plan(result) or (
        "PushedFilters: [In(term, [computer,sc" in plan(result)
    )
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        ink.write_index(index, path)
    ink.write_index(index, path, overwrite=True)
    assert ink.read_index(spark, path).count() == len(GOLDEN_COUNTS)


def test_saved_index_has_lower_case_terms(spark, tmp_path):
    path = str(tmp_path / "index")
    mixed = spark.createDataFrame([("Data", "x", 1.0)], "term STRING, doc STRING, tf_idf DOUBLE")
    ink.write_index(mixed, path)
    assert scores(ink.search(ink.read_index(spark, path), "data", folded=True)) == {"x": 1.0}


def test_packed_text_index(spark, tmp_path):
    rows = [
        ("#", "fields.c", 0.25),
        ("######", "a b=c.txt", 0.5),
        ("   (", "x.txt", 1e-9),
        ("tab\tterm", "x.txt", math.pi),
    ]
    index = spark.createDataFrame(rows, "term STRING, doc STRING, tf_idf DOUBLE")
    path = str(tmp_path / "packed")
    ink.write_packed(index, path)
    back = ink.read_packed(spark, path)
    assert {tuple(r) for r in back.collect()} == set(rows)
    assert scores(ink.search(back, "#")) == {"fields.c": 0.25}


def test_search_reads_two_columns_of_text_only(spark, small, plan):
    docs = ink.table_corpus(spark.read.parquet(f"{small}/documents.parquet"), "doc_id")
    result = ink.search_texts(docs, ink.corpus_size(docs), "thtion")
    text = plan(result)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "Python" not in text


@pytest.mark.parametrize(
    ("term", "query", "hit"),
    [("ısı", "ISI", True), ("i", "ı", True), ("ı", "i", True), ("σοφος", "ΣΟΦΟΣ", True), ("σοφοσ", "σοφος", True),
     ("ſo", "SO", True), ("so", "ſo", True), ("straße", "STRASSE", False), ("straße", "STRAßE", True),
     ("data", "DATA", True), ("ÄRGER", "ärger", True), ("a", "b", False)],
)
def test_case_folds_character_by_character(spark, term, query, hit):
    index = spark.createDataFrame([(term, "x", 1.0)], "term STRING, doc STRING, tf_idf DOUBLE")
    lowered = index.withColumn("term", F.lower("term"))
    assert scores(ink.search(index, query)) == ({"x": 1.0} if hit else {})
    assert scores(ink.search(lowered, query, folded=True)) == ({"x": 1.0} if hit else {})
    queries = spark.createDataFrame([(1, query)], "query_id INT, query_text STRING")
    assert ink.search_many(lowered, queries, folded=True).count() == int(hit)


def test_terms_of_very_many_spellings(spark):
    index = spark.createDataFrame([("mıſsissippissi", "x", 2.0)], "term STRING, doc STRING, tf_idf DOUBLE")
    assert scores(ink.search(index, "MISSISSIPPISSI", folded=True)) == {"x": 2.0}
    texts = spark.createDataFrame([("d", "a mıſsissippissi b")], "doc STRING, text STRING")
    assert set(scores(ink.search_texts(texts, 1, "mississippissi"))) == {"d"}


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_table_of_queries_on_texts(spark, small, broadcast_bytes):
    docs = ink.table_corpus(spark.read.parquet(f"{small}/documents.parquet"), "doc_id")
    size = ink.corpus_size(docs)
    index = ink.tf_idf(ink.doc_word_count(ink.tokenize(docs)), size)
    rows = [(1, "the of and THE"), (2, "thtion ſo"), (3, ""), (4, "nowhere")]
    queries = spark.createDataFrame(rows, "query_id INT, query_text STRING")
    found, expected = (
        {(r.query_id, r.doc): r.score for r in df.collect()}
        for df in (
            ink.search_many_texts(docs, size, queries, broadcast_bytes=broadcast_bytes),
            ink.search_many(index, queries, folded=True),
        )
    )
    assert found == pytest.approx(expected, abs=1e-9) and found


def _many(spark):
    rows = [(f"t{i % 7}", f"D{i % 31}", float(i % 5 + 1)) for i in range(31 * 7)] + [(None, "D1", 9.0)]
    index = spark.createDataFrame(rows, "term STRING, doc STRING, tf_idf DOUBLE")
    asked = [(None, "t1 T1 t2"), (3, "t0 t3 t4 zz"), (3, "t4"), (4, ""), (5, None), (6, "t6")]
    return index, spark.createDataFrame(asked, "query_id BIGINT, query_text STRING")


@pytest.mark.parametrize("bytes_", [0, 1 << 20])
def test_matches_are_added_up_where_they_arise(spark, plan, bytes_):
    index, queries = _many(spark)
    result = ink.search_many(index, queries, broadcast_bytes=bytes_)
    # Neither the matches nor their sums are moved.
    joined = plan(result).split("Join")[0]
    assert "Exchange" not in joined
    expected = {}
    for row in index.where("term IS NOT NULL").collect():
        for query in queries.collect():
            times = (query.query_text or "").lower().split().count(row.term)
            if times:
                key = (query.query_id, row.doc.lower())
                expected[key] = expected.get(key, 0.0) + times * row.tf_idf
    assert {(r.query_id, r.doc): r.score for r in result.collect()} == pytest.approx(expected)


def test_queries_of_several_columns(spark, tmp_path):
    index, queries = _many(spark)
    whole = ink.search_many(index, queries)
    path = str(tmp_path / "postings")
    index.select(F.lower("doc").alias("doc"), F.coalesce("term", F.lit("")).alias("term"), "tf_idf").write.parquet(path)
    cut = scored_in_cells(spark, path, _wanted(queries, "query_id", "query_text"), "query_id", cell_bytes=100)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_texts_are_split_once_for_many_queries(spark, plan):
    texts = spark.createDataFrame([("a", "x y"), ("b", "y z")], "doc STRING, text STRING")
    counts = ink.doc_word_count(ink.tokenize(texts))
    index = ink.tf_idf(counts, 2)
    postings = index.select(F.coalesce(folded(F.col("term")), F.lit("")).alias("t"))
    wanted = spark.createDataFrame([("y",)], "t STRING")
    assert "isnotnull(CASE" not in plan(postings.join(F.broadcast(wanted), "t"))


def test_packed_lines_without_mark_or_tab(spark, tmp_path):
    lines = ["a#####b\t2", "a######b\t1", "no mark\t3", "a#####no tab", "x\ty#####z\t4", "", "#####\t5", "a#####b#####c\tq"]
    spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.text(str(tmp_path / "p"))
    found = {(r.term, r.doc, r.n) for r in ink.read_packed(spark, str(tmp_path / "p"), "n").where("term <> 'a#####b'").collect()}
    assert found == {("a", "b", 2.0), ("a#", "b", 1.0), ("", "", None), ("x\ty", "z", 4.0), ("", "", 5.0)}


def test_order_of_packed_lines_moves_the_ends_only(spark, tmp_path, plan):
    for name, lines in (("one", ["a#####1\t1", "c#####1\t1", "b#####1\t1", "b#####1\t2"]), ("two", ["é#####1\t1"])):
        (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "15")
    try:
        found = ink.packed_order(spark, str(tmp_path))
        assert {(r.ordered, r.n_lines) for r in found.collect()} == {(True, 4), (False, 1)}
        text = plan(found).split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert text.rindex("Window") < text.index("MapInArrow")
    assert {(r.ordered, r.n_lines) for r in ink.packed_order(spark, str(tmp_path)).collect()} == {(True, 4), (False, 1)}
