"""Linear-time markup against the patterns it stands for, and its running time."""

import random
import time

import pytest
from pyspark.sql import functions as F

import inkrank as ink
from inkrank.functions.markup import WIKI_BODY, WIKI_LINK, WIKI_TITLE, first_of, links_of

PARTS = ["<title>", "</title>", "<text", ">", "</text>", "[[", "]]", "[", "]", "<", "/", "a", "é😀", " ", "|",
         '<text xml:space="preserve">', "<text>", "\u0085", " "]


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(9)
    made = ["".join(rng.choices(PARTS, k=rng.randint(0, 24))) for _ in range(20_000)]
    made += ["<text></text>x</text>", "<text >]]", "[[]]", "[[]", "<title></title>y</title>", "<title>", "<text", ""]
    df = spark.createDataFrame([(x,) for x in made], "line STRING").repartition(8).cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("pattern", [WIKI_TITLE, WIKI_BODY])
def test_first_of_equals_the_pattern(lines, pattern):
    plain = F.regexp_extract("line", pattern, 1)
    wrong = lines.where(first_of(F.col("line"), pattern) != plain)
    assert [row.line for row in wrong.take(3)] == []


def test_links_of_equals_the_pattern(lines):
    plain = F.regexp_extract_all("line", F.lit(WIKI_LINK), 1)
    wrong = lines.where(links_of(F.col("line")) != plain)
    assert [row.line for row in wrong.take(3)] == []


def seconds(spark, line):
    df = spark.createDataFrame([(line,)], "line STRING")
    start = time.perf_counter()
    ink.extract_links(df).agg(F.count("*")).collect()
    ink.count_pages(df).collect()
    return time.perf_counter() - start


@pytest.mark.parametrize("piece", ["[[", "<text", "<text>", "<title>", ">", "]]", "<text>[[", "[[a"])
def test_unclosed_markup_takes_linear_time(spark, piece):
    seconds(spark, "warm up")
    assert seconds(spark, "<title>x</title><text>" + piece * (800_000 // len(piece))) < 5
    assert seconds(spark, "<title>x</title><text>" + piece * (800_000 // len(piece)) + "</text>") < 8


def test_links_are_found_once_per_line(spark, plan):
    df = spark.createDataFrame([("x",)], "line STRING")
    text = plan(ink.extract_links(df))
    above, below = text.split("Generate", 1)
    assert "regexp" not in above and below.count("regexp_extract_all") == 1


def test_null_ends_are_no_links(spark):
    rows = [("a", "b"), ("a", None), (None, "b"), ("c", None)]
    edges = spark.createDataFrame(rows, "src STRING, dst STRING")
    assert [tuple(r) for r in ink.out_degree(edges).collect()] == [("a", 1)]
    assert [tuple(r) for r in ink.link_counts(edges).collect()] == [("a", "b", 1)]
    assert [r.node for r in ink.initial_ranks(edges, 2).collect()] == ["a"]
