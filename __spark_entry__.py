"""Registered queries and, for each, the SQL whose result it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import inkrank as ink
from inkrank.functions.markup import HTML_BODY, HTML_LINK, WIKI_TITLE, first_of
from inkrank.functions.text import query_terms_of
from inkrank.operators.skew import hot_keys, lookup
from inkrank.session import scratch_path, settle, spread

TWO_TERMS = "thtion attion"
REPEATED_TERM = "thtion thtion attion"
MIXED_CASE = "THTION Attion"


# --- inputs -----------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.table_corpus(_table(spark, sf_dir, "documents"), "doc_id")


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.tokenize(spread(_documents(spark, sf_dir)))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.doc_word_count(_tokens(spark, sf_dir))


def _n_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.corpus_size(_documents(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.tf_idf(_counts(spark, sf_dir), _n_docs(spark, sf_dir))


def _page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "html")
    return ink.table_lines(spread(pages), "html")


def _wiki_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wiki page line per line item: the supplier links to part and order."""
    items = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey")
    items = spread(items)
    line = F.format_string(
        '<page><title>S%d</title><text xml:space="preserve">x [[P%d]] y [[O%d]]</text></page>',
        "l_suppkey",
        "l_partkey",
        "l_orderkey",
    )
    return items.select(line.alias("line"))


#: Orders whose line items go into one page line of a supplier: a bound on its links.
ORDERS_PER_LINE = 1000


def _hub_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wiki page lines of each supplier, with a link for each of its line items. A
    supplier has a line per range of orders, so no line grows with the table."""
    items = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey")
    link = F.format_string("x [[P%d]] ] y", F.col("l_partkey"))
    text = F.array_join(F.collect_list(link), " ").alias("text")
    start = F.format_string('<page><title>S%d</title><text xml:space="preserve">', "l_suppkey")
    orders = F.floor(F.col("l_orderkey") / ORDERS_PER_LINE).alias("orders")
    pages = items.groupBy("l_suppkey", orders).agg(text)
    return pages.select(F.concat(start, F.col("text"), F.lit(" [[</text></page>")).alias("line"))


def _trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers link to the parts they ship, and parts back where a large
    shipment was returned; parts without that are targets but not nodes."""
    items = _table(spark, sf_dir, "lineitem")
    supplier = F.concat(F.lit("S"), F.col("l_suppkey"))
    part = F.concat(F.lit("P"), F.col("l_partkey"))
    returned = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)
    there = items.select(supplier.alias("src"), part.alias("dst"))
    back = items.where(returned).select(part.alias("src"), supplier.alias("dst"))
    return there.unionByName(back)


def _n_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = ink.out_degree(_trade_edges(spark, sf_dir))
    return sources.agg(F.count("*").alias("n_pages"))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


# --- text -------------------------------------------------------------------


def corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ink.table_lines(spread(_documents(spark, sf_dir)))
    return lines.groupBy(F.col("doc").alias("doc_id")).agg(F.count("*").alias("n_lines"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    found = ink.tokenize(spread(turns))
    return found.groupBy("conv_id", "turn", "term").agg(F.count("*").alias("n"))


def doc_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ink.term_frequency(_counts(spark, sf_dir)), "tf")


def corpus_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _n_docs(spark, sf_dir)


def doc_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ink.doc_frequency(_counts(spark, sf_dir), _n_docs(spark, sf_dir)), "idf")


def tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_index(spark, sf_dir), "tf_idf")


def tf_idf_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ink.tf_idf_window(_counts(spark, sf_dir), _n_docs(spark, sf_dir))
    return _rounded(index, "tf_idf")


def _searched(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    texts = spread(_documents(spark, sf_dir))
    result = ink.search_texts(texts, _n_docs(spark, sf_dir), query)
    return _rounded(ink.in_document_order(result), "score")


def search_two_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _searched(spark, sf_dir, TWO_TERMS)


def search_repeated_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _searched(spark, sf_dir, REPEATED_TERM)


def search_case_insensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    by_source = documents.select(F.upper("source").alias("doc"), "text")
    result = ink.search_texts(spread(by_source), _n_docs(spark, sf_dir), MIXED_CASE)
    return _rounded(result, "score")


def search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ink.search(_index(spark, sf_dir), TWO_TERMS, folded=True), "score")


def query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "benchmark")
    terms = items.select("item_id", F.explode(query_terms_of(F.col("text"))).alias("term"))
    return terms.groupBy("item_id", "term").agg(F.count("*").alias("times"))


def search_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "benchmark")
    texts = spread(_documents(spark, sf_dir))
    result = ink.search_many_texts(texts, _n_docs(spark, sf_dir), items, "item_id", "text")
    return _rounded(result, "score")


def search_many_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "benchmark")
    result = ink.search_many(_index(spark, sf_dir), items, "item_id", "text", folded=True)
    return _rounded(result, "score")


def search_many_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As for queries too large to broadcast."""
    items = _table(spark, sf_dir, "benchmark")
    index = _index(spark, sf_dir)
    result = ink.search_many(index, items, "item_id", "text", folded=True, broadcast_bytes=0)
    return _rounded(result, "score")


def saved_index_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of queries joined with a saved index bucket by bucket."""
    path = scratch_path(spark, "bucketed-index")
    ink.write_bucketed_index(_index(spark, sf_dir), path)
    found = ink.search_bucketed(spark, path, _table(spark, sf_dir, "benchmark"), "item_id", "text")
    return _rounded(found, "score")


def sliced_index_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where only the folders of the queries' terms are read."""
    path = scratch_path(spark, "sliced-index")
    ink.write_sliced_index(_index(spark, sf_dir), path)
    found = ink.search_sliced(spark, path, _table(spark, sf_dir, "benchmark"), "item_id", "text")
    return _rounded(found, "score")


def search_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each document in an ordered result, by its place in the plan's
    sorted partitions."""
    result = ink.in_document_order(_searched(spark, sf_dir, TWO_TERMS))
    return _numbered(spark, result.select("doc"), "position")


def saved_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "index")
    ink.write_index(_index(spark, sf_dir), path)
    return _rounded(ink.search(ink.read_index(spark, path), TWO_TERMS, folded=True), "score")


def packed_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "packed-index")
    ink.write_packed(_index(spark, sf_dir), path)
    return _rounded(ink.search(ink.read_packed(spark, path), TWO_TERMS), "score")


def word_count_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that went through the overwriting text sink and back."""
    path = scratch_path(spark, "word-count")
    ink.write_packed(_counts(spark, sf_dir), path, overwrite=True)
    back = ink.read_packed(spark, path, "n")
    return back.select("term", F.col("doc").cast("bigint").alias("doc"), F.col("n").cast("bigint"))


def saved_weights_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index from term frequencies that went through packed text."""
    path = scratch_path(spark, "weights")
    ink.write_packed(ink.term_frequency(_counts(spark, sf_dir)), path)
    index = ink.tf_idf_of_weights(ink.read_packed(spark, path, "tf"), _n_docs(spark, sf_dir))
    return _rounded(index.withColumn("doc", F.col("doc").cast("bigint")), "tf_idf")


def merged_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of documents that were counted and saved in two batches."""
    path = scratch_path(spark, "count-batches")
    documents = _documents(spark, sf_dir)
    for half in (0, 1):
        ink.append_documents(spread(documents.where(F.pmod("doc", F.lit(2)) == half)), path)
    return _rounded(ink.saved_tf_idf(spark, path), "tf_idf")


def packed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each written file, whether its keys stand in order."""
    path = scratch_path(spark, "packed-order")
    ink.write_packed(_counts(spark, sf_dir), path)
    return ink.packed_order(spark, path)


def _numbered(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows with their number from 1, in the order they have."""
    path = scratch_path(spark, "ordered")
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    placed.write.parquet(path)
    placed = spark.read.parquet(path)
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = placed.withColumn("_part", part).join(starts, "_part")
    return numbered.select(*rows.columns, (F.col("_start") + within + 1).cast("bigint").alias(name))


# --- text files -------------------------------------------------------------


#: Documents of a folder, about; a file has at most as many, whatever its source.
DOCS_PER_FOLDER = 1000


def _corpus_files(spark: SparkSession, sf_dir: str) -> str:
    """The documents as text files named by their source, in folders that each take
    their share of every source; a glob of the folders."""
    documents = _table(spark, sf_dir, "documents")
    n_folders = 2 + documents.count() // DOCS_PER_FOLDER
    folder = F.pmod("doc_id", F.lit(n_folders)).alias("folder")
    rows = documents.where("text IS NOT NULL").select(folder, "source", "text").repartition("folder", "source")
    path = scratch_path(spark, "corpus-files")
    rows.write.partitionBy("folder", "source").text(f"{path}/written")
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path
    files = hadoop_path(path).getFileSystem(context._jsc.hadoopConfiguration())
    # Spark names a file by its task; a corpus names it by its document.
    for written in files.globStatus(hadoop_path(f"{path}/written/folder=*/source=*/part-*")) or []:
        place = written.getPath().getParent()
        name = place.getName().removeprefix("source=")
        target = f"{path}/named/{place.getParent().getName().removeprefix('folder=')}"
        files.mkdirs(hadoop_path(target))
        files.rename(written.getPath(), hadoop_path(f"{target}/{name}"))
    return f"{path}/named/*"


def corpus_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.doc_word_count(ink.tokenize(ink.read_corpus(spark, _corpus_files(spark, sf_dir))))


def corpus_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_files = ink.count_files(spark, _corpus_files(spark, sf_dir))
    return spark.range(1).select(F.lit(n_files).cast("bigint").alias("n_files"))


def wiki_file_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _wiki_lines(spark, sf_dir)
    paths = [scratch_path(spark, "wiki-lines") for _ in range(2)]
    for i, path in enumerate(paths):
        lines.where(F.pmod(F.xxhash64("line"), F.lit(2)) == i).write.text(path)
    return ink.link_counts(ink.extract_links(ink.read_pages(spark, paths)))


# --- links ------------------------------------------------------------------


def count_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.count_pages(_page_lines(spark, sf_dir))


def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = ink.extract_links(_page_lines(spark, sf_dir), body=HTML_BODY, link=HTML_LINK)
    return links.withColumnRenamed("src", "title")


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = first_of(F.col("line"), WIKI_TITLE).alias("title")
    return _page_lines(spark, sf_dir).select("page_id", title).where("title != ''")


def wiki_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.link_counts(ink.extract_links(_wiki_lines(spark, sf_dir)))


def wiki_hub_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.link_counts(ink.extract_links(_hub_lines(spark, sf_dir)))


def wiki_page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.count_pages(_wiki_lines(spark, sf_dir))


def wiki_initial_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _wiki_lines(spark, sf_dir)
    graph = ink.initial_graph(ink.extract_links(lines), ink.count_pages(lines))
    # 1/N is tiny here, so the rank is compared as a share of a million.
    return _rounded(graph.withColumn("rank", F.col("rank") * 1e6), "rank")


def wiki_single_scan_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same graph with the pages counted while the links are written."""
    graph = ink.initial_graph(*ink.write_links(_wiki_lines(spark, sf_dir), scratch_path(spark, "wiki-links")))
    return _rounded(graph.withColumn("rank", F.col("rank") * 1e6), "rank")


def out_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.out_degree(_trade_edges(spark, sf_dir))


def initial_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = ink.initial_graph(_trade_edges(spark, sf_dir), _n_sources(spark, sf_dir))
    return _rounded(graph, "rank")


def adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = ink.adjacency(_trade_edges(spark, sf_dir), _n_sources(spark, sf_dir))
    link = F.transform("outlinks", lambda x: F.concat_ws("*", x.dst, x.n.cast("string")))
    rows = packed.select("node", "rank", "block", F.array_join(link, " ").alias("links"))
    return _rounded(rows, "rank")


def adjacency_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists cut into blocks of a few links, unpacked, with each node's list lengths."""
    edges = _trade_edges(spark, sf_dir)
    packed = ink.adjacency(edges, _n_sources(spark, sf_dir), links_per_row=16)
    whole = packed.groupBy("node").agg(
        F.sum(F.size("outlinks")).cast("bigint").alias("targets"),
        (F.count("*") > 1).alias("split"),
        F.min(F.size("outlinks") > 0).alias("filled"),
    )
    links = packed.select("node", "rank", F.explode("outlinks").alias("x")).select("node", "rank", "x.dst", "x.n")
    return _rounded(links.join(whole, "node"), "rank")


def pagerank_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = ink.link_graph(ink.link_counts(_trade_edges(spark, sf_dir)))
    return _rounded(ink.rank_step(graph, ink.start_ranks(graph)), "rank")


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.page_rank(_trade_edges(spark, sf_dir), _n_sources(spark, sf_dir))


def pagerank_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_ranked(spark, sf_dir), "rank")


def pagerank_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ink.number_sorted(_rounded(_ranked(spark, sf_dir), "rank"))


def saved_graph_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked from a graph on disk, each step committed there."""
    path = scratch_path(spark, "saved-graph")
    ink.write_graph(_trade_edges(spark, sf_dir), _n_sources(spark, sf_dir), f"{path}/graph")
    return _rounded(ink.rank_saved(spark, f"{path}/graph", f"{path}/steps"), "rank")


def packed_graph_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the saved links packed as differences."""
    path = scratch_path(spark, "packed-graph")
    ink.write_graph(_trade_edges(spark, sf_dir), _n_sources(spark, sf_dir), f"{path}/graph", packed=True)
    return _rounded(ink.rank_saved(spark, f"{path}/graph", f"{path}/steps"), "rank")


def packed_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links packed as differences of their pages' numbers, written and unpacked."""
    path = scratch_path(spark, "packed-links")
    counts = settle(ink.link_counts(_trade_edges(spark, sf_dir)), f"{path}/counts")
    titles = settle(ink.numbered_titles(counts), f"{path}/numbers")
    sources = titles.select(F.col("title").alias("src"), F.col("number").alias("from"))
    targets = titles.select(F.col("title").alias("dst"), F.col("number").alias("to"))
    # What is hot and how long the lists are is known from the titles. Counted from the
    # joined links, it would join them once more for each count.
    into = {key: hot_keys(titles, key, "sources") for key in ("title", "number")}
    begun = lookup(counts, sources, "src", "dst", hot=hot_keys(titles, "title", "targets")).drop("src")
    numbered = lookup(begun, targets, "dst", "from", hot=into["title"])
    links = numbered.select(F.col("from").alias("src"), F.col("to").alias("dst"), "n")
    sizes = titles.select(F.col("number").alias("src"), "targets").where("targets > 0")
    packed = settle(ink.pack_links(links, links_per_row=1000, targets=sizes), f"{path}/packed")
    # A source's title is found once per packed row; only then are the links unpacked.
    named = lookup(packed.withColumnRenamed("src", "from"), sources, "from", "first").drop("from")
    flat = ink.unpack_links(named).withColumnRenamed("dst", "to")
    titled = lookup(flat, targets, "to", "src", hot=into["number"])
    return titled.select(F.col("src").alias("node"), "dst", "n")


# --- the same in SQL --------------------------------------------------------

# Word runs and the runs between them, line by line. Blanks at a run's side that
# touches a word belong to the separator; at the line's own ends they stay.
_TOKENS = r"""
WITH ln AS (
  SELECT {keys}, unnest(string_split_regex(text, '\r\n|\r|\n')) AS line FROM {table}),
rs AS (
  SELECT {names}, regexp_extract_all(lower(line), '[\p{{L}}\p{{Nd}}_]+|[^\p{{L}}\p{{Nd}}_]+') AS runs
  FROM ln),
rn AS (
  SELECT {names}, unnest(runs) AS run, generate_subscripts(runs, 1) AS i, len(runs) AS k FROM rs),
lf AS (
  SELECT {names}, i, k,
    CASE WHEN i > 1 THEN regexp_replace(run, '^[ \t\n\x0B\f\r]+', '') ELSE run END AS run FROM rn),
tok AS (
  SELECT {names},
    CASE WHEN i < k THEN regexp_replace(run, '[ \t\n\x0B\f\r]+$', '') ELSE run END AS term FROM lf),
cnt AS (
  SELECT term, {names}, CAST(count(*) AS BIGINT) AS n FROM tok WHERE term <> '' GROUP BY ALL)
"""

_COUNTS = _TOKENS.format(keys="doc_id AS doc", names="doc", table="documents")
_COUNTS_BY_SOURCE = _TOKENS.format(keys="upper(source) AS doc", names="doc", table="documents")
_COUNTS_BY_FILE = _TOKENS.format(keys="source AS doc", names="doc", table="documents")
_COUNTS_BY_TURN = _TOKENS.format(keys="conv_id, turn", names="conv_id, turn", table="conversations")

_INDEX = """,
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n_docs FROM documents),
dfr AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM cnt GROUP BY term),
idx AS (
  SELECT cnt.term, cnt.doc, log10(1 + n_docs / df) * (1 + log10(n)) AS tf_idf
  FROM cnt JOIN dfr ON cnt.term = dfr.term, nd)
"""


def _search_sql(counts: str, terms: str) -> str:
    return (
        counts
        + _INDEX
        + f""", q AS (SELECT unnest([{terms}]) AS term)
SELECT lower(CAST(idx.doc AS VARCHAR)) AS doc, round(sum(tf_idf), 6) AS score
FROM idx JOIN q ON idx.term = q.term GROUP BY 1"""
    )


_TWO_TERMS_SQL = _search_sql(_COUNTS, "'thtion', 'attion'")

_EDGES = """
WITH ed AS (
  SELECT 'S' || l_suppkey AS src, 'P' || l_partkey AS dst FROM lineitem
  UNION ALL
  SELECT 'P' || l_partkey, 'S' || l_suppkey FROM lineitem
  WHERE l_returnflag = 'R' AND l_quantity > 45),
dg AS (SELECT src AS node, CAST(count(*) AS BIGINT) AS out_degree FROM ed GROUP BY src),
r0 AS (SELECT node, out_degree, 1.0 / (SELECT count(*) FROM dg) AS rank FROM dg)
"""


def _steps_sql(count: int) -> str:
    steps = [
        f""",
r{i} AS (
  SELECT dg.node, dg.out_degree, (1 - 0.85::DOUBLE) + 0.85::DOUBLE * coalesce(got.s, 0) AS rank
  FROM dg LEFT JOIN (
    SELECT ed.dst, sum(r{i - 1}.rank / r{i - 1}.out_degree) AS s
    FROM ed JOIN r{i - 1} ON ed.src = r{i - 1}.node GROUP BY ed.dst) got
  ON dg.node = got.dst)
"""
        for i in range(1, count + 1)
    ]
    return _EDGES + "".join(steps)


_HTML_LINES = r"""
WITH ln AS (
  SELECT page_id, unnest(string_split_regex(regexp_replace(html, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n'))
    AS line
  FROM pages WHERE html <> '')
"""


def _own_sql() -> dict[str, str]:
    return {
        "corpus_lines": r"""
            SELECT doc_id, CAST(len(string_split_regex(
              regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n')) AS BIGINT) AS n_lines
            FROM documents WHERE text <> ''""",
        "tokens": _COUNTS_BY_TURN + "SELECT conv_id, turn, term, n FROM cnt",
        "doc_word_count": _COUNTS + "SELECT term, doc, n FROM cnt",
        "term_frequency": _COUNTS + "SELECT term, doc, round(1 + log10(n), 6) AS tf FROM cnt",
        "corpus_size": "SELECT CAST(count(*) AS BIGINT) AS n_docs FROM documents",
        "doc_frequency": _COUNTS
        + _INDEX
        + "SELECT term, df, round(log10(1 + n_docs / df), 6) AS idf FROM dfr, nd",
        "tf_idf": _COUNTS + _INDEX + "SELECT term, doc, round(tf_idf, 6) AS tf_idf FROM idx",
        "tf_idf_window": _COUNTS + _INDEX + "SELECT term, doc, round(tf_idf, 6) AS tf_idf FROM idx",
        "saved_weights_index": _COUNTS + _INDEX + "SELECT term, doc, round(tf_idf, 6) AS tf_idf FROM idx",
        "merged_index": _COUNTS + _INDEX + "SELECT term, doc, round(tf_idf, 6) AS tf_idf FROM idx",
        "search_two_terms": _TWO_TERMS_SQL,
        "search_repeated_term": _search_sql(_COUNTS, "'thtion', 'thtion', 'attion'"),
        "search_case_insensitive": _search_sql(_COUNTS_BY_SOURCE, "'thtion', 'attion'"),
        "search_index": _TWO_TERMS_SQL,
        "query_terms": r"""
            SELECT item_id, term, CAST(count(*) AS BIGINT) AS times FROM (
              SELECT item_id, unnest(string_split_regex(lower(text), '[ \t\n\x0B\f\r]+')) AS term
              FROM benchmark) WHERE term <> '' GROUP BY ALL""",
        **dict.fromkeys(("search_many", "search_many_index", "search_many_grid", "saved_index_many", "sliced_index_many"), _COUNTS
        + _INDEX
        + r""", q AS (
              SELECT item_id, unnest(string_split_regex(lower(text), '[ \t\n\x0B\f\r]+')) AS term
              FROM benchmark)
            SELECT item_id, lower(CAST(idx.doc AS VARCHAR)) AS doc, round(sum(tf_idf), 6) AS score
            FROM idx JOIN q ON idx.term = q.term GROUP BY ALL"""),
        "search_order": _TWO_TERMS_SQL.replace("SELECT lower(", "SELECT doc, row_number() OVER (ORDER BY doc) AS position FROM (SELECT lower(", 1) + ")",
        "packed_order": _COUNTS + "SELECT true AS ordered, CAST(count(*) AS BIGINT) AS n_lines FROM cnt",
        "corpus_file_counts": _COUNTS_BY_FILE + "SELECT term, doc, n FROM cnt",
        "corpus_file_count": """
            SELECT CAST(count(DISTINCT (doc_id % (2 + (SELECT count(*) // 1000 FROM documents)), source)) AS BIGINT) AS n_files
            FROM documents WHERE text IS NOT NULL""",
        "saved_index_search": _TWO_TERMS_SQL,
        "packed_index_search": _TWO_TERMS_SQL,
        "word_count_text": _COUNTS + "SELECT term, doc, n FROM cnt",
        "count_pages": _HTML_LINES
        + "SELECT CAST(count(*) AS BIGINT) AS n_pages FROM ln"
        + " WHERE regexp_extract(line, '<title>(.+?)</title>', 1) <> ''",
        "html_links": _HTML_LINES
        + """SELECT page_id, regexp_extract(line, '<title>(.+?)</title>', 1) AS title,
              unnest(regexp_extract_all(line, '<a href="(.*?)"', 1)) AS dst FROM ln""",
        "page_titles": _HTML_LINES
        + """SELECT page_id, title FROM (
              SELECT page_id, regexp_extract(line, '<title>(.+?)</title>', 1) AS title FROM ln)
            WHERE title <> ''""",
        "wiki_edges": """
            SELECT src, dst, CAST(count(*) AS BIGINT) AS n FROM (
              SELECT 'S' || l_suppkey AS src, 'P' || l_partkey AS dst FROM lineitem
              UNION ALL SELECT 'S' || l_suppkey, 'O' || l_orderkey FROM lineitem) GROUP BY ALL""",
        "wiki_file_edges": """
            SELECT src, dst, CAST(count(*) AS BIGINT) AS n FROM (
              SELECT 'S' || l_suppkey AS src, 'P' || l_partkey AS dst FROM lineitem
              UNION ALL SELECT 'S' || l_suppkey, 'O' || l_orderkey FROM lineitem) GROUP BY ALL""",
        "wiki_hub_edges": """
            SELECT 'S' || l_suppkey AS src, 'P' || l_partkey AS dst, CAST(count(*) AS BIGINT) AS n
            FROM lineitem GROUP BY ALL""",
        "wiki_page_count": "SELECT CAST(count(*) AS BIGINT) AS n_pages FROM lineitem",
        **dict.fromkeys(("wiki_initial_graph", "wiki_single_scan_graph"), """
            SELECT node, round(1e6 * (1.0::DOUBLE / (SELECT count(*) FROM lineitem)), 6) AS rank, dst,
              CAST(count(*) AS BIGINT) AS n FROM (
              SELECT 'S' || l_suppkey AS node, 'P' || l_partkey AS dst FROM lineitem
              UNION ALL SELECT 'S' || l_suppkey, 'O' || l_orderkey FROM lineitem) GROUP BY node, dst"""),
        "out_degree": _EDGES + "SELECT node AS src, out_degree FROM dg",
        "initial_graph": _EDGES
        + """SELECT node, round(rank, 6) AS rank, dst, CAST(count(*) AS BIGINT) AS n
            FROM r0 JOIN ed ON node = src GROUP BY node, rank, dst""",
        "adjacency": _EDGES
        + """, mult AS (SELECT src, dst, count(*) AS n FROM ed GROUP BY src, dst)
            SELECT node, round(rank, 6) AS rank, CAST(0 AS INTEGER) AS block,
              string_agg(dst || '*' || n, ' ' ORDER BY dst) AS links
            FROM r0 JOIN mult ON node = src GROUP BY node, rank""",
        "adjacency_blocks": _EDGES
        + """, mult AS (SELECT src, dst, CAST(count(*) AS BIGINT) AS n FROM ed GROUP BY src, dst),
            whole AS (SELECT src, CAST(count(*) AS BIGINT) AS targets FROM mult GROUP BY src)
            SELECT node, round(rank, 6) AS rank, dst, n, targets, targets > 16 AS split, true AS filled
            FROM r0 JOIN mult ON node = mult.src JOIN whole ON node = whole.src""",
        "pagerank_step": _steps_sql(1) + "SELECT node, round(rank, 6) AS rank FROM r1",
        "pagerank_10": _steps_sql(10) + "SELECT node, round(rank, 6) AS rank FROM r10",
        "saved_graph_rank": _steps_sql(10) + "SELECT node, round(rank, 6) AS rank FROM r10",
        "packed_graph_rank": _steps_sql(10) + "SELECT node, round(rank, 6) AS rank FROM r10",
        "packed_adjacency": _EDGES
        + "SELECT src AS node, dst, CAST(count(*) AS BIGINT) AS n FROM ed GROUP BY src, dst",
        "pagerank_sorted": _steps_sql(10)
        + """SELECT node, round(rank, 6) AS rank,
              row_number() OVER (ORDER BY round(rank, 6) DESC, node) AS position FROM r10""",
    }


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [
        corpus_lines,
        tokens,
        doc_word_count,
        term_frequency,
        corpus_size,
        doc_frequency,
        tf_idf,
        tf_idf_window,
        search_two_terms,
        search_repeated_term,
        search_case_insensitive,
        search_index,
        query_terms,
        search_many,
        search_many_index,
        search_many_grid,
        saved_index_many,
        sliced_index_many,
        search_order,
        saved_index_search,
        packed_index_search,
        saved_weights_index,
        merged_index,
        word_count_text,
        packed_order,
        corpus_file_counts,
        corpus_file_count,
        count_pages,
        html_links,
        page_titles,
        wiki_edges,
        wiki_hub_edges,
        wiki_file_edges,
        wiki_page_count,
        wiki_initial_graph,
        wiki_single_scan_graph,
        out_degree,
        initial_graph,
        adjacency,
        adjacency_blocks,
        pagerank_step,
        pagerank_10,
        pagerank_sorted,
        saved_graph_rank,
        packed_graph_rank,
        packed_adjacency,
    ]
    return {query.__name__: query for query in registered}


def _llm():
    """The training-data operators, or nothing where their folder is absent."""
    try:
        import inkrank.llm.queries as registered
    except ModuleNotFoundError as error:
        if error.name not in ("inkrank.llm", "corpus_pipeline"):
            raise
        return None
    return registered


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = _llm()
    return own_queries() | (more.queries() if more else {})


def oracle_sql() -> dict[str, str]:
    more = _llm()
    return _own_sql() | (more.oracle_sql() if more else {})


def entry(spark: SparkSession) -> DataFrame:
    """Search the documents for two words."""
    return search_two_terms(spark, "/root/testdata/sf0.001")
