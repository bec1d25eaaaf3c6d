"""From page lines to the link graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from inkrank.functions.markup import WIKI_BODY, WIKI_LINK, WIKI_TITLE, first_of, links_of
from inkrank.operators.scalars import scalar
from inkrank.operators.skew import hot_keys, lookup
from inkrank.session import settle


def _once(lines: DataFrame) -> DataFrame:
    """The same lines, each computed once however often it is looked at.

    A line is searched for several marks. If it is itself an expression, a filter
    that is moved below it would hold that expression once for each mark; nothing
    is moved below an explode of its own result.
    """
    others = [F.col(name) for name in lines.columns if name != "line"]
    return lines.select(*others, F.explode_outer(F.array("line")).alias("line"))


def count_pages(lines: DataFrame, title: str = WIKI_TITLE) -> DataFrame:
    """``(n_pages)``: lines with a title, not distinct titles."""
    titled = _once(lines).where(first_of(F.col("line"), title) != "")
    return titled.agg(F.count("*").alias("n_pages"))


def extract_links(
    lines: DataFrame, title: str = WIKI_TITLE, body: str = WIKI_BODY, link: str = WIKI_LINK
) -> DataFrame:
    """``(…, src, dst)``, one row per link of each line, repeated links kept.

    Columns of ``lines`` other than ``line`` stay. The source is the line's
    title, "" without one.
    """
    return _link_rows(_link_lists(lines, title, body, link))


def _link_lists(lines: DataFrame, title: str, body: str, link: str) -> DataFrame:
    others = [F.col(name) for name in lines.columns if name != "line"]
    line = F.col("line")
    found = links_of(first_of(line, body), link).alias("_links")
    return _once(lines).select(*others, first_of(line, title).alias("src"), found)


def _link_rows(pages: DataFrame) -> DataFrame:
    others = [name for name in pages.columns if name != "_links"]
    # Title and links are found once per line, below the rows of its links. The
    # plain explode would make the optimizer test for empty lists by finding the
    # links a second time.
    return pages.select(*others, F.explode_outer("_links").alias("dst")).where("dst IS NOT NULL")


def write_links(
    lines: DataFrame, path: str, title: str = WIKI_TITLE, body: str = WIKI_BODY, link: str = WIKI_LINK
) -> tuple[DataFrame, int]:
    """The links of ``extract_links``, written to ``path``, and the number of
    ``count_pages``, in one pass over the lines.

    The pages are counted by the tasks that write. Such a task counts once however
    often it is run, which does not hold for tasks in front of a shuffle; so the
    links are written as they are found, before anything is grouped.
    """
    seen = Observation()
    titled = F.count_if(F.col("src") != "").alias("n_pages")
    pages = _link_lists(lines, title, body, link).observe(seen, titled)
    links = settle(_link_rows(pages), path)
    return links, seen.get["n_pages"]


def link_counts(edges: DataFrame) -> DataFrame:
    """``(src, dst, n)``: each distinct link with its multiplicity.

    A link with a null end is no link, here and in all that follows. Stating it here keeps joins from adding the check to
    some uses only, which would count the links once more for them.
    """
    whole = edges.where("src IS NOT NULL AND dst IS NOT NULL")
    return whole.groupBy("src", "dst").agg(F.count("*").alias("n"))


def out_degree(edges: DataFrame) -> DataFrame:
    """``(src, out_degree)``: links per source, multiplicity included. As in
    ``link_counts``, a link with a null end is no link."""
    whole = edges.where("src IS NOT NULL AND dst IS NOT NULL")
    return whole.groupBy("src").agg(F.count("*").alias("out_degree"))


def initial_rank(n_pages: int | DataFrame):
    """1/N; no value when no page has a title."""
    return F.try_divide(F.lit(1.0), scalar(n_pages))


def initial_ranks(edges: DataFrame, n_pages: int | DataFrame) -> DataFrame:
    """``(node, rank)``: only pages with links are nodes, whatever else N counts."""
    whole = edges.where("src IS NOT NULL AND dst IS NOT NULL")
    nodes = whole.select(F.col("src").alias("node")).distinct()
    return nodes.withColumn("rank", initial_rank(n_pages)).where("rank IS NOT NULL")


def initial_graph(edges: DataFrame, n_pages: int | DataFrame) -> DataFrame:
    """``(node, rank, dst, n)``: the ranked graph with one row per distinct link.

    Lists of links would put all links of a hub page into one row; flat rows
    have no such limit. ``adjacency`` packs them into lists of bounded length.
    """
    ranked = link_counts(edges).withColumn("rank", initial_rank(n_pages)).where("rank IS NOT NULL")
    return ranked.select(F.col("src").alias("node"), "rank", "dst", "n")


def _in_blocks(links: DataFrame, links_per_row: int, targets: DataFrame | None = None) -> DataFrame:
    """The ``(src, dst, n)`` links with their ``block`` of the source's list."""
    if targets is None:
        targets = links.groupBy("src").agg(F.count_if(F.col("n") > 0).alias("targets"))
    blocks = F.ceil(F.col("targets") / F.lit(links_per_row)).cast("int")
    large = targets.select("src", blocks.alias("blocks")).where("blocks > 1")
    block = F.pmod(F.xxhash64("dst"), F.coalesce("blocks", F.lit(1))).cast("int")
    hot = hot_keys(targets, "src", "targets")
    return lookup(links, large, "src", "dst", "left", hot).withColumn("block", block)


def adjacency(edges: DataFrame, n_pages: int | DataFrame, links_per_row: int = 10_000) -> DataFrame:
    """``(node, rank, block, outlinks)`` with ``outlinks`` an array of ``(dst, n)``.

    A node has one row unless it links to more than ``links_per_row`` distinct
    targets; then its targets are dealt into blocks of about that many. No
    target is left out and none is in two blocks.
    """
    placed = _in_blocks(link_counts(edges), links_per_row)
    packed = placed.groupBy(F.col("src").alias("node"), "block").agg(
        F.array_sort(F.collect_list(F.struct("dst", "n"))).alias("outlinks")
    )
    ranked = packed.withColumn("rank", initial_rank(n_pages)).where("rank IS NOT NULL")
    return ranked.select("node", "rank", "block", "outlinks")


#: Links in one packed row. Unpacking adds up a row's gaps by lists that grow link by
#: link, so its time per link follows this number.
PACK_LINKS = 64


def numbered_titles(counts: DataFrame) -> DataFrame:
    """``(title, number, targets, sources)``: all ends of ``(src, dst, n)`` links,
    numbered in the order of titles, with how many distinct titles each links to and
    is linked from."""
    out = counts.select(F.col("src").alias("title"), F.lit(1).alias("targets"), F.lit(0).alias("sources"))
    into = counts.select(F.col("dst").alias("title"), F.lit(0).alias("targets"), F.lit(1).alias("sources"))
    ends = out.union(into).groupBy("title").agg(F.sum("targets").alias("targets"), F.sum("sources").alias("sources"))
    return ends.sort("title").select("title", F.monotonically_increasing_id().alias("number"), "targets", "sources")


def pack_links(links: DataFrame, links_per_row: int = 10_000, targets: DataFrame | None = None) -> DataFrame:
    """``(src, first, gaps, times)`` of ``(src, dst, n)`` links between numbers.

    A source's targets are sorted and cut into rows of up to ``PACK_LINKS``: the first
    target, the differences to each next one, and all multiplicities. Small
    differences and equal multiplicities take a few bits each in parquet. Each
    ``(src, dst)`` must be there once, and numbers are 0 or more. A source beyond
    ``links_per_row`` targets is sorted in several blocks, as in ``adjacency``.
    ``targets`` is ``(src, targets)``, the number of each source's, if that is known.
    """
    lists = _in_blocks(links, links_per_row, targets).groupBy("src", "block").agg(
        F.array_sort(F.collect_list(F.struct("dst", "n"))).alias("all")
    )
    starts = F.sequence(F.lit(1), F.size("all"), F.lit(PACK_LINKS))
    cut = F.transform(starts, lambda at: F.slice("all", at, PACK_LINKS))
    rows = lists.select("src", F.explode(cut).alias("row"))
    targets = F.col("row.dst")
    gaps = F.zip_with(F.slice(targets, 2, PACK_LINKS), F.slice(targets, F.lit(1), F.size(targets) - 1), lambda b, a: b - a)
    return rows.select("src", targets[0].alias("first"), gaps.alias("gaps"), F.col("row.n").alias("times"))


def unpack_links(packed: DataFrame) -> DataFrame:
    """The ``(src, dst, n)`` links of ``pack_links``; other columns of a row are kept."""
    others = [name for name in packed.columns if name not in ("first", "gaps", "times")]
    begun = F.array(F.col("first"))
    targets = F.aggregate("gaps", begun, lambda found, gap: F.concat(found, F.array(F.element_at(found, -1) + gap)))
    # The outer explode keeps the optimizer from adding up the gaps once more to test
    # for empty lists; there are none.
    pairs = packed.select(*others, F.explode_outer(F.arrays_zip(targets.alias("dst"), F.col("times").alias("n"))).alias("link"))
    return pairs.select(*others, "link.dst", "link.n")
