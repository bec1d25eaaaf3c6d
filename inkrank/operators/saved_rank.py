"""Ranking from a graph on disk, with every step committed.

A saved graph has numbers for its nodes and is bucketed by them: nodes with their
out-degree, and links by source. A step joins links and ranks bucket by bucket and
shuffles nothing but one sum per target; the new ranks are written in the same
buckets, and a note commits them. A ranking that was stopped goes on behind its
last committed step, in any later program.

Links of hot sources would make their bucket's task long. They lie in a table of
their own, without buckets, and the few ranks they need are broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkrank.operators.graph import link_counts, pack_links, unpack_links
from inkrank.operators.rank import DAMPING, ITERATIONS, LINKS_PER_TASK, numbered_links, numbered_nodes
from inkrank.operators.skew import hot_keys
from inkrank.session import scratch_folder, session_with, settle, shuffle_width
from inkrank.sources.saved import names_in, read_bucketed, read_note, write_bucketed, write_note

_NOTE = "graph.json"
_STATE = "number bigint, out_degree bigint, rank double"
_FLAT = "src bigint, dst bigint, n bigint"
_PACKED = "src bigint, first bigint, gaps array<bigint>, times array<bigint>"


def write_graph(edges: DataFrame, n_pages: int | DataFrame, path: str, packed: bool = False) -> None:
    """Save the graph of ``(src, dst)`` links for any number of rankings.

    ``path`` gets ``nodes(node, number, out_degree)``, ``links`` and ``hot-links``,
    each ``(src, dst, n)`` in node numbers, and a note with their counts, which is
    written last. Links to pages that are not nodes are only in the out-degrees.

    ``packed`` saves ``links`` as differences (``pack_links``). A step then joins one
    row of many links instead of one row per link, and reads less.
    """
    spark = edges.sparkSession
    if read_note(spark, f"{path}/{_NOTE}"):
        raise FileExistsError(f"{path} holds a graph")
    if isinstance(n_pages, DataFrame):
        n_pages = n_pages.first()[0]  # one number
    with scratch_folder(spark, "graph") as folder:
        links = settle(link_counts(edges), f"{folder}/links")
        buckets = max(1, min(shuffle_width(spark), max(spark.sparkContext.defaultParallelism, links.count() // LINKS_PER_TASK)))
        own = _bucket_session(spark, buckets)
        links = own.read.schema(links.schema).parquet(f"{folder}/links")
        nodes = settle(numbered_nodes(links), f"{folder}/nodes")
        hot = settle(hot_keys(nodes, "number", "targets"), f"{folder}/hot")
        live = settle(numbered_links(links, nodes, hot_sources=True), f"{folder}/live")
        # Fewer rows than shares, of 12 bytes each: see hot_keys.
        few = F.broadcast(hot.select("_slot", F.lit(True).alias("_hot")))
        marked = live.withColumn("_slot", F.xxhash64("src")).join(few, "_slot", "left").drop("_slot")
        cold = marked.where("_hot IS NULL").drop("_hot")
        if packed:
            cold = pack_links(cold)
        write_bucketed(cold.repartition(buckets, "src"), f"{path}/links", "src", buckets)
        marked.where("_hot").drop("_hot").write.mode("overwrite").parquet(f"{path}/hot-links")
        kept = nodes.select("node", "number", "out_degree")
        write_bucketed(kept.repartition(buckets, "number"), f"{path}/nodes", "number", buckets)
        node = kept.schema["node"].dataType.simpleString()
        counted = nodes.agg(F.count("*").alias("n_nodes"), F.sum("targets").alias("n_links")).first()
        note = {"id": uuid.uuid4().hex, "buckets": buckets, "node": node, "n_pages": n_pages, "n_nodes": counted.n_nodes, "n_links": counted.n_links or 0, "packed": packed}
        write_note(spark, f"{path}/{_NOTE}", note)


def _bucket_session(spark: SparkSession, buckets: int) -> SparkSession:
    """Joins stay bucket by bucket: as many partitions as buckets, and no side is
    broadcast but those that say so."""
    settings = {"spark.sql.shuffle.partitions": buckets, "spark.sql.autoBroadcastJoinThreshold": -1}
    return session_with(spark, settings | {"spark.sql.adaptive.autoBroadcastJoinThreshold": -1})


def graph_note(spark: SparkSession, path: str) -> dict:
    """Counts of a saved graph: ``n_pages``, ``n_nodes``, ``n_links`` and more."""
    note = read_note(spark, f"{path}/{_NOTE}")
    if note is None:
        raise FileNotFoundError(f"no finished graph at {path}")
    return note


def _steps_done(spark: SparkSession, work: str, note: dict, damping: float) -> int:
    """The last committed step in ``work``; it must be of this graph and damping."""
    names = names_in(spark, f"{work.rstrip('/')}/step-*.json")
    if not names:
        return 0
    last = read_note(spark, f"{work}/{names[-1]}")
    if last["graph"] != note["id"] or last["damping"] != damping:
        raise ValueError(f"{work} holds the steps of another ranking")
    return last["step"]


def _step_path(work: str, step: int) -> str:
    return f"{work}/step-{step:05d}"


def _next(state: DataFrame, links: DataFrame, hot_links: DataFrame, damping: float) -> DataFrame:
    """The state after one step. The links of hot sources need fewer ranks than
    ``skew.hot_keys`` can name, of 16 bytes each."""
    shares = state.select(F.col("number").alias("src"), (F.col("rank") / F.col("out_degree")).alias("share"))
    few = shares.join(F.broadcast(hot_links.select("src").distinct()), "src", "left_semi")
    sent = links.join(shares, "src")
    if "gaps" in links.columns:
        sent = unpack_links(sent)
    given = sent.unionByName(hot_links.join(F.broadcast(few), "src"))
    received = given.groupBy(F.col("dst").alias("number")).agg(F.sum(F.col("share") * F.col("n")).alias("received"))
    rank = F.lit(1 - damping) + F.lit(damping) * F.coalesce("received", F.lit(0.0))
    return state.select("number", "out_degree").join(received, "number", "left").select("number", "out_degree", rank.alias("rank"))


def rank_saved(
    spark: SparkSession,
    graph: str,
    work: str,
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
    on_step: Callable[[int], None] | None = None,
) -> DataFrame:
    """``(node, rank)`` of a saved graph after ``iterations`` steps.

    ``work`` keeps the ranks of every step. Steps that are committed there are not
    run again, so a stopped ranking resumes and a finished one can be carried on.
    ``on_step`` is told of each step once it is committed.
    """
    note = graph_note(spark, graph)
    buckets = note["buckets"]
    own = _bucket_session(spark, buckets)
    nodes = read_bucketed(own, f"{graph}/nodes", "number", buckets, f"node {note['node']}, number bigint, out_degree bigint")
    links = read_bucketed(own, f"{graph}/links", "src", buckets, _PACKED if note.get("packed") else _FLAT)
    hot_links = own.read.schema(_FLAT).parquet(f"{graph}/hot-links")
    if not note["n_pages"]:
        return nodes.select("node", F.lit(None).cast("double").alias("rank")).where("false")

    def state_at(step: int) -> DataFrame:
        if not step:
            return nodes.select("number", "out_degree", F.lit(1.0 / note["n_pages"]).alias("rank"))
        return read_bucketed(own, _step_path(work, step), "number", buckets, _STATE)

    for step in range(_steps_done(spark, work, note, damping) + 1, iterations + 1):
        after = _next(state_at(step - 1), links, hot_links, damping)
        write_bucketed(after, _step_path(work, step), "number", buckets)
        write_note(spark, f"{_step_path(work, step)}.json", {"step": step, "graph": note["id"], "damping": damping})
        if on_step:
            on_step(step)
    return nodes.select("node", "number").join(state_at(iterations), "number").select("node", "rank")
