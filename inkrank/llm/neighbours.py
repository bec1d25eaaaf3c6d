"""Approximate nearest neighbours: a small-world graph per shard, results merged.

Distinct vectors are dealt into shards of bounded size by hash. Each shard gets a
hierarchical navigable small-world graph, stored as flat neighbour arrays, one
row of a table. Queries go to every shard in blocks; each (shard, block) is one
task that returns its nearest few, and the best of all shards are kept.

Nearness is the cosine, in double precision on the vectors as given; ties go to
the smaller id. Rows of equal vectors are one node that keeps the ids which can
still be among the nearest.

Edge cases: vectors that are null, empty or zero, or hold null or non-finite
components, and rows of null id take no part; a query meets only vectors of its
own length; repeated rows count once; rows of the query's own id are no
candidates; with fewer candidates than wanted all are returned.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkrank.session import scratch_path, settle

NEAREST = 5
#: Distinct vectors in a shard, and queries in a block, about.
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
#: Links of a node (twice as many on the ground layer), and how widely the graph
#: is searched when it is built and when it is asked.
LINKS = 14
BUILD_WIDTH = 72
SEARCH_WIDTH = 96


class Graph:
    """One shard's graph over unit vectors: neighbour lists by layer, flat."""

    def __init__(self, unit: np.ndarray, entry: int, layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        #: Of each layer: its nodes, ascending; where each one's list starts; the lists.
        self.unit, self.entry, self.layers = unit, entry, layers
        self._seen = np.zeros(len(unit), np.int64)
        self._round = 0

    def _neighbours(self, layer: int, node: int) -> np.ndarray:
        nodes, starts, flat = self.layers[layer]
        at = node if layer == 0 else int(np.searchsorted(nodes, node))
        return flat[starts[at] : starts[at + 1]]

    def _walk(self, query: np.ndarray, entries: list[tuple[float, int]], width: int, layer: int):
        """The ``width`` nodes nearest to the query that a best-first walk finds."""
        self._round += 1
        seen, mark = self._seen, self._round
        seen[[node for _, node in entries]] = mark
        ahead = [(-near, node) for near, node in entries]
        heapq.heapify(ahead)
        best = list(entries)
        heapq.heapify(best)
        while ahead:
            near, node = heapq.heappop(ahead)
            if len(best) >= width and -near < best[0][0]:
                break
            around = self._neighbours(layer, node)
            around = around[seen[around] != mark]
            if not len(around):
                continue
            seen[around] = mark
            found = self.unit[around] @ query
            if len(best) >= width:
                keep = found > best[0][0]
                found, around = found[keep], around[keep]
            for near, node in zip(found.tolist(), around.tolist(), strict=True):
                if len(best) < width:
                    heapq.heappush(best, (near, node))
                elif near > best[0][0]:
                    heapq.heapreplace(best, (near, node))
                else:
                    continue
                heapq.heappush(ahead, (-near, node))
        return best

    def search(self, query: np.ndarray, width: int) -> list[int]:
        """Nodes near a unit vector, nearest first."""
        at = [(float(self.unit[self.entry] @ query), self.entry)]
        for layer in range(len(self.layers) - 1, 0, -1):
            at = [max(self._walk(query, at, 1, layer))]
        return [node for _, node in sorted(self._walk(query, at, width, 0), reverse=True)]


class _Builder(Graph):
    """A graph while it is built: neighbour lists that still change."""

    def __init__(self, unit: np.ndarray, links: int, width: int):
        super().__init__(unit, 0, [])
        self.links, self.width = links, width
        self.lists: list[dict[int, np.ndarray]] = []

    def _neighbours(self, layer: int, node: int) -> np.ndarray:
        return self.lists[layer][node]

    def _chosen(self, nodes: np.ndarray, near: np.ndarray, count: int) -> np.ndarray:
        """Up to ``count`` of some nodes: the near ones first, those that a chosen
        one is nearer to than the centre only to fill up."""
        order = np.argsort(-near, kind="stable")
        nodes, near = nodes[order], near[order]
        if len(nodes) <= count:
            return nodes
        between = self.unit[nodes] @ self.unit[nodes].T
        covered = np.zeros(len(nodes), bool)
        kept: list[int] = []
        for i in range(len(nodes)):
            if not covered[i]:
                kept.append(i)
                if len(kept) == count:
                    break
                covered |= between[i] > near
        if len(kept) < count:
            rest = np.setdiff1d(np.arange(len(nodes)), kept)
            kept += rest[: count - len(kept)].tolist()
        return nodes[kept]

    def add(self, node: int, level: int) -> None:
        query = self.unit[node]
        top = len(self.lists) - 1
        at = [(float(self.unit[self.entry] @ query), self.entry)] if top >= 0 else []
        for layer in range(top, level, -1):
            at = [max(self._walk(query, at, 1, layer))]
        for layer in range(min(top, level), -1, -1):
            at = self._walk(query, at, self.width, layer)
            near, nodes = np.array([x for x, _ in at]), np.array([n for _, n in at], np.int32)
            chosen = self._chosen(nodes, near, self.links)
            lists, most = self.lists[layer], self.links * (2 if layer == 0 else 1)
            lists[node] = chosen
            for other in chosen.tolist():
                own = np.append(lists[other], np.int32(node))
                if len(own) > most:
                    own = self._chosen(own, self.unit[own] @ self.unit[other], most)
                lists[other] = own
        for _ in range(top + 1, level + 1):
            self.lists.append({node: np.zeros(0, np.int32)})
            self.entry = node

    def flat(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        out = []
        for lists in self.lists:
            nodes = np.array(sorted(lists), np.int32)
            sizes = [len(lists[node]) for node in nodes.tolist()]
            flat = np.concatenate([lists[node] for node in nodes.tolist()]).astype(np.int32)
            out.append((nodes, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), flat))
        return out


def units(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def build(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 1) -> Graph:
    """The graph of some vectors (double, none zero)."""
    builder = _Builder(units(vectors), links, width)
    chance = np.random.default_rng(seed).random(len(vectors))
    levels = np.floor(-np.log(1 - chance) / math.log(links)).astype(int)
    for node in range(len(vectors)):
        builder.add(node, int(levels[node]))
    return Graph(builder.unit, builder.entry, builder.flat())


# --- on tables --------------------------------------------------------------


def _taking_part(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    x = F.col(vector_col).cast("array<double>")
    # Largest first, so that squares neither overflow nor vanish: only zero is zero.
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(x, lambda v: v != 0)
    rows = table.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(finite & some)
    return rows.select(F.col(id_col).cast("bigint").alias("id"), x.alias("vector"))


def _stack(rows: pd.Series) -> np.ndarray:
    """Vectors scaled by a power of two so that their squares stay in range."""
    x = np.stack([np.asarray(row, np.float64) for row in rows])
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def build_index(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    nearest: int = NEAREST,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per shard: its vectors, their ids, and the graph as flat arrays."""
    rows = _taking_part(table, id_col, vector_col)
    # Of equal vectors, one more id than wanted can matter: the query's own drops out.
    by_id = Window.partitionBy("vector").orderBy("id")
    first = rows.withColumn("place", F.dense_rank().over(by_id)).where(F.col("place") <= nearest + 1)
    nodes = first.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    nodes = settle(nodes, scratch_path(table.sparkSession, "vectors"))
    shards = max(1, math.ceil(nodes.count() / shard_rows))
    dealt = nodes.select(
        F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), "*"
    )

    def graph(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[np.argsort([ids[0] for ids in pdf["ids"]], kind="stable")]
        vectors = _stack(pdf["vector"])
        made = build(vectors)
        ids = [np.asarray(x, np.int64) for x in pdf["ids"]]
        row = {
            "dim": vectors.shape[1],
            "shard": pdf["shard"].iloc[0],
            "vectors": vectors.tobytes(),
            "id_starts": np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64).tobytes(),
            "ids": np.concatenate(ids).tobytes(),
            "entry": made.entry,
            "nodes": [nodes.tobytes() for nodes, _, _ in made.layers],
            "starts": [starts.tobytes() for _, starts, _ in made.layers],
            "neighbours": [flat.tobytes() for _, _, flat in made.layers],
        }
        return pd.DataFrame([row])

    schema = (
        "dim int, shard int, vectors binary, id_starts binary, ids binary, entry int,"
        " nodes array<binary>, starts array<binary>, neighbours array<binary>"
    )
    index = dealt.groupBy("dim", "shard").applyInPandas(graph, schema)
    return settle(index, scratch_path(table.sparkSession, "graphs"))


def _load(row: pd.Series) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
    layers = [
        (np.frombuffer(a, np.int32), np.frombuffer(b, np.int64), np.frombuffer(c, np.int32))
        for a, b, c in zip(row["nodes"], row["starts"], row["neighbours"], strict=True)
    ]
    graph = Graph(units(vectors), int(row["entry"]), layers)
    return graph, vectors, np.frombuffer(row["id_starts"], np.int64), np.frombuffer(row["ids"], np.int64)


def search(
    index: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    nearest: int = NEAREST,
    width: int = SEARCH_WIDTH,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the nearest found in all shards."""
    asked = settle(
        _taking_part(queries, id_col, vector_col).distinct(), scratch_path(queries.sparkSession, "queries")
    )
    blocks = max(1, math.ceil(asked.count() / block_rows))
    asked = asked.select(
        F.size("vector").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "vector"
    )
    places = index.select("dim", F.col("shard").alias("_shard"))
    # A query meets each shard once; the table of shards is one short row a shard.
    asked = asked.join(places, "dim").withColumnRenamed("_shard", "shard")
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def near(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "query", "vec_id", "score"]
        if not len(asked) or not len(held):
            return pd.DataFrame(columns=names)
        graph, vectors, starts, ids = _load(held.iloc[0])
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        queries = _stack(asked["vector"])
        unit = units(queries)
        out = []
        for i, own in enumerate(asked["id"].tolist()):
            found = graph.search(unit[i], width)
            exact = vectors[found] @ queries[i] / (norms[found] * math.sqrt(queries[i] @ queries[i]))
            rows = [
                (-score, int(vec_id))
                for node, score in zip(found, exact.tolist(), strict=True)
                for vec_id in ids[starts[node] : starts[node + 1]]
                if vec_id != own
            ]
            out += [(own, queries[i].tobytes(), vec_id, -score) for score, vec_id in sorted(rows)[:nearest]]
        return pd.DataFrame(out, columns=names)

    keys = ["dim", "shard", "block"]
    found = (
        asked.groupBy(*keys)
        .cogroup(held.groupBy(*keys))
        .applyInPandas(near, "query_id long, query binary, vec_id long, score double")
    )
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
