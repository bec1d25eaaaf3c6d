"""Near-duplicates by SimHash fingerprints, linked over Golay-code keys.

A 64-bit fingerprint is cut into three segments. Two fingerprints that differ in
at most two bits agree in one whole segment, and differ in at most one bit in
the next (segments taken in a ring). The key is the equal segment with the Golay
codeword index of the next: a fingerprint is filed under the one nearest index
and looked up under the one or six around it, so a bit of difference does not
matter. Candidates are verified by their bit distance.

Equal fingerprints are one node. A key's fingerprints meet in cells of bounded
size, and each cell returns no more links than it has fingerprints: those of a
star for each connected part, which loses no connection.

Edge cases: null and empty texts have fingerprint zero and link with each other;
null ids do not count for ``component_id`` unless a component has no other;
repeated rows get the same answer each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkrank.llm import golay
from inkrank.llm.common import sliced, texts
from inkrank.llm.components import components
from inkrank.operators.skew import hot_keys, lookup
from inkrank.session import scratch_path, settle

SHINGLE = 3
MAX_BITS = 2
SEED = 42

#: Fingerprints filed under one key in one cell, about.
CELL = 4096

#: (first bit, bits) of the segments; none exceeds a Golay word.
_SEGMENTS = ((0, 22), (22, 21), (43, 21))
_CHUNK = 256


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of one text."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest, last = xxhash.xxh64_intdigest, ends[min(shingle, len(words)) - 1 :].tolist()
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts, last, strict=False)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` with the 64 bits of the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [fingerprint(text, shingle) for text in batch.column(1).to_pylist()]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    return texts(docs).mapInArrow(compute, "doc_id long, fp long")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint under its filing keys, and under those it is looked up by."""
    for batch in batches:
        fps = batch.column(0).to_numpy()
        bits = fps.view(np.uint64)
        parts = [((bits >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in _SEGMENTS]
        out = []
        for i in range(3):
            base = (np.int64(i) << 34) | (parts[i] << 12)
            near = golay.around(parts[(i + 1) % 3])
            out.append((base | near[:, 0], fps, True))
            near.sort(axis=1)
            fresh = np.ones(near.shape, bool)
            fresh[:, 1:] = near[:, 1:] != near[:, :-1]
            row, column = np.nonzero(fresh)
            out.append((base[row] | near[row, column], fps[row], False))
        keys = np.concatenate([key for key, _, _ in out])
        values = np.concatenate([x for _, x, _ in out])
        filed = np.concatenate([np.full(len(x), kind) for _, x, kind in out])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values), pa.array(filed)], ["key", "fp", "filed"])


class _Cell:
    """Fingerprints filed in one cell, and the connections found so far."""

    def __init__(self) -> None:
        self.filed = np.zeros(0, np.uint64)
        self.star = np.zeros(0, np.int64)

    def file(self, fps: np.ndarray) -> None:
        self.filed = np.concatenate([self.filed, fps])
        self.star = np.arange(len(self.filed))

    def links(self, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Links of some lookups to the filed, at most one for each of either."""
        left, right = [fps[:0]], [fps[:0]]
        if len(self.filed):
            for at in range(0, len(fps), _CHUNK):
                some = fps[at : at + _CHUNK]
                near = np.bitwise_count(some[:, None] ^ self.filed) <= max_bits
                hit = near.any(axis=1)
                some, near = some[hit], near[hit]
                if not len(some):
                    continue
                star = self.star
                while True:
                    lowest = np.where(near, star, len(star)).min(axis=1)
                    lower = np.minimum(star, np.where(near, lowest[:, None], len(star)).min(axis=0))
                    lower = lower[lower]
                    if (lower == star).all():
                        break
                    star = lower
                moved = np.flatnonzero(star != self.star)
                left += [some, self.filed[moved], self.filed[self.star[moved]]]
                right += [self.filed[lowest], self.filed[star[moved]], self.filed[star[moved]]]
                self.star = star
        return np.concatenate(left), np.concatenate(right)


def _linked(max_bits: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by key and cell, the filed ones first."""
        now, cell = None, _Cell()
        for batch in batches:
            places = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)])
            fps = batch.column(2).to_numpy().view(np.uint64)
            filed = batch.column(3).to_numpy(zero_copy_only=False)
            fresh = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1
            cuts = np.concatenate([[0], fresh, [len(fps)]])
            starts = cuts[:-1]
            # Whole groups of one fingerprint, or with nothing filed, link nothing.
            busy = np.minimum.reduceat(fps, starts) != np.maximum.reduceat(fps, starts)
            busy &= np.logical_or.reduceat(filed, starts)
            busy[[0, -1]] = True
            left, right = [fps[:0]], [fps[:0]]
            for i in np.flatnonzero(busy):
                a, b = cuts[i], cuts[i + 1]
                if now != (place := tuple(places[:, a])):
                    now, cell = place, _Cell()
                if filed[a:b].any():
                    cell.file(fps[a:b][filed[a:b]])
                x, y = cell.links(fps[a:b][~filed[a:b]], max_bits)
                left.append(x)
                right.append(y)
            x, y = np.concatenate(left), np.concatenate(right)
            some = x != y
            pairs = [pa.array(v[some].view(np.int64)) for v in (x, y)]
            yield pa.RecordBatch.from_arrays(pairs, ["a", "b"])

    return link


def links(fps: DataFrame, max_bits: int = MAX_BITS, cell: int = CELL) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct ``fp`` within ``max_bits``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("three segments bring together up to two differing bits")
    spark = fps.sparkSession
    keyed = settle(fps.select("fp").mapInArrow(_keys, "key long, fp long, filed boolean"), scratch_path(spark, "keys"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"), F.count_if("filed").alias("n_filed"))
    sizes = settle(sizes.where(F.col("n_filed") > cell), scratch_path(spark, "large-keys"))
    # Keys beyond one cell are at most a 4096th of the rows; the rest has one cell. One
    # of them may hold many rows, so they are told their cells by dealt joins.
    large = sizes.select("key", F.ceil(F.col("n_filed") / cell).cast("int").alias("parts"))
    dealt = lookup(keyed, large, "key", "fp", "left", hot_keys(sizes, "key", "n"))
    dealt = dealt.withColumn("parts", F.coalesce("parts", F.lit(1)))
    one = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = dealt.select("key", F.explode(F.when(F.col("filed"), F.array(one)).otherwise(every)).alias("cell"), "fp", "filed")
    ordered = dealt.repartition("key", "cell").sortWithinPartitions("key", "cell", F.desc("filed"))
    return ordered.mapInArrow(_linked(max_bits), "a long, b long").distinct()


def _rooted(marked: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, root)`` of every distinct fingerprint: its component's least."""
    spark = marked.sparkSession
    nodes = settle(marked.select("fp").distinct(), scratch_path(spark, "fingerprint-nodes"))
    roots = components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return settle(placed, scratch_path(spark, "fingerprint-roots"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, fingerprint, component_id)`` of every document."""
    spark = docs.sparkSession
    marked = settle(fingerprints(docs, shingle), scratch_path(spark, "fingerprints"))
    placed = _rooted(marked, max_bits)
    # A root may have many fingerprints, and a fingerprint many documents.
    own = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = placed.join(own, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = lookup(placed, least, "root", "fp").select("fp", "component_id")
    found = lookup(marked, of_fp, "fp", "doc_id")
    return found.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: that of least id (null ids last), of equal
    ids the one whose text hashes lowest, of equal rows any."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashed = docs.select("doc_id", "text").withColumn("content", F.xxhash64(text))
    # The fingerprint's table carries an id of its own: the row's place is (id, content).
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("bigint").alias("id"), "content")
    keyed = hashed.select(place.alias("place"), text.alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [fingerprint(text, shingle) for text in batch.column(1).to_pylist()]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["place", "fp"])

    schema = keyed.select("place", F.lit(0).cast("bigint").alias("fp")).schema
    marked = settle(keyed.mapInArrow(compute, schema), scratch_path(spark, "fingerprints"))
    placed = _rooted(marked, max_bits)
    own = marked.groupBy("fp", "place").agg(F.count("*").alias("n"))
    own = own.groupBy("fp").agg(F.min(F.struct("place", "n")).alias("best"))
    kept = placed.join(own, "fp").groupBy("root").agg(F.min("best").alias("best"))
    kept = kept.select("best.place.*", "best.n").distinct()
    kept = settle(kept, scratch_path(spark, "representatives"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(
        row,
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(text).alias("content"),
    )
    kept = kept.withColumn("id", F.coalesce("id", F.lit(0)))
    keys = ["no_id", "id", "content"]
    # The short side is hashed, so that texts are moved but not sorted. Only rows that
    # occur more than once have to be told apart after it.
    one, several = (rows.join(kept.where(n).hint("shuffle_hash"), keys, "left_semi") for n in ("n = 1", "n > 1"))
    return one.select("row.*").unionByName(several.dropDuplicates(keys).select("row.*"))
