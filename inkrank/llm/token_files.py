"""Token ids in files: each document compressed by itself with one shared dictionary.

A file holds the documents of one range of ids, in ascending order::

    magic | id width | dictionary hash | frame ... frame | index | index start | rows

A frame is the zstandard form of one document's little-endian ids. The index has
one ``(doc_id, null?, tokens, frame start)`` per document, so one document is
read with two short reads: the index, then its frame. The dictionary is trained
on serialized ids of whole documents and lies beside the files under its hash;
a file names the hash it needs.

Edge cases: a null or empty text is a document of the end id alone; null ids come
first and are found under ``None``; documents of equal id are all kept, in the
order of their frames;
an empty table makes no file and reads back as no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkrank.llm.common import lowest, shared_files, sliced, texts
from inkrank.llm.tokens import default_tokenizer, encoder, release
from inkrank.session import settle

_MAGIC = b"IDFILE1\n"
_HEAD = "<8sB32s"
_FOOT = "<QQ8s"
_INDEX = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("tokens", "<u4"), ("start", "<u8")])

#: Documents that the dictionary is trained on at most, and the longest of them.
DICTIONARY_DOCS = 512
DICTIONARY_DOC_CHARS = 32 << 10
DICTIONARY_BYTES = 112 << 10
#: Frames that one read of a whole file takes, about.
READ_BYTES = 4 << 20
LEVEL = 3

END_ID = 0


def _put(files: fs.FileSystem, path: str, chunks: Iterator[bytes]) -> None:
    """Write under another name, then rename: readers never see half a file, and
    attempts of one task end in the same file."""
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
    files.move(part, path)


def _dtype(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A dictionary from the ids of the whole documents whose ids hash lowest.

    The sample has at most ``DICTIONARY_DOCS`` documents, none of more than
    ``DICTIONARY_DOC_CHARS``. Too little text to train on gives none.
    """
    # Ids alone; then one scan of the texts for those few.
    chosen = lowest(docs.where("doc_id is not null").select("doc_id"), ["doc_id"], DICTIONARY_DOCS).collect()

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        kind = _dtype(words.vocabulary)
        for batch in batches:
            ids = [x.astype(kind).tobytes() for x in words.encode(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    if not chosen:
        return b""
    picked = docs.where(F.col("doc_id").isin([row.doc_id for row in chosen])).select("text")
    picked = picked.where(F.length("text").between(1, DICTIONARY_DOC_CHARS)).limit(2 * DICTIONARY_DOCS)
    samples = sorted(bytes(row.ids) for row in picked.mapInArrow(ids_of, "ids binary").collect())
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if size < 1024 or len(samples) < 16:
        return b""
    return zstandard.train_dictionary(size, samples).as_bytes()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID
) -> DataFrame:
    """Encode ``(doc_id, text)`` into files under ``folder``; returns their manifest.

    The manifest, ``(part, file, rows, tokens)`` in ascending order of ids, is a
    table of one row per file, kept beside the files.
    """
    tokenizer = tokenizer or default_tokenizer()
    docs = texts(docs)
    files, base = shared_files(folder)
    files.create_dir(f"{base}/ids")
    trained = train_dictionary(docs, tokenizer)
    digest = hashlib.sha256(trained).digest()
    width = _dtype(encoder(tokenizer).vocabulary).itemsize
    _put(files, f"{base}/ids/{digest.hex()}.dict", iter([trained]))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        kind = _dtype(words.vocabulary)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(trained))
        for batch in sliced(batches):
            found = [np.append(x, np.uint32(end_id)) for x in words.encode(batch.column(1))]
            frames = [packer.compress(ids.astype(kind).tobytes()) for ids in found]
            columns = [pa.array([len(ids) for ids in found], pa.int64()), pa.array(frames, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "tokens", "frame"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}.ids"
        index: list[np.ndarray] = []

        def chunks() -> Iterator[bytes]:
            yield struct.pack(_HEAD, _MAGIC, width, digest)
            at = struct.calcsize(_HEAD)
            for batch in batches:
                frames = batch.column(2).to_pylist()
                rows = np.zeros(len(frames), _INDEX)
                keys = batch.column(0)
                rows["doc_id"] = keys.fill_null(0).to_numpy(zero_copy_only=False)
                rows["is_null"] = keys.is_null().to_numpy(zero_copy_only=False)
                rows["tokens"] = batch.column(1).to_numpy()
                sizes = np.array([len(frame) for frame in frames], np.uint64)
                rows["start"] = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                index.append(rows)
                yield b"".join(frames)
            yield b"".join(rows.tobytes() for rows in index)
            yield struct.pack(_FOOT, at, sum(map(len, index)), _MAGIC)

        first = next(batches, None)
        if first is None:
            return
        batches = _after(first, batches)
        there, path = shared_files(folder)
        _put(there, f"{path}/ids/{name}", chunks())
        rows, tokens = sum(map(len, index)), sum(int(x["tokens"].sum()) for x in index)
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "rows": [rows], "tokens": [tokens]})

    # Ids are made and compressed where the texts are read; only frames are moved.
    frames = docs.mapInArrow(compress, "doc_id long, tokens long, frame binary")
    frames = settle(frames, f"{folder.rstrip('/')}/frames")
    # Rows of one id, or without one, are dealt by their frames and equal ones by their
    # place in the written table, so no id fills a file. Ranges are drawn from short rows.
    order = ["doc_id", "mark", "at"]
    marked = frames.withColumns({"mark": F.xxhash64("frame"), "at": F.monotonically_increasing_id()})
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("mark", "at")
    manifest = ordered.mapInArrow(write, "part long, file string, rows long, tokens long")
    return settle(manifest, f"{folder.rstrip('/')}/manifest").where("rows > 0").orderBy("part")


def _after(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


class TokenFile:
    """One file, open for reading all of it or single documents."""

    def __init__(self, folder: str, name: str):
        files, base = shared_files(folder)
        self._file = files.open_input_file(f"{base}/ids/{name}")
        size, foot = self._file.size(), struct.calcsize(_FOOT)
        start, rows, magic = struct.unpack(_FOOT, self._file.read_at(foot, size - foot))
        head, width, digest = struct.unpack(_HEAD, self._file.read_at(struct.calcsize(_HEAD), 0))
        if magic != _MAGIC or head != _MAGIC:
            raise ValueError(f"{name} is no file of token ids")
        self._kind = np.dtype(f"<u{width}")
        self.index = np.frombuffer(self._file.read_at(rows * _INDEX.itemsize, start), _INDEX)
        self._ends = np.append(self.index["start"][1:], np.uint64(start)).astype(np.int64)
        with files.open_input_stream(f"{base}/ids/{digest.hex()}.dict") as stream:
            trained = stream.read()
        if hashlib.sha256(trained).digest() != digest:
            raise ValueError(f"the dictionary of {name} is not the one it was written with")
        self._unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(trained))

    def ids(self, row: int) -> np.ndarray:
        start = int(self.index["start"][row])
        frame = self._file.read_at(int(self._ends[row]) - start, start)
        return np.frombuffer(self._unpacker.decompress(frame), self._kind).astype("<u4")

    def runs(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """All documents in order, as the first's row and the ids of some: one read of
        about ``READ_BYTES`` each."""
        starts = self.index["start"].astype(np.int64)
        a = 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(self._ends, starts[a] + READ_BYTES, "right")))
            data = self._file.read_at(int(self._ends[b - 1] - starts[a]), int(starts[a]))
            cuts = zip(starts[a:b] - starts[a], self._ends[a:b] - starts[a], strict=True)
            yield a, [np.frombuffer(self._unpacker.decompress(data[x:y]), self._kind).astype("<u4") for x, y in cuts]
            a = b

    def of(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of each document with this id, without reading the others."""
        same = (self.index["is_null"] == 0) & (self.index["doc_id"] == (doc_id or 0))
        rows = self.index["is_null"] == 1 if doc_id is None else same
        return [self.ids(i) for i in np.flatnonzero(rows)]


def read_token_files(manifest: DataFrame, folder: str, keep_ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` of every document.

    ``start`` counts the ids of all documents before it, in file order; ``ids`` are
    little-endian 32-bit integers.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, so this window holds no data of the documents.
    placed = manifest.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for name, base in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                file = TokenFile(folder, name)
                rows = file.index
                starts = base + np.cumsum(rows["tokens"], dtype=np.int64) - rows["tokens"]
                for at, ids in file.runs():
                    some = slice(at, at + len(ids))
                    columns = [
                        pa.array(rows["doc_id"][some], mask=rows["is_null"][some] == 1),
                        pa.array(starts[some], pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    ]
                    columns += [pa.array([x.tobytes() for x in ids], pa.binary())] * keep_ids
                    yield pa.RecordBatch.from_arrays(columns, names)

    # As many tasks as files, each with some rows of the manifest.
    width = max(1, manifest.count())
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids
    return placed.repartition(width, "file").mapInArrow(read, schema)


def read_document(spark: SparkSession, folder: str, doc_id: int | None) -> list[np.ndarray]:
    """The ids of one document, by the indexes alone (short reads, no scan)."""
    names = [row.file for row in spark.read.parquet(f"{folder.rstrip('/')}/manifest").collect() if row.rows]
    return [ids for name in sorted(names) for ids in TokenFile(folder, name).of(doc_id)]
