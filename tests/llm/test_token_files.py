"""Token files and packing against plain encoding, and the plan against its bounds."""

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from inkrank.llm import packing, token_files
from inkrank.llm.tokens import Encoder, default_tokenizer
from inkrank.session import scratch_path

ODD = ["", " ", "a", " a", "a ", "a  b", "a \n b", "x<|endoftext|> y", "a\nb\n", "don't  'll", "é, x",
       "a\u0085b  c", "\x1c \x1d", "it's 12 3,4", "Ġ aĠ Ġb", "word'... (x), y_z. ²,", "," * 50, None]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_cached_words_give_the_tokenizers_ids(plain, small):
    texts = [x or "" for x in ODD] + pq.read_table(f"{small}/documents.parquet")["text"].to_pylist()
    found = Encoder(default_tokenizer()).encode(texts)
    assert [[*map(int, ids), 0] for ids in found] == [plain(text) for text in texts]


def test_cache_that_overflows(plain, monkeypatch):
    monkeypatch.setattr("inkrank.llm.tokens.CACHE_WORDS", 3)
    words = Encoder(default_tokenizer())
    for text in ["a b, c d e f.", "g h a b", "a"]:
        assert [*map(int, words.encode([text])[0]), 0] == plain(text)


def test_files_round_trip(spark, documents, plain):
    text_of_6 = ODD[2]
    long = "word " * 60_000 + "x" * 5000
    pairs = [(i * 3, text) for i, text in enumerate([*ODD, long])] + [(None, "no id"), (6, text_of_6), (6, text_of_6)]
    folder = scratch_path(spark, "test")
    manifest = token_files.write_token_files(documents(pairs), folder)
    found = token_files.read_token_files(manifest, folder).collect()
    assert all(row.ids_crc32 == zlib.crc32(row.ids) and 4 * row.n_tokens == len(row.ids) for row in found)
    rows = [tuple(row)[:4] for row in found]
    ordered = sorted(pairs, key=lambda x: (x[0] is not None, x[0] or 0, (x[1] or "").encode()))
    start, expected = 0, []
    for doc, text in ordered:
        ids = plain(text)
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(rows, key=lambda x: x[1]) == expected
    assert [list(x) for x in token_files.read_document(spark, folder, 6)] == [plain(t) for d, t in ordered if d == 6]
    assert [list(x) for x in token_files.read_document(spark, folder, None)] == [plain("no id")]
    assert token_files.read_document(spark, folder, 1) == []


def test_dictionary_is_trained_and_checked(spark, small, plain, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    manifest = token_files.write_token_files(docs, str(tmp_path))
    assert sum(row.rows for row in manifest.collect()) == docs.count()
    [dictionary] = (tmp_path / "ids").glob("*.dict")
    assert dictionary.stat().st_size > 10_000
    row = docs.first()
    assert [list(x) for x in token_files.read_document(spark, str(tmp_path), row.doc_id)] == [plain(row.text)]
    dictionary.write_bytes(b"")
    with pytest.raises(ValueError, match="dictionary"):
        token_files.read_document(spark, str(tmp_path), row.doc_id)


def test_no_documents(spark, documents):
    folder = scratch_path(spark, "test")
    manifest = token_files.write_token_files(documents([]), folder)
    assert token_files.read_token_files(manifest, folder).count() == 0
    assert packing.pack(packing.pieces(documents([]))).count() == 0


def check_packed(rows, texts, plain, sequence):
    whole = {}
    for row in rows:
        whole.setdefault(row.doc_id, []).append(row)
    assert set(whole) == set(texts)
    for doc, parts in whole.items():
        ids, parts = plain(texts[doc]), sorted(parts, key=lambda x: x.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        at = 0
        for part in parts:
            assert part.start == at and (part.length == sequence or part.piece == 0)
            data = np.array(ids[at : at + part.length], "<u4").tobytes()
            assert part.ids_crc32 == zlib.crc32(data)
            at += part.length
        assert at == len(ids)
    filled = {}
    for row in rows:
        filled.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sequence
    return len(filled)


def test_packing(documents, plain, small):
    texts = dict(enumerate([x or "" for x in ODD] + pq.read_table(f"{small}/documents.parquet")["text"].to_pylist()))
    texts |= {1000 + i: "the same" for i in range(500)}
    rows = packing.pack(packing.pieces(documents(list(texts.items())), 256), 256, salts=3).collect()
    used = check_packed(rows, texts, plain, 256)
    assert used <= 1.01 * sum(row.length for row in rows) / 256 + 1


def best_fit_decreasing(lengths, sequence):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [room for room in rooms if room >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(sequence - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_equals_best_fit_by_pieces(seed):
    rng = random.Random(seed)
    sequence = rng.choice([10, 64, 100])
    lengths = [rng.randint(1, rng.choice([sequence, sequence // 3])) for _ in range(rng.randint(1, 400))]
    histogram = {x: lengths.count(x) for x in set(lengths)}
    taken, ranks = {}, {}
    for length, rank, count, first, offset in packing.plan(histogram, sequence):
        assert rank == ranks.get(length, 0)
        ranks[length] = rank + count
        for i in range(count):
            taken.setdefault(first + i, []).append((offset, length))
    assert ranks == histogram
    for parts in taken.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sequence
    assert len(taken) == best_fit_decreasing(lengths, sequence)


def test_plan_does_not_grow_with_the_counts():
    histogram = {length: 1 + length * 7919 % 1000 for length in range(1, 2049)}
    small = packing.plan(histogram)
    large = packing.plan({length: n * 1_000_003 for length, n in histogram.items()})
    assert len(large) < 3 * len(small) + 10_000


def test_a_hot_id_fills_several_files(spark, documents, plain):
    """A third of the rows share an id, some of them their text as well."""
    pairs = [(7 if i % 3 == 0 else i, f"text {i % 200} of some words") for i in range(3000)] + [(None, "x")] * 300
    folder = scratch_path(spark, "test")
    # So few rows would be put into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_token_files(documents(pairs).repartition(4), folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = token_files.read_token_files(manifest, folder).collect()
    files = [row.file for row in manifest.collect()]
    held = [sum(int(x) == 7 for x in token_files.TokenFile(folder, name).index["doc_id"]) for name in files]
    assert sum(n > 0 for n in held) > 1 and max(held) < 900
    rows.sort(key=lambda row: row.start)
    assert [row.doc_id for row in rows] == sorted((doc for doc, _ in pairs), key=lambda x: (x is not None, x or 0))
    assert [row.start for row in rows] == np.cumsum([0, *(row.n_tokens for row in rows)])[:-1].tolist()
    found = sorted((row.doc_id or -1, bytes(row.ids)) for row in rows)
    assert found == sorted((doc or -1, np.array(plain(text), "<u4").tobytes()) for doc, text in pairs)


@pytest.mark.parametrize("read_bytes", [1, 100, 4 << 20])
def test_reads_of_any_size_give_the_same(spark, documents, monkeypatch, plain, read_bytes):
    monkeypatch.setattr(token_files, "READ_BYTES", read_bytes)
    folder = scratch_path(spark, "test")
    pairs = [(i, f"{'word ' * (i * 7 % 50)}{i}") for i in range(80)]
    manifest = token_files.write_token_files(documents(pairs), folder)
    for row in manifest.collect():
        file = token_files.TokenFile(folder, row.file)
        runs = list(file.runs())
        assert [a for a, _ in runs] == np.cumsum([0, *(len(ids) for _, ids in runs)])[:-1].tolist()
        whole = [ids.tolist() for _, some in runs for ids in some]
        assert whole == [file.ids(i).tolist() for i in range(row.rows)]
        assert read_bytes > 1 or len(runs) == row.rows


def test_words_with_marks_and_words_not_there():
    """A miss is told by the dict itself; letters and marks of a word may be there before it."""
    words = Encoder(default_tokenizer())
    texts = ["so it", "so, it goes. (so) ,, .so so.)", ", so,", "goes.)\nso, ...", "", "so  it,"]
    whole = [list(x) for x in words._whole(texts)]
    assert type(words._places) is dict and words._at(["so", "it"]).tolist() == [-1, -1]
    assert [list(words.encode([text])[0]) for text in texts] == whole
    assert [list(x) for x in words.encode(texts)] == whole
    assert words._at(["so", "nowhere"])[0] >= 0 > words._at(["so", "nowhere"])[1]
