"""Shard files against plain arrays, and their ids against the tokenizers library."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlake.llm import wavelet
from eventlake.llm.queries import QUERIES, vocabulary_file
from eventlake.session import scratch_folder

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary_file("word_bpe_49k.json")


@pytest.mark.parametrize(
    ("size", "most"), [(0, 1), (1, 1), (7, 3), (40_000, 2), (100_000, 49_408), (70_000, 90_000)]
)
def test_look_ups(size, most):
    draw = np.random.default_rng(size)
    tokens = draw.zipf(1.3, size).astype(np.int64) % most
    lengths = np.array([0, size // 3, size - size // 3])
    stored = wavelet.build(tokens, np.array([4, 5, 6]), lengths)
    matrix = wavelet.WaveletMatrix(stored)
    assert matrix.tokens().tolist() == tokens.tolist()
    assert matrix.documents.tolist() == [4, 5, 6]
    assert matrix.lengths.tolist() == lengths.tolist()
    for position in draw.integers(0, max(1, size), 20 if size else 0).tolist():
        assert matrix.access(position) == tokens[position]
    for token in [*tokens[:10].tolist(), most, 10**6]:
        low, high = sorted(draw.integers(0, size + 1, 2).tolist())
        assert matrix.count(token) == (tokens == token).sum()
        assert matrix.count(token, low, high) == (tokens[low:high] == token).sum()
        places = np.flatnonzero(tokens == token)
        for nth in {0, len(places) // 2, len(places) - 1} & set(range(len(places))):
            assert matrix.occurrence(token, nth) == places[nth]
        with pytest.raises(IndexError):
            matrix.occurrence(token, len(places))
    with pytest.raises(IndexError):
        matrix.access(size)


def test_files_are_smaller_than_their_ids_and_refuse_others():
    tokens = np.random.default_rng(0).zipf(1.2, 200_000) % 49_408
    stored = wavelet.build(tokens, np.array([1]), np.array([len(tokens)]))
    assert len(stored) < 2 * len(tokens)
    with pytest.raises(ValueError, match="wavelet"):
        wavelet.WaveletMatrix(b"0" * 200)


class Counted(pa.PythonFile):
    """An open file that counts the bytes read from it."""

    read_bytes = 0

    def read_at(self, size, at):
        Counted.read_bytes += size
        return super().read_at(size, at)


def test_look_ups_read_single_blocks(tmp_path):
    tokens = np.random.default_rng(0).zipf(1.2, 2_000_000) % 49_408
    stored = wavelet.build(tokens, np.arange(1000), np.full(1000, 2000))
    (tmp_path / "a.wm").write_bytes(stored)
    with open(tmp_path / "a.wm", "rb") as file:
        matrix = wavelet.WaveletMatrix(Counted(file, "r"))
        head = Counted.read_bytes
        assert head < len(stored) / 50
        assert matrix.access(1_234_567) == tokens[1_234_567]
        assert Counted.read_bytes - head < len(stored) / 20
        assert matrix.count(7) == (tokens == 7).sum()
        assert matrix.occurrence(7, 100) == np.flatnonzero(tokens == 7)[100]
        assert matrix.lengths.tolist() == [2000] * 1000


def test_all_files_are_asked(spark, documents):
    rows = [(i, f"the cat {'and the dog ' * (i % 5)}sat on mat {i}") for i in range(120)]
    folder = scratch_folder(spark)
    with open(PATH, encoding="utf-8") as file:
        manifest = wavelet.write_shards(documents(rows), file.read(), folder, 2, shard_tokens=200)
    assert manifest.count() > 5
    library = tokenizers.Tokenizer.from_file(PATH)
    flat = np.array([t for _, text in rows for t in [*library.encode(text, add_special_tokens=False).ids, 2]])
    positions = [0, 1, 199, 200, 777, len(flat) - 1, len(flat), 777]
    got = dict(map(tuple, wavelet.ids_at(manifest, folder, positions).collect()))
    assert got == {p: flat[p] for p in positions if p < len(flat)}
    ids = [2, int(flat[0]), int(flat[3]), 40_000, 10**6]
    counted = dict(map(tuple, wavelet.count_ids(manifest, folder, ids).collect()))
    assert counted == {i: (flat == i).sum() for i in ids if (flat == i).any()}
    places = np.flatnonzero(flat == flat[0])
    nths = [0, 1, 50, len(places) - 1, len(places)]
    found = dict(map(tuple, wavelet.find_id(manifest, folder, int(flat[0]), nths).collect()))
    assert found == {n: places[n] for n in nths if n < len(places)}
    assert wavelet.find_id(manifest, folder, 10**6, [0]).collect() == []


def brute(rows):
    library = tokenizers.Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_odd_texts(documents, odd_texts):
    rows = list(enumerate(odd_texts))
    got = wavelet.wavelet_report(documents(rows), PATH).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_repeated_and_missing_ids(documents):
    rows = [(7, "b a"), (7, "b a"), (3, None), (None, "c"), (5, "")]
    docs = documents(rows).withColumn("ids", F.lit("old"))
    got = sorted(tuple(r)[1:] for r in wavelet.wavelet_report(docs, PATH).collect())
    order = [(None, "c"), (3, None), (5, ""), (7, "b a"), (7, "b a")]
    assert got == sorted(row[1:] for row in brute(order))
    assert wavelet.wavelet_report(docs.where("doc_id = 77"), PATH).collect() == []


def test_many_small_files_hold_the_same(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("doc_id < 120")
    with open(PATH, encoding="utf-8") as file:
        tokenizer = file.read()
    folder = scratch_folder(spark)
    manifest = wavelet.write_shards(docs, tokenizer, folder, 2, shard_tokens=500)
    assert manifest.count() > 1
    found = wavelet.read_shards(manifest, folder).withColumn("ids_crc32", F.crc32("ids"))
    got = sorted(map(tuple, found.drop("ids").collect()))
    assert got == brute(sorted((r.doc_id, r.text) for r in docs.collect()))


def test_another_tokenizer_is_refused(documents):
    with pytest.raises(ValueError, match="tokenizer"):
        wavelet.wavelet_report(documents([(1, "a")]), vocabulary_file("byte_bpe_50k.json"))


def test_query(spark, tables):
    rows = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op3_wavelet"](spark, tables).collect()
    assert sorted(map(tuple, got)) == brute(sorted(map(tuple, rows)))
