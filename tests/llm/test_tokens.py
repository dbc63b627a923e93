import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidewheel.llm import chunk_bpe, token_counts, token_files
from tidewheel.llm.bpe import encode, load, slices, tokenizer_path

PARTS = ["a", "the", " ", "  ", "\n", "\t", " ", "\u0085", "\x1c", "é", "ß", "漢", "😀", "'s", "'", "1", "²", "!", "<|endoftext|>", "​", "ſ", "\r", "　", "٣", "Ⅷ"]
TEXTS = [None, "", " ", "one", "two  words \n and 'more'", "x" * 3000, "le café est là " * 400, "a b<|endoftext|> c", "漢字 " * 50]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)] + [(3, "one", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60).map("".join))
def test_ids_and_chunks_equal_the_library(text):
    want = _library().encode(text, add_special_tokens=False).ids
    assert encode(load(tokenizer_path()), text).tolist() == want
    enc = chunk_bpe.encoder(tokenizer_path())
    ids = enc.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert enc.decode(ids) == _library().decode(want, skip_special_tokens=False)


_held = []


def _library():
    if not _held:
        from tokenizers import Tokenizer

        _held.append(Tokenizer.from_file(tokenizer_path()))
    return _held[0]


def test_long_texts_are_cut_at_safe_boundaries(library):
    rnd = random.Random(3)
    text = "".join(rnd.choice(PARTS) for _ in range(40_000))
    parts = list(slices(text, 500))
    assert "".join(parts) == text and len(parts) > 20
    e = load(tokenizer_path())
    assert [i for p in parts for i in encode(e, p).tolist()] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("tail", ["", "x", " x", "<|endoftext|>", "<|endoftext|>\n", "\x1c", "'s"])
@pytest.mark.parametrize("run", [" ", "\n", "\u3000", " \n\t"])
def test_long_white_space_equals_the_library(library, run, tail):
    text = "le mot" + run * (1_200_000 // len(run)) + tail + " fin " + run * 2000 + tail
    want = library.encode(text, add_special_tokens=False).ids
    assert encode(load(tokenizer_path()), text).tolist() == want
    enc = chunk_bpe.ChunkEncoder(tokenizer_path())
    ids = enc.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == want and enc.decode(ids) == text


def test_long_texts_without_boundaries(library):
    text = "".join(random.Random(2).choices("abc一二", k=400_000))
    want = library.encode(text, add_special_tokens=False).ids
    assert encode(load(tokenizer_path()), text).tolist() == want
    assert np.frombuffer(chunk_bpe.ChunkEncoder(tokenizer_path()).encode(text), "<u4").tolist() == want


def test_counts(docs, library):
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs).collect())
    want = sorted((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in [*enumerate(TEXTS), (3, "one")])
    assert got == want


def test_chunks_are_reused():
    enc = chunk_bpe.ChunkEncoder(tokenizer_path())
    rnd = random.Random(8)
    body = " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))) for _ in range(900))
    assert enc.encode("first " + body) != enc.encode("another start, " + body)
    assert enc.reused > enc.seen / 4


def test_round_trip(docs, library):
    got = sorted(tuple(r) for r in chunk_bpe.round_trip(docs).collect())
    want = []
    for i, t in [*enumerate(TEXTS), (3, "one")]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    back = chunk_bpe.decode_documents(chunk_bpe.encode_documents(docs)).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((i, t or "") for i, t in [*enumerate(TEXTS), (3, "one")])


@pytest.mark.parametrize("shard_bytes", [200, 4_000_000])
def test_files(spark, docs, library, tmp_path, shard_bytes):
    out = f"file://{tmp_path}/tokens"
    token_files.write_tokens(docs, out, shard_bytes=shard_bytes)
    got = [tuple(r) for r in token_files.read_tokens(spark, out).orderBy("start").collect()]
    start, want = 0, []
    for i, t in sorted([*enumerate(TEXTS), (3, "one")], key=lambda x: x[0]):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert token_files.read_document(spark, out, 4) == [*library.encode(TEXTS[4], add_special_tokens=False).ids, 2]
    assert token_files.read_document(spark, out, 99) is None


def test_shard_refuses_another_dictionary():
    z = token_files.compressor(b"")
    shard = token_files.pack_shard(hashlib.sha256(b"").digest(), [5, 9], [1, 2], [z.compress(b"abcd"), z.compress(b"abcdefgh")])
    r = token_files.ShardReader(shard, b"")
    assert r.raw(1) == b"abcdefgh" and r.doc_ids.tolist() == [5, 9]
    with pytest.raises(ValueError, match="dictionary"):
        token_files.ShardReader(shard, b"other")


def test_null_id_is_refused_in_files(spark, tmp_path):
    with pytest.raises(Exception, match="without an id"):
        token_files.write_tokens(spark.createDataFrame([(None, "x")], "doc_id long, text string"), f"file://{tmp_path}/bad")


def test_empty_tables(spark, docs, tmp_path):
    none = docs.limit(0)
    assert token_counts.token_counts(none).count() == 0
    assert chunk_bpe.round_trip(none).count() == 0
    token_files.write_tokens(none, f"file://{tmp_path}/none")
    assert token_files.read_tokens(spark, f"file://{tmp_path}/none").count() == 0


def test_groups_are_balanced_by_bytes_and_encoded_by_one_call(library):
    rnd = random.Random(9)
    texts = ["", "é漢 " * 700, "x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b"] + ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(400))) for _ in range(200)] + ["y" * 5000]
    found = list(token_counts.groups(texts, 3000, 500))
    for rows, pieces in found:
        assert sum(len(p.encode()) for p in pieces) <= 3000 or len(pieces) == 1
    assert ["".join(p for rows, pieces in found for r, p in zip(rows, pieces, strict=True) if r == i) for i in range(len(texts))] == texts

    calls = []

    class Counting:
        def __init__(self, enc):
            self.enc = enc

        def __getattr__(self, name):
            return getattr(self.enc, name)

        def encode_to_numpy(self, text, **how):
            calls.append(len(text))
            return self.enc.encode_to_numpy(text, **how)

    enc, n = Counting(load(tokenizer_path())), np.zeros(len(texts), int)
    for rows, pieces in found:
        np.add.at(n, rows, token_counts.batch_lengths(enc, pieces))
    assert len(calls) == len(found) < len(texts) / 3
    assert n.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_arrow_batches_are_cut_by_bytes():
    import pyarrow as pa

    from tidewheel.llm.batches import by_bytes

    b = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 10, None, "é" * 30, "", "b" * 9, "c" * 9])], names=["i", "t"])
    parts = list(by_bytes(b.slice(1), 1, 18))
    assert [p.column(0).to_pylist() for p in parts] == [[1], [2], [3, 4, 5]]
    assert list(by_bytes(b.slice(0, 0), 1)) == []


def test_null_ids_pass(spark):
    docs = spark.createDataFrame([(None, "some text"), (None, "some text"), (None, None)], "doc_id long, text string")
    assert sorted(r.n_tokens for r in token_counts.token_counts(docs).collect()) == [0, 2, 2]
    assert sorted(r.n_tokens for r in chunk_bpe.round_trip(docs).collect()) == [0, 2, 2]
    assert {r.doc_id for r in token_counts.token_counts(docs).collect()} == {None}


def test_a_shard_is_a_row_group(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    rnd = random.Random(4)
    docs = spark.createDataFrame([(i, "".join(rnd.choice(PARTS) for _ in range(300))) for i in range(300)], "doc_id long, text string")
    token_files.write_tokens(docs, f"file://{tmp_path}/t", shard_bytes=2000)
    found = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/t/shards/*.parquet")]
    assert sum(m.num_rows for m in found) == sum(m.num_row_groups for m in found) > 50
    assert not glob.glob(f"{tmp_path}/t/frames")
    assert token_files.read_tokens(spark, f"file://{tmp_path}/t").count() == 300


def test_dictionary_of_distinct_texts(spark, library):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(40)]
    rows = [" ".join(rnd.choice(words) for _ in range(200)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows + [rows[0]] * 3000)], "doc_id long, text string")
    once = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    made = token_files.train_dictionary(docs, tokenizer_path())
    assert made == token_files.train_dictionary(once, tokenizer_path()) and len(made) > 2000
    with pytest.warns(UserWarning, match="no dictionary"):
        assert token_files.train_dictionary(docs.limit(0), tokenizer_path()) == b""


def test_tied_ids_have_one_order(spark, tmp_path):
    rows = [(1, f"text {i}") for i in range(40)] + [(None, "x")][:0]
    out = []
    for k, r in enumerate((rows, rows[::-1])):
        token_files.write_tokens(spark.createDataFrame(r, "doc_id long, text string").repartition(3 + k), f"file://{tmp_path}/{k}")
        out.append(sorted((r.start, r.ids_crc32) for r in token_files.read_tokens(spark, f"file://{tmp_path}/{k}").collect()))
    assert out[0] == out[1]


def test_chunks_of_texts_without_spaces_are_reused(library):
    rnd = random.Random(12)
    body = "".join("".join(chr(rnd.randrange(0x5000, 0x9000)) for _ in range(rnd.randint(2, 9))) + rnd.choice("，。、\n") for _ in range(2000))
    enc = chunk_bpe.ChunkEncoder(tokenizer_path())
    for text in (body, "前言" + body, body[500:] + "。" + body[:500]):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert enc.reused > enc.seen / 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*PARTS, "。", "，", "五", "\u4dc0", "\u2003", "\u205f", "\x85", "\x0b", "'t", "x" * 40]), max_size=80).map("".join))
def test_boundaries_in_bytes_are_safe(text):
    data = text.encode()
    want = _library().encode(text, add_special_tokens=False).ids
    ends = [0, *(m.start() for m in chunk_bpe.BOUNDARY.finditer(data)), len(data)]
    assert [i for a, z in zip(ends, ends[1:], strict=False) for i in _library().encode(data[a:z].decode(), add_special_tokens=False).ids] == want


def test_encoding_with_clashing_columns_and_null_ids(spark, library):
    docs = spark.createDataFrame([(1, "some text", "x"), (None, "other", "y"), (2, None, "z")], "doc_id long, text string, ids string")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in chunk_bpe.encode_documents(docs).collect()}
    assert got == {1: library.encode("some text").ids, None: library.encode("other").ids, 2: []}
