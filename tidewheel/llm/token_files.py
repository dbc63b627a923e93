"""Token-id files: documents compressed one by one under a shared zstandard dictionary.

A shard is one byte string: MAGIC, version, dictionary hash (32 bytes), number of documents,
end-id flag, then the doc ids (int64), the running token counts (int64, one more than
documents), the frame offsets (int64, one more than documents) and the frames. Ids are
written as little-endian unsigned 32-bit integers before compression. A document is read
by decompressing its own frame. Shards lie in Parquet files (one column ``shard``), because
Spark can commit those to any store that executors share; ``dictionary`` lies beside them.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidewheel.plans.storage import delete

from .batches import by_bytes
from .bpe import encode, load, tokenizer_path

MAGIC = b"TWTOK001"
HEAD = struct.Struct("<8s32sq")
LEVEL = 3
SHARD_BYTES = 1_000_000  # frames of a shard; what a read of one document fetches
#: Every row of the shard files is a row group, so a filter on the ids of a shard reads that shard alone.
ROW_GROUPS = {"compression": "uncompressed", "parquet.block.size": "1", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.block.row.count.limit": "1"}


def pack_shard(dictionary_hash: bytes, doc_ids: list[int], counts: list[int], frames: list[bytes]) -> bytes:
    n = len(doc_ids)
    tokens, offsets = (np.concatenate([[0], np.cumsum(np.asarray(x, np.int64))]).astype("<i8") for x in (counts, [len(f) for f in frames]))
    return b"".join([HEAD.pack(MAGIC, dictionary_hash, n), np.asarray(doc_ids, "<i8").tobytes(), tokens.tobytes(), offsets.tobytes(), *frames])


class ShardReader:
    """Random access to the documents of a shard."""

    def __init__(self, shard: bytes, dictionary: bytes):
        magic, digest, n = HEAD.unpack_from(shard)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        at = HEAD.size
        self.doc_ids = np.frombuffer(shard, "<i8", n, at)
        self.tokens = np.frombuffer(shard, "<i8", n + 1, at + 8 * n)
        self.offsets = np.frombuffer(shard, "<i8", n + 1, at + 16 * n + 8)
        self.body, self.shard = at + 24 * n + 16, shard
        self.codec = decompressor(dictionary)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def raw(self, i: int) -> bytes:
        """Document i's ids, as little-endian unsigned 32-bit integers."""
        a, b = self.offsets[i], self.offsets[i + 1]
        return self.codec.decompress(self.shard[self.body + a : self.body + b])


@functools.lru_cache(maxsize=4)
def compressor(dictionary: bytes):
    import zstandard as z

    return z.ZstdCompressor(level=LEVEL, dict_data=z.ZstdCompressionDict(dictionary) if dictionary else None)


@functools.lru_cache(maxsize=4)
def decompressor(dictionary: bytes):
    import zstandard as z

    return z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(dictionary) if dictionary else None)


def train_dictionary(docs: DataFrame, path: str, sample: int = 400, most: int = 16_384, size: int = 32_768, text_col: str = "text", end_id: int | None = 2) -> bytes:
    """A dictionary from the id arrays of a bounded sample: of texts of at most ``most`` bytes, the ``sample`` ones of smallest hash.

    Too few or too small texts to train on give b"": documents are then compressed without one.
    """
    import zstandard as z

    text = F.coalesce(F.col(text_col), F.lit(""))
    small = docs.select(text.alias("t")).where(F.octet_length("t") <= most).select(F.xxhash64("t").alias("h"), "t")
    last = small.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h").alias("h")).first().h  # hashes alone meet on the way
    rows = small.where(F.col("h") <= F.lit(last)).groupBy("h").agg(F.min("t").alias("t")).orderBy("h").limit(sample).collect() if last is not None else []
    enc, tail = load(path), [] if end_id is None else [end_id]
    arrays = [np.asarray([*encode(enc, r.t), *tail], "<u4").tobytes() for r in rows]
    try:
        return z.train_dictionary(size, arrays).as_bytes()
    except z.ZstdError as e:
        warnings.warn(f"no dictionary could be trained on {len(arrays)} texts ({e}): documents are compressed without one", stacklevel=2)
        return b""


def write_tokens(docs: DataFrame, out: str, path: str | None = None, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every text, append end_id, and write shards in ascending doc_id order to ``out``.

    Texts are encoded once and where they lie; only compressed frames are sorted. Null text
    counts as empty (the end id alone); rows with a null id are refused, as the order and the
    index need one; rows of equal id stand next to each other, by a hash of their text, so that the
    files are the same in every run. Extra columns are ignored.
    An empty table writes an empty set of shards.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path()
    dictionary = train_dictionary(docs, path, text_col=text_col, end_id=end_id)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), dictionary)], "sha256 string, body binary").coalesce(1).write.parquet(f"{out}/dictionary")
    digest = hashlib.sha256(dictionary).digest()
    tail = np.asarray([] if end_id is None else [end_id], "<u4")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, z = load(path), compressor(dictionary)
        for whole in batches:
            for b in by_bytes(whole, 2):
                n, f = [], []
                for t in b.column(2):
                    ids = np.concatenate([np.asarray(encode(enc, t.as_py()), "<u4"), tail])
                    n.append(len(ids))
                    f.append(z.compress(ids.tobytes()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(f, pa.binary())], names=["id", "h", "n", "frame"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, held, size, seq = [], [], [], 0, 0

        def done() -> pa.RecordBatch:
            row = ([seq], [ids[0]], [ids[-1]], [sum(counts)])
            return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in row), pa.array([pack_shard(digest, ids, counts, held)], pa.binary())], names=["seq", "first_id", "last_id", "n_tokens", "shard"])

        for b in batches:
            for i, n, f in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if size and size + len(f) > shard_bytes:
                    yield done()
                    ids, counts, held, size, seq = [], [], [], 0, seq + 1
                ids.append(i)
                counts.append(n)
                held.append(f)
                size += len(f)
        if ids:
            yield done()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.select(F.when(F.col("id").isNull(), F.raise_error(F.lit("a document without an id"))).otherwise(F.col("id")).cast("long").alias("id"), F.xxhash64("t").alias("h"), "t")
    rows.mapInArrow(frames, "id long, h long, n long, frame binary").write.option("compression", "uncompressed").parquet(f"{out}/frames")
    kept = spark.read.parquet(f"{out}/frames")
    ordered = kept.repartitionByRange("id", "h").sortWithinPartitions("id", "h")
    ordered.mapInArrow(shards, "seq long, first_id long, last_id long, n_tokens long, shard binary").withColumn("part", F.spark_partition_id()).write.options(**ROW_GROUPS).parquet(f"{out}/shards")
    delete(spark, f"{out}/frames")


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids of all documents before it: ids before the range, plus ids before
    the shard in its range, plus ids before the document in its shard. The window without a
    key sees one row a range, the keyed one a row a shard. Rows come back once each, repeated
    ones too; the files of an empty table give an empty result.
    """
    dictionary = bytes(spark.read.parquet(f"{out}/dictionary").first().body)
    files = spark.read.parquet(f"{out}/shards")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, seq, shard in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                r = ShardReader(shard, dictionary)
                n = len(r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int64()), pa.array(r.doc_ids), pa.array(r.tokens[:-1]), pa.array(np.diff(r.tokens)), pa.array([zlib.crc32(r.raw(i)) for i in range(n)], pa.int64())],
                    names=["part", "seq", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    index = files.select("part", "seq", "n_tokens")
    ranges = index.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    ranges = ranges.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("before_range"))
    in_range = Window.partitionBy("part").orderBy("seq")
    starts = index.select("part", "seq", (F.sum("n_tokens").over(in_range) - F.col("n_tokens")).alias("before_shard")).join(ranges, "part")
    docs = files.select("part", "seq", "shard").mapInArrow(read, "part int, seq long, doc_id long, within long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("before_range") + F.col("before_shard") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, out: str, doc_id: int) -> list[int] | None:
    """The ids of one document, the first one if its id repeats: one shard is fetched, one frame decompressed. None if there is no such document."""
    files = spark.read.parquet(f"{out}/shards").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    dictionary = bytes(spark.read.parquet(f"{out}/dictionary").first().body)
    for row in files.orderBy("part", "seq").limit(1).collect():
        r = ShardReader(bytes(row.shard), dictionary)
        at = int(np.searchsorted(r.doc_ids, doc_id))
        if at < len(r) and r.doc_ids[at] == doc_id:
            return np.frombuffer(r.raw(at), "<u4").tolist()
    return None
