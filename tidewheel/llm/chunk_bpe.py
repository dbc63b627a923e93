"""BPE encoding that encodes each content-defined chunk once, and decoding."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import by_bytes
from .bpe import encode_part, load, tokenizer_path

#: Safe boundaries that are seen in bytes: white space after a character that isn't white space
#: (no pre-token goes on over it), and a Chinese comma or full stop after a Chinese letter.
BOUNDARY = re.compile(
    rb"(?<=[!-~\x80-\xbf])(?<!\xc2[\x85\xa0])(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\x8a\xa8\xa9\xaf])(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80)(?=[ \t-\r])"
    rb"|(?<=[\xe5-\xe8][\x80-\xbf][\x80-\xbf])(?=\xe3\x80[\x81\x82]|\xef\xbc\x8c)"
)

#: The commonest kind alone, which is found faster: a space after printable ASCII.
PLAIN_BOUNDARY = re.compile(rb"(?<=[!-~])(?= )")
LAST_PLAIN_BOUNDARY = re.compile(rb".*[!-~](?= )", re.DOTALL)


def ends_of(chunk: bytes) -> tuple[int, int] | None:
    """Two safe boundaries of a chunk, far apart: plain ones if it has two, else its first and last of any kind."""
    first, last = PLAIN_BOUNDARY.search(chunk), LAST_PLAIN_BOUNDARY.match(chunk)
    if first and last.end() > first.end():
        return first.end(), last.end()
    found = [m.start() for m in BOUNDARY.finditer(chunk)]
    return (found[0], found[-1]) if len(found) > 1 else None


@functools.cache
def _gear() -> np.ndarray:
    return np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(data: bytes, mask_bits: int = 8) -> list[int]:
    """Chunk ends by a rolling hash of the last 16 bytes: equal passages are cut alike wherever they stand."""
    b = np.frombuffer(data, np.uint8)
    if len(b) <= 32:
        return [len(b)]
    h = _gear()[b]
    for shift in (1, 2, 4, 8):  # window doubles: 2, 4, 8, 16 bytes
        g = h.copy()
        g[shift:] += h[:-shift] << np.uint32(shift)
        h = g
    at = np.flatnonzero((h >> np.uint32(15)) & np.uint32((1 << mask_bits) - 1) == 0) + 1
    return [*at[(at >= 16) & (at < len(b))].tolist(), len(b)]


class ChunkEncoder:
    """Encodes texts from chunks remembered across documents.

    A chunk keeps the ids of its middle, from its first to its last safe boundary. At each
    join the window is widened, left and right, until both of its ends are safe boundaries;
    it is encoded anew there, and beyond its ends old and new ids agree exactly, as no
    pre-token crosses a boundary whatever stands on its other side. A chunk without two
    boundaries goes into the window whole. Memos are bounded by bytes.
    """

    def __init__(self, path: str, max_bytes: int = 16_000_000):
        self.enc, self.max_bytes = load(path), max_bytes
        self.chunks: dict[bytes, tuple[int, int, bytes] | None] = {}
        self.joins: dict[bytes, bytes] = {}
        self.held = self.reused = self.seen = 0

    def _ids(self, piece: bytes) -> bytes:
        return np.asarray(encode_part(self.enc, piece.decode("utf-8")), "<u4").tobytes()

    def _chunk(self, c: bytes) -> tuple[int, int, bytes] | None:
        ends = ends_of(c)
        return ends and (*ends, self._ids(c[ends[0] : ends[1]]))

    def _join(self, span: bytes) -> bytes:
        ids = self.joins.get(span)
        if ids is None:
            ids = self._ids(span)
            if len(span) <= 256:
                self.joins[span] = ids
                self.held += 2 * len(span) + 150
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of text as little-endian unsigned 32-bit integers."""
        if self.held > self.max_bytes:
            self.chunks.clear()
            self.joins.clear()
            self.held = 0
        data, out, open_, start = text.encode("utf-8"), [], [], 0
        for end in cuts(data):
            c = data[start:end]
            start = end
            self.seen += 1
            known = self.chunks.get(c, 0)
            if known == 0:
                known = self.chunks[c] = self._chunk(c)
                self.held += 3 * len(c) + 250
            else:
                self.reused += 1
            if known is None:
                open_.append(c)
                continue
            head, tail, ids = known
            out += (self._join(b"".join([*open_, c[:head]])), ids)
            open_ = [c[tail:]]
        if open_:
            out.append(self._join(b"".join(open_)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return self.enc.decode_bytes(np.frombuffer(ids, "<u4").tolist()).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids binary) of every row: little-endian unsigned 32-bit ids, no special tokens added.

    Null text counts as empty (no ids). Null ids, repeated rows and an empty table pass through.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for b in by_bytes(whole, 1):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([enc.encode(t.as_py()) for t in b.column(1)], pa.binary())], names=["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, ids binary").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids binary); special tokens are kept, bytes that aren't UTF-8 become U+FFFD."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for b in by_bytes(whole, 1):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([enc.decode(x.as_py() or b"") for x in b.column(1)], pa.string())], names=["id", "text"])

    return encoded.select(F.col(id_col).alias("id"), "ids").mapInArrow(run, f"id {encoded.schema[id_col].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes every text in one pass, and returns digests.

    Null text counts as empty. Null ids, repeated rows and an empty table pass through; extra
    columns are ignored.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n, a, d = [], [], []
            for t in b.column(1):
                ids = enc.encode(t.as_py())
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                d.append(hashlib.sha256(enc.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
