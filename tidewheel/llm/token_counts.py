"""Token counts: Arrow batches in, lengths out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import by_bytes
from .bpe import PLAIN, encode_part, load, slices, tokenizer_path

GROUP_BYTES = 1_000_000  # UTF-8 bytes of a batch that is encoded by one call
PIECE = 65_536  # characters over which a text is split


def _bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8"))


def groups(texts: list[str], most: int = GROUP_BYTES, piece: int = PIECE) -> Iterator[tuple[list[int], list[str]]]:
    """(row numbers, pieces) of at most about ``most`` bytes each: long texts are split at safe boundaries, short ones share a group."""
    rows, pieces, size = [], [], 0
    for i, t in enumerate(texts):
        for p in slices(t, piece):
            n = _bytes(p)
            if pieces and size + n > most:
                yield rows, pieces
                rows, pieces, size = [], [], 0
            rows.append(i)
            pieces.append(p)
            size += n
    if pieces:
        yield rows, pieces


def batch_lengths(enc, pieces: list[str]) -> np.ndarray:
    """Numbers of ids of the pieces, from one call of the encoder.

    Pieces are joined by the vocabulary's special string. The encoder cuts at special strings
    first, so each piece is encoded as if alone, and the special ids between pieces tell the
    lengths apart; strings of that kind inside pieces are counted to find those between them.
    A vocabulary without exactly one special string takes the library's own batch call.
    """
    if len(enc.special_tokens_set) != 1:
        return np.array([len(x) for x in enc.encode_batch(pieces, num_threads=1, allowed_special="all")], np.int64)
    (mark,) = enc.special_tokens_set
    out = np.zeros(len(pieces), np.int64)
    long = [k for k, p in enumerate(pieces) if len(p) > PLAIN]  # no boundary in over PLAIN characters
    out[long] = [len(encode_part(enc, pieces[k])) for k in long]
    short = np.setdiff1d(np.arange(len(pieces)), long)
    if len(short):
        own = np.array([pieces[k].count(mark) for k in short])
        ids = enc.encode_to_numpy(mark.join(pieces[k] for k in short), allowed_special="all")
        marks = np.flatnonzero(ids == enc.encode_single_token(mark))
        between = marks[np.cumsum(own)[:-1] + np.arange(len(short) - 1)]
        out[short] = np.diff(np.concatenate([[-1], between, [len(ids)]])) - 1
    return out


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, without a shuffle.

    Arrow batches are cut by bytes; of a slice, the pieces of all texts are dealt into groups of
    about equal bytes, and each group is encoded by one call. Only lengths leave the worker.
    Null text counts as empty: 0 bytes, 0 tokens. A null id stays null; repeated rows give
    repeated results; other columns are ignored; an empty table gives an empty result.
    """
    path = path or tokenizer_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(path)
        for whole in batches:
            for b in by_bytes(whole, 1):
                n = np.zeros(b.num_rows, np.int64)
                for rows, pieces in groups(b.column(1).to_pylist()):
                    np.add.at(n, rows, batch_lengths(enc, pieces))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
