"""Benchmark decontamination: short items found inside documents of any length."""

from __future__ import annotations

import functools
import math
import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.plans.skew import dealt_join
from tidewheel.plans.storage import materialize

from .batches import by_bytes

WIDTH, THRESHOLD = 5, 0.8
BLOCK_BYTES = 16_000_000  # benchmark text up to which every task gets the whole index
_SPACED = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Lower-cased words; ASCII characters other than letters and digits separate them."""
    return text.lower().encode("utf-8").translate(_SPACED).split()


def _mix(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` word numbers; equal runs have equal hashes."""
    n = len(ids) - width + 1
    h = np.zeros(max(n, 0), np.uint64)
    for j in range(width):
        h = (h ^ ids[j : j + n].astype(np.uint64)) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


class Index:
    """Bottom-k MinHash sketches of the items, in partitions by shingle width and size class.

    An item of m distinct shingles that is contained to THRESHOLD misses at most
    m - ceil(THRESHOLD * m) of them, so of its k = m - ceil(THRESHOLD * m) + 1 shingles of
    least hash the document has one at least: probing a document's shingles for the
    sketches finds every such item. What is found is then verified shingle by shingle.
    Partitions whose smallest item needs more shingles than the document has are passed over.
    An item of fewer words than a shingle is found only in a document that has no other words.
    """

    def __init__(self, items: list[tuple[int, str]], width: int = WIDTH, threshold: float = THRESHOLD):
        self.width, self.threshold = width, threshold
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int, set[tuple[int, ...]], int]] = []
        parts: dict[tuple[int, int], dict[int, list[int]]] = {}
        least: dict[tuple[int, int], int] = {}
        for item_id, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text or "")], np.int64)
            w = min(width, len(ids))
            if not w:
                continue
            shingles = {tuple(ids[i : i + w].tolist()) for i in range(len(ids) - w + 1)}
            need = math.ceil(threshold * len(shingles) - 1e-9)
            hashes = sorted({int(x) for x in _mix(ids, w)})
            at = (w, len(shingles).bit_length())
            least[at] = min(least.get(at, need), need)
            for x in hashes[: len(shingles) - need + 1]:
                parts.setdefault(at, {}).setdefault(x, []).append(len(self.items))
            self.items.append((item_id, shingles, w))
        self.parts = [(w, least[w, c], np.array(sorted(p), np.uint64), p) for (w, c), p in sorted(parts.items())]

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, shared shingles, shingles of the item) of every item that the text contains."""
        words = words_of(text)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
        known = ids > 0
        out, runs = [], {}
        for w, need, sketch, members in self.parts:
            if len(ids) - w + 1 < need or w < self.width and len(ids) != w:
                continue
            if w not in runs:
                full = np.ones(len(ids) - w + 1, bool)
                for j in range(w):
                    full &= known[j : len(ids) - w + 1 + j]
                starts = np.flatnonzero(full)
                runs[w] = (starts, _mix_at(ids, starts, w), {})
            starts, hashes, cache = runs[w]
            if len(starts) < need:
                continue
            found = sketch[np.searchsorted(sketch, hashes).clip(max=len(sketch) - 1)] == hashes
            if not found.any():
                continue
            if "set" not in cache:
                cache["set"] = {tuple(ids[i : i + w].tolist()) for i in starts}
            for k in sorted({i for x in set(hashes[found].tolist()) for i in members[x]}):
                item_id, shingles, _ = self.items[k]
                shared = len(shingles & cache["set"])
                if shared >= math.ceil(self.threshold * len(shingles) - 1e-9):
                    out.append((item_id, shared, len(shingles)))
        return out


def _mix_at(ids: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    h = np.zeros(len(starts), np.uint64)
    for j in range(width):
        h = (h ^ ids[starts + j].astype(np.uint64)) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


@functools.lru_cache(maxsize=2)
def _loaded(data: bytes, width: int, threshold: float) -> Index:
    return Index(pickle.loads(data), width, threshold)


def _shingles(words: list[bytes], width: int) -> set[bytes]:
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def sketch(text: str, width: int = WIDTH, threshold: float = THRESHOLD) -> tuple[int, list[int]]:
    """(shingle width, bottom-k hashes) of an item; k as in ``Index``. An item without words has width 0."""
    from xxhash import xxh64_intdigest as h

    words = words_of(text)
    w = min(width, len(words))
    s = _shingles(words, w) if w else set()
    return w, sorted({h(x, w) for x in s})[: len(s) - math.ceil(threshold * len(s) - 1e-9) + 1] if w else []


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(item_col).cast("long").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))


def small_index(items: DataFrame) -> bytes | None:
    """The benchmark for every task, if its measured size is at most BLOCK_BYTES; else None."""
    total = items.agg(F.sum(F.octet_length("t") + 16).alias("b")).first().b or 0
    return pickle.dumps([(r.i, r.t) for r in items.collect()]) if total <= BLOCK_BYTES else None


def joined_hits(texts: DataFrame, items: DataFrame, width: int, threshold: float) -> DataFrame:
    """(th, i, shared, shingles) for distinct texts (th, t) and items (i, t) of a benchmark of any size.

    Executors make the items' sketches and the documents' shingle hashes, of the widths that
    sketches have (at most ``width`` many); a join of the hashes finds every candidate, as in
    ``Index``, and exact shingle sets decide. A hash that very many documents hold is dealt.
    """
    wanted = materialize(items.select(F.unhex(F.md5(F.col("t").cast("binary"))).alias("ith"), "t").distinct(), "items")

    def item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(key, w, hash_) for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for w, hs in [sketch(t, width, threshold)] for hash_ in hs]
            k, w, h = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), pa.array(w, pa.int32()), pa.array(np.array(h, np.uint64).view(np.int64))], names=["ith", "w", "h"])

    sketches = materialize(wanted.mapInArrow(item_rows, "ith binary, w int, h long"), "item-sketches")
    widths = sorted(r.w for r in sketches.select("w").distinct().collect())

    def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as h

        for b in batches:
            for key, t in zip(b.column(0), b.column(1), strict=True):
                words = words_of(t.as_py())
                found = np.array(sorted({h(x, w) for w in widths if w == width or len(words) == w for x in _shingles(words, w)}), np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(found), pa.binary()), pa.array(found)], names=["th", "h"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, item in zip(b.column(2), b.column(3), strict=True):
                words, of = words_of(item.as_py()), words_of(t.as_py())
                w = min(width, len(words))
                s = _shingles(words, w)
                shared = len(s & _shingles(of, w))
                out.append((shared, len(s), shared >= math.ceil(threshold * len(s) - 1e-9) and (w == width or len(of) == w)))
            shared, n, keep = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shared, pa.int64()), pa.array(n, pa.int64())], names=["th", "ith", "shared", "shingles"]).filter(pa.array(keep, pa.bool_()))

    by_hash = sketches.groupBy("h").agg(F.collect_set("ith").alias("iths"))
    pairs = dealt_join(texts.mapInArrow(text_rows, "th binary, h long"), by_hash, "h", "h").select("th", F.explode("iths").alias("ith")).distinct()
    both = pairs.join(texts, "th").join(wanted.select("ith", F.col("t").alias("item")), "ith").select("th", "ith", "t", "item")
    found = both.mapInArrow(verify, "th binary, ith binary, shared long, shingles long")
    return found.join(items.select("i", F.unhex(F.md5(F.col("t").cast("binary"))).alias("ith")), "ith").select("th", "i", "shared", "shingles")


def _digest(text_col: str) -> Column:
    return F.unhex(F.md5(F.col(text_col).cast("binary")))


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, shared, shingles, containment) for each document and each item that it contains.

    An item is contained if the document has at least ``threshold`` of its distinct shingles of
    ``width`` words. An item of fewer words says too little to stand for a leak inside other text: it
    is contained in a document of the same words and no others; one without words is never
    contained. Clean documents have no row. Null texts contain nothing; null ids and repeated
    rows give their rows like others; either table may be empty. A benchmark of at most
    BLOCK_BYTES goes to every task; a larger one is joined, and never meets the driver.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    items = _items(benchmark, "item_id", "text")
    data = small_index(items)
    if data is not None:
        out = rows.mapInArrow(_finder(docs, data, width, threshold), f"id {kind}, item_id long, shared long, shingles long")
    else:
        rows = rows.withColumn("th", _digest("t"))
        texts = materialize(rows.select("th", "t").dropDuplicates(["th"]), "texts")
        hits = joined_hits(texts, items, width, threshold).withColumnRenamed("i", "item_id")
        out = rows.select("id", "th").join(hits, "th")
    return out.select(F.col("id").alias(id_col), "item_id", "shared", "shingles", (F.col("shared") / F.col("shingles")).alias("containment"))


def _finder(docs: DataFrame, data: bytes, width: int, threshold: float):
    sent = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _loaded(sent.value, width, threshold)
        for b in batches:
            found = [(i, *hit) for i, t in enumerate(b.column(1)) for hit in index.find(t.as_py())]
            at, *cols = zip(*found, strict=True) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in cols)], names=["id", "item_id", "shared", "shingles"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """docs without the rows that contain an item. Columns and null texts stay; nothing is shuffled, unless the benchmark is over BLOCK_BYTES."""
    items = _items(benchmark, "item_id", "text")
    data = small_index(items)
    if data is None:
        own = "_" * (1 + max(map(len, docs.columns)))  # longer than any column, so no name clashes
        texts = docs.where(F.col(text_col).isNotNull()).select(_digest(text_col).alias("th"), F.col(text_col).alias("t")).dropDuplicates(["th"])
        hit = joined_hits(materialize(texts, "texts"), items, width, threshold).select(F.col("th").alias(own)).distinct()
        return docs.join(hit, _digest(text_col) == F.col(own), "left_anti")
    sent = docs.sparkSession.sparkContext.broadcast(data)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _loaded(sent.value, width, threshold)
        for whole in batches:
            for b in by_bytes(whole, at):
                yield b.filter(pa.array([not index.find(t.as_py() or "") for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
