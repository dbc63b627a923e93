"""Near copies: components of texts whose five-word shingle sets have a Jaccard similarity of at least ``threshold``.

SimHash finds candidates, by bit-sliced comparison inside buckets; the sets themselves decide.
A similarity of 0.8 puts fingerprints of 64 bits about 10 bits apart, too many for block
tables over the bits. Buckets are therefore keyed by bands of shingle minima.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.plans.graph import connected_components
from tidewheel.plans.storage import discard, materialize

from .batches import by_bytes
from .bitslice import block_hits, pack, planes, unpack
from .near_dups import _out, forests, in_buckets, runs

SEED, WIDTH, THRESHOLD = 42, 5, 0.8
BANDS, ROWS = 24, 5  # a similarity of 0.8 shares a band with probability 0.9999
RADIUS = 18  # bits; at 0.8, fingerprints differ in 9.7 on average, with a standard deviation of 2.9
SPLIT = 512  # rows of an area from which it is dealt to more tasks than its size alone asks for, by the square root
TILE, TILE_BYTES = 4096, 16_000_000  # rows of a bucket, or rows and bytes of an area, that one task takes at a time, twice
_MULTIPLIERS = np.random.default_rng(20240517).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run, a text without words has none."""
    from xxhash import xxh64_intdigest as h

    words = text.encode("utf-8").lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: max(0, len(words) - width)]]
    return np.unique(np.array([h(joined[a : b - 1], SEED) for a, b in zip(starts, ends[min(width, len(words)) - 1 :], strict=True)], np.uint64))


def simhash_of(s: np.ndarray) -> int:
    """The fingerprint of a shingle set: bit i is set if over half of the hashes have it."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(s), 4096):
        ones += np.unpackbits(s[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(s), bitorder="little").view("<i8")[0])


def bands(s: np.ndarray) -> np.ndarray:
    """One key a band: the mixed minima of ROWS multiplicative hashes of the set."""
    least = np.full(len(_MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        least = np.minimum(least, (_MULTIPLIERS[:, None] * s[None, at : at + 4096]).min(axis=1))
    key = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * _MIX
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, th, size, node, fp, bands) of every row: a digest of the text, its bytes, the identity of its shingle set, the set's fingerprint and band keys."""
    from xxhash import xxh3_128_digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_bytes(whole, 3):
                made = [(xxh3_128_digest(s.tobytes()), simhash_of(s), bands(s) if len(s) else []) for s in (shingles(t.as_py(), width) for t in b.column(3))]
                keys, fps, lists = (pa.array(x, kind) for x, kind in zip(zip(*made, strict=True), (pa.binary(), pa.int64(), pa.list_(pa.int64())), strict=True))
                yield pa.RecordBatch.from_arrays([*b.columns[:3], keys, fps, lists], names=["id", "th", "size", "node", "fp", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), digest(text_col).alias("th"), F.octet_length(text).cast("long").alias("size"), text.alias("t"))
    return rows.mapInArrow(run, f"id {kind}, th binary, size long, node binary, fp long, bands array<long>")


def digest(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def areas(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, component): classes (node, fp, bands) that fingerprints within the radius connect inside the buckets of bands."""
    rows = classes.select(F.posexplode("bands").alias("tab", "key"), "fp", "node")
    return connected_components(in_buckets(rows, TILE).mapInArrow(lambda it: forests(it, radius, True), "src binary, dst binary"))


def similar_forest(sets: list[np.ndarray], fps: np.ndarray, side: np.ndarray, threshold: float, radius: int) -> tuple[list[int], list[int]]:
    """Links that connect all sets (of side 0 or 1) whose similarity is at least ``threshold`` and whose fingerprints are within the radius.

    Only pairs of both sides count, if there are two. Fingerprints of 64 rows at a time are held
    against all; of what is within the radius, and not connected yet, the sets are intersected.
    """
    n = len(sets)
    size = np.array([len(x) for x in sets])
    label, p = np.arange(n), planes(fps)
    lanes = [pack(side == k) for k in (0, 1)]
    ask_from = np.flatnonzero(side == 0)
    two = len(ask_from) < n
    a, b = [], []
    for at in range(0, len(ask_from), 64):
        ask = ask_from[at : at + 64]
        hits = unpack(block_hits(fps[ask], p, lanes[1] if two else lanes[0], radius)).reshape(len(ask), -1)[:, :n]
        for i, row in zip(ask, hits, strict=True):
            y = np.flatnonzero(row & (label != label[i]))
            y = y[(np.minimum(size[y], size[i]) >= threshold * np.maximum(size[y], size[i]) - 1e-9) & (two | (y > i))]
            if not len(y):
                continue
            both = np.concatenate([sets[k] for k in y])
            found = sets[i][np.searchsorted(sets[i], both).clip(max=size[i] - 1)] == both
            shared = np.add.reduceat(found, np.concatenate([[0], np.cumsum(size[y])[:-1]]))
            for k in y[shared >= threshold * (size[y] + size[i] - shared) - 1e-9]:
                if label[k] != label[i]:
                    label[label == label[k]] = label[i]
                    a.append(int(i))
                    b.append(int(k))
    return a, b


def _verified(batches: Iterator[pa.RecordBatch], width: int, threshold: float, radius: int) -> Iterator[pa.RecordBatch]:
    """Links inside the runs of sorted rows (key, i, j, own, fp, node, t)."""
    for table, run in runs(batches, 3, 4096):
        fps, own, low, high = (table.column(c).to_numpy() for c in ("fp", "own", "i", "j"))
        start = np.flatnonzero(np.diff(run, prepend=-1))
        for at, end in zip(start, [*start[1:], len(run)], strict=True):
            if end - at > 1:
                sets = [shingles(t.as_py(), width) for t in table.column("t").slice(at, end - at)]
                side = (own[at:end] != low[at:end]) & (low[at:end] != high[at:end])
                a, b = similar_forest(sets, fps[at:end].view(np.uint64), side, threshold, radius)
                yield from _out(table, at + np.array(a, np.int64), at + np.array(b, np.int64))


def similar_links(classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """Edges (src, dst) that connect all ``classes`` (node, fp, bands, size, at: id and th) whose sets are at least ``threshold`` similar.

    First, cheap sketches alone divide the classes into areas that fingerprints connect. Only
    texts of areas of two or more move, to the task of their area, where fingerprints choose
    which sets are intersected and connected pairs are passed over. Areas of many rows or
    bytes are dealt into tiles, each pair of tiles a group of its own, so a task holds two
    tiles at most and no pair of an area stays unseen. Out comes a spanning forest.
    """
    found = areas(classes, radius)
    inside = materialize(found.join(classes.drop("bands"), "node").withColumn("key", F.xxhash64("component")).drop("component"), "areas")  # areas of equal keys are only compared more
    n = F.count(F.lit(1))
    tiles = F.ceil(F.greatest(F.when(n > SPLIT, F.sqrt(n / 64)).otherwise(1), n / TILE, F.sum("size") / TILE_BYTES)).cast("int")
    sizes = inside.groupBy("key").agg(tiles.alias("tiles")).where("tiles > 1")
    dealt = inside.join(sizes, "key", "left").withColumn("own", F.when(F.col("tiles").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), F.col("tiles"))).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1))))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp", "node", "at")
    texts = docs.select(F.col(id_col).alias("id"), digest(text_col).alias("th"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    held = dealt.join(texts, F.col("at.id").eqNullSafe(F.col("id")) & (F.col("at.th") == F.col("th")))
    keys = ["key", "i", "j"]
    held = held.select(*keys, "own", "fp", "node", "t").repartition(*keys).sortWithinPartitions(*keys)
    return held.mapInArrow(lambda it: _verified(it, width, threshold, radius), "src binary, dst binary")


def keep_one(docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near copies: of each component of similar texts the row with the smallest id stays.

    Rows are judged by their own text, also where an id repeats: different texts of one id
    both stay, and one of rows that repeat an id and a text does. Ties of an id go to the
    least digest of the text. Null ids come last, and of a component of null ids one row stays.
    Texts without words are copies of each other. Columns stay; an empty table gives an empty
    result. Only sketches and candidates' texts are compared; the other texts move at most
    once, for the final join.
    """
    own = "_" * (1 + max(map(len, docs.columns)))  # longer than any column, so no name clashes
    th, lost_id, lost_th = own + "th", own + "lost_id", own + "lost_th"
    rows = materialize(sketches(docs, id_col, text_col, width), "sketches")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    classes = materialize(rows.groupBy("node").agg(F.min(first).alias("at"), *(F.first(c).alias(c) for c in ("fp", "bands", "size"))), "classes")
    links = materialize(similar_links(classes, docs, id_col, text_col, width, threshold), "links")
    comps = connected_components(links)
    named = classes.select("node", "at").join(comps, "node", "left").groupBy(F.coalesce("component", "node").alias("c")).agg(F.min("at").alias("at"))
    copies = materialize(rows.groupBy("id", "th").agg(F.count(F.lit(1)).alias("n")), "copies")
    stay = named.select(F.col("at.id").alias("stay_id"), F.col("at.th").alias("stay_th"))
    same = F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("th") == F.col("stay_th"))
    lost = materialize(copies.join(stay, same, "left_anti").select(F.col("id").alias(lost_id), F.col("th").alias(lost_th)), "lost")
    more = materialize(copies.where("n > 1").join(stay, same, "left_semi").select(F.col("id").alias(lost_id), F.col("th").alias(lost_th)), "repeated")
    discard(rows, classes, links, copies)
    match = F.col(id_col).eqNullSafe(F.col(lost_id)) & (F.col(th) == F.col(lost_th))
    kept = docs.withColumn(th, digest(text_col)).join(lost, match, "left_anti")
    if not more.isEmpty():
        kept = kept.join(more, match, "left_anti").unionByName(kept.join(more, match, "left_semi").dropDuplicates([id_col, th]))
    return kept.select(*docs.columns)
