"""SimHash near-duplicates: exact components of fingerprints at most ``radius`` bits apart."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewheel.plans.graph import connected_components
from tidewheel.plans.skew import dealt_join
from tidewheel.plans.storage import materialize

from .bitslice import forest, links_in_short_runs, spanning, tree_of_block

SEED, SHINGLE, RADIUS = 42, 4, 4
SHORT = 64  # longest run that is compared by shifts
TILE = 4096  # rows of a bucket that one task takes at a time


def simhash(texts: list[str], width: int = SHINGLE) -> np.ndarray:
    """Fingerprints: bit i is set if over half of the shingle hashes have it. No words: 0."""
    from xxhash import xxh64_intdigest as h

    out = np.zeros(len(texts), np.uint64)
    for i, t in enumerate(texts):
        words = t.encode("utf-8").lower().split()  # ASCII letters and ASCII white space only
        if not words:
            continue
        joined = b" ".join(words)
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[: max(0, len(words) - width)]]
        hashes = np.array([h(joined[a : b - 1], SEED) for a, b in zip(starts, ends[min(width, len(words)) - 1 :], strict=True)], "<u8")
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 4096):
            ones += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(id, fp long) of every row. Null text has no words: fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(simhash(b.column(1).to_pylist(), width).view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInArrow(run, "id long, fp long")


def runs(batches: Iterator[pa.RecordBatch], keys: int, rows: int = 65_536) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in pieces that end with a run of equal keys (the first ``keys`` columns), and the number of each row's run in its piece."""

    def numbered(t: pa.Table) -> np.ndarray:
        new = np.ones(t.num_rows, bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in (t.column(i).to_numpy() for i in range(keys))])
        return np.cumsum(new) - 1

    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        run = numbered(t)
        cut = int(np.searchsorted(run, run[-1]))
        if cut:
            yield t.slice(0, cut), run[:cut]
        held = t.slice(cut).to_batches()
        n = t.num_rows - cut
        rows = max(65_536, 2 * n)
    if n:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, numbered(t)


def _out(t: pa.Table, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    node = t.column("node").combine_chunks()
    node = node.chunk(0) if isinstance(node, pa.ChunkedArray) else node
    yield pa.RecordBatch.from_arrays([node.take(pa.array(a)), node.take(pa.array(b))], names=["src", "dst"])


def forests(batches: Iterator[pa.RecordBatch], radius: int, roots: bool) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the buckets in sorted rows (tab, key, i, j, fp, node): links of every row to its component's least row, or to a row within the radius."""
    for t, run in runs(batches, 4):
        v = t.column("fp").to_numpy().view(np.uint64)
        size = np.bincount(run)
        to = np.arange(len(v))
        few = np.flatnonzero((size[run] > 1) & (size[run] <= SHORT))
        left = right = np.zeros(0, np.int64)
        if len(few):
            a, b = links_in_short_runs(v[few], run[few], radius)
            if roots:
                to[few] = few[forest(len(few), a, b)]
            else:
                some = spanning(len(few), a, b)
                left, right = few[b[some]], few[a[some]]
        at = np.searchsorted(run, np.arange(len(size)))
        for r in np.flatnonzero(size > SHORT):
            label, parent = tree_of_block(v[at[r] : at[r] + size[r]], radius)
            to[at[r] : at[r] + size[r]] = at[r] + (label if roots else parent)
        moved = np.flatnonzero(to != np.arange(len(v)))
        yield from _out(t, np.concatenate([moved, left]), np.concatenate([to[moved], right]))


def in_buckets(rows: DataFrame, tile: int) -> DataFrame:
    """Rows (tab, key, fp, node, ...) with (i, j), dealt and sorted by (tab, key, i, j).

    Buckets over ``tile`` rows are dealt into tiles by a hash of the fingerprint, and each pair of
    tiles is a group of its own, so a task never holds over about two tiles, and no pair of
    rows is lost.
    """
    rest = rows.columns[2:]
    hot = rows.groupBy("tab", "key").count().where(F.col("count") > tile).select("tab", "key", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    dealt = rows.join(hot, ["tab", "key"], "left").withColumn("own", F.when(F.col("tiles").isNull(), 0).otherwise(F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles"))).cast("int"))
    others = F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1))
    dealt = dealt.select("tab", "key", "own", F.explode(others).alias("other"), *rest)
    dealt = dealt.select("tab", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *rest)
    keys = ["tab", "key", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "node")


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (src, dst) that connect the nodes (columns node, fp; a fingerprint each) at most radius bits apart.

    Two fingerprints within the radius agree on 2 of radius + 2 blocks of bits. Every pair of
    blocks is a table; its buckets hold the fingerprints that agree there. Out of a bucket, or a
    pair of its tiles, comes a spanning forest of its links, never all pairs.
    """
    blocks = radius + 2
    edge = [round(i * 64 / blocks) for i in range(blocks + 1)]
    bits = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(blocks)]
    masks = [m - (1 << 64) if (m := bits[i] | bits[j]) >> 63 else m for i, j in combinations(range(blocks), 2)]
    rows = fps.select(F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks))).alias("tab", "key"), "fp", "node")
    kind = fps.schema["node"].dataType.simpleString()
    return in_buckets(rows, tile).mapInArrow(lambda it: forests(it, radius, True), f"src {kind}, dst {kind}")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    component_id is the smallest id that links reach, the row's own included. Fingerprints,
    not documents, are compared: copies are one node, named by its least id, so the least node
    of a component names the component. Null ids never are the smallest (they count as the
    greatest long); a component of null ids only has a null component_id. Repeated rows repeat
    in the result; texts without words have fingerprint 0; an empty table gives an empty result.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, width), "simhash")
    last = F.lit((1 << 63) - 1).cast("long")
    sums = fps.groupBy("fp").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    classes = materialize(sums.select("fp", F.struct(F.coalesce("id", last).alias("id"), "fp").alias("node"), "n"), "classes")
    comps = connected_components(fingerprint_links(classes.select("fp", "node"), radius))
    linked = comps.select(F.col("node.fp").alias("linked"), F.col("component.id").alias("first"))
    named = classes.join(linked, F.col("fp") == F.col("linked"), "left").select(F.col("fp").alias("class_fp"), F.nullif(F.coalesce("first", "node.id"), last).alias("component_id"))
    out = dealt_join(fps, named, "fp", "class_fp", counts=classes.select(F.col("fp").alias("key"), "n"))
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
