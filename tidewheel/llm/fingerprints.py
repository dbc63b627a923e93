"""SimHash document fingerprints and their neighbours. DataFrame operations only."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.plans.ordering import positions
from tidewheel.plans.skew import dealt_join
from tidewheel.plans.storage import materialize

BITS = 64
RADIUS, BLOCKS = 3, 5
TILE = 1024  # fingerprints of a bucket that one row holds, twice
LONGEST = 16  # a term's weight is its squared length, up to this length


def votes(terms: DataFrame, keys: list[str], term: str = "term") -> DataFrame:
    """One row a key: ``fp`` (long), the signed bits of weighted term hashes. Keys without terms vote nothing: 0.

    A term's hash votes +weight on the bits it has and -weight on the others; a bit of the
    fingerprint is set where the sum is positive. Rows of a key are summed before they move.
    """
    w = F.pow(F.least(F.length(term), F.lit(LONGEST)), F.lit(2)).cast("long")
    t = terms.select(*keys, F.xxhash64(term).alias("h"), F.when(F.length(term) > 0, w).otherwise(0).alias("w"))
    bit = lambda i: F.sum((F.shiftright("h", i).bitwiseAND(1) * 2 - 1) * F.col("w")).alias(f"b{i}")
    sums = t.groupBy(*keys).agg(*(bit(i) for i in range(BITS)))
    fp = F.lit(0).cast("long")
    for i in range(BITS):
        fp = fp.bitwiseOR(F.when(F.col(f"b{i}") > 0, F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("fp"))


def terms_of(text: Column) -> Column:
    return F.split(F.lower(text), r"\s+")


def hex16(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Cosine that the share of equal bits estimates, not below 0; 1 for equal fingerprints."""
    d = F.bit_count(a.bitwiseXOR(b))
    return F.greatest(F.lit(0.0), F.cos(d * F.lit(3.141592653589793 / BITS))).cast("double")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each distinct (doc_id, text): 16 hex digits. Null and empty text: all zeros."""
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumn("th", F.xxhash64("t"))
    out = votes(d.select("id", "th", F.explode(terms_of(F.col("t"))).alias("term")), ["id", "th"])
    return out.select(F.col("id").alias(id_col), hex16("fp").alias("fingerprint"))


def _tables(radius: int, blocks: int) -> list[int]:
    """The masks of the block tables: each choice of ``blocks - radius`` of the blocks, on which two fingerprints within the radius agree."""
    if blocks <= radius:
        raise ValueError("more blocks than bits of the radius are needed")
    edge = [round(i * BITS / blocks) for i in range(blocks + 1)]
    mask = [((1 << edge[i + 1]) - (1 << edge[i])) for i in range(blocks)]
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    return [signed(sum(mask[i] for i in t)) for t in combinations(range(blocks), blocks - radius)]


def _keyed(fps: DataFrame, fp: str, masks: list[int]) -> DataFrame:
    """(v, tab, key): every distinct fingerprint in every table."""
    distinct = fps.select(F.col(fp).alias("v")).where("v IS NOT NULL").distinct()
    return distinct.select("v", F.posexplode(F.array(*(F.col("v").bitwiseAND(F.lit(m).cast("long")) for m in masks))).alias("tab", "key"))


def _first_table(x: Column, masks: list[int]) -> Column:
    """The first table in which two fingerprints that differ in the bits x meet."""
    return F.coalesce(*(F.when(x.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(i)) for i, m in enumerate(masks)))


def _met(fps: DataFrame, radius: int, blocks: int, fp: str, tile: int) -> tuple[DataFrame, list[int]]:
    """(bucket, i, j, a, b): the distinct fingerprints of tiles i and j (the same in both if they are one) of each bucket of two or more; and the tables' masks.

    Fingerprints that differ in ``radius`` bits agree on at least ``blocks - radius`` of the
    blocks. Each choice of that many blocks is a table, permuted so that they are its key.
    Buckets over ``tile`` are dealt into tiles, each pair of tiles a row of its own.
    """
    masks = _tables(radius, blocks)
    rows = materialize(_keyed(fps, fp, masks).select("v", F.struct("tab", "key").alias("bucket")), "block-tables")
    counts = materialize(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    met = dealt_join(rows, counts, "bucket", "bucket", counts=counts.select(F.col("bucket").alias("key"), "n"))
    tiles = F.ceil(F.col("n") / tile).cast("int")
    met = met.withColumn("own", F.pmod(F.xxhash64("v"), tiles).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    side = lambda at: F.collect_list(F.when(F.col("own") == F.col(at), F.col("v"))).alias("a" if at == "i" else "b")
    return met.select("bucket", "v", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).groupBy("bucket", "i", "j").agg(side("i"), side("j")), masks


def _close(v: Column, w: Column, radius: int, masks: list[int]) -> Column:
    """Whether two fingerprints of a bucket are within the radius and meet in no earlier table."""
    x = w.bitwiseXOR(v)
    return (w != v) & (F.bit_count(x) <= radius) & (_first_table(x, masks) == F.col("bucket.tab"))


def near_counts(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, fp: str = "fp", tile: int = TILE) -> DataFrame:
    """(v, n) of each distinct fingerprint (long): how many others are at most ``radius`` bits apart; those without any have no row.

    Pairs are only counted, inside the row of a bucket or of two of its tiles, so a large group
    of near fingerprints never becomes a table of its pairs. A pair counts in the first table
    that holds it. Null fingerprints are left out; an empty table gives none.
    """
    groups, masks = _met(fps, radius, blocks, fp, tile)

    def counted(these: str, those: str) -> Column:
        return F.transform(these, lambda v: F.struct(v.alias("v"), F.size(F.filter(those, lambda w: _close(v, w, radius, masks))).alias("n")))

    both = F.concat(counted("a", "b"), F.when(F.col("i") < F.col("j"), counted("b", "a")).otherwise(F.array().cast("array<struct<v:bigint,n:int>>")))
    return groups.select(F.explode(F.filter(both, lambda x: x["n"] > 0)).alias("x")).groupBy("x.v").agg(F.sum("x.n").alias("n"))


def near_pairs(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, fp: str = "fp", tile: int = TILE) -> DataFrame:
    """(a, b, distance), a < b, of all distinct fingerprints (long) at most ``radius`` bits apart, each pair once.

    Compared as in ``near_counts``: only pairs within the radius leave the row of two tiles. A
    group of g near fingerprints has g² such pairs; where only their number matters, count them.
    Null fingerprints are left out; an empty table gives none.
    """
    groups, masks = _met(fps, radius, blocks, fp, tile)

    def near(v: Column) -> Column:
        found = F.filter("b", lambda w: _close(v, w, radius, masks) & ((F.col("i") < F.col("j")) | (v < w)))
        return F.transform(found, lambda w: F.struct(F.least(v, w).alias("a"), F.greatest(v, w).alias("b"), F.bit_count(v.bitwiseXOR(w)).alias("distance")))

    return groups.select(F.explode(F.flatten(F.transform("a", near))).alias("x")).select("x.*")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last quarter replaced by the next document's start.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, near_fingerprints (how many other distinct fingerprints of the table are at
    most RADIUS bits from this one). Documents follow each other by doc_id (null first, then smallest first), then by a
    hash of the text; after the last comes the first. Null text counts as empty. Rows that
    repeat an id and a text are one document, returned once. A lone document is its own next.

    Texts move once, by id (an integer; the smallest long stands for null); only the start that replaces a quarter moves besides. All sums of
    a document are made in the task that holds it.
    """
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    kind, null = docs.schema[id_col].dataType, F.lit(-(1 << 63)).cast("long")
    d = d.select(F.coalesce(F.col("id").cast("long"), null).alias("key"), F.xxhash64("t").alias("th"), "t")
    heads = positions(d.select("key", "th", F.length("t").cast("long").alias("n")).distinct(), "key", "th")
    heads = materialize(heads, "heads")
    total = heads.count()
    step = F.pmod(F.col("pos") + 1, F.lit(max(total, 1)))
    nxt = heads.select(F.col("pos").alias("p"), F.col("key").alias("next_key"), F.col("th").alias("next_th"))
    links = materialize(heads.withColumn("p", step).join(nxt, "p").select("key", "th", "n", "next_key", "next_th"), "links")
    k = lambda n: F.floor(F.col(n) / 4).cast("int")
    prev = links.select(F.col("next_key").alias("key"), F.col("next_th").alias("th"), F.col("key").alias("prev_key"), F.col("th").alias("prev_th"), k("n").alias("lend"))
    plan = links.join(prev, ["key", "th"])
    held = d.join(plan.hint("shuffle_hash"), ["key", "th"])
    starts = held.select(F.col("prev_key").alias("key"), F.col("prev_th").alias("th"), F.substring("t", F.lit(1), F.col("lend")).alias("start")).distinct()
    both = held.join(starts.hint("shuffle_hash"), ["key", "th"])
    edited = F.concat(F.substring("t", F.lit(1), F.col("n").cast("int") - k("n")), F.col("start"))
    both = both.select("key", "th", "n", "t", edited.alias("e"))
    sides = both.select("key", "th", "n", F.unhex(F.sha2("e", 256)).alias("sha"), F.posexplode(F.array("t", "e")).alias("side", "text"))
    fps = votes(sides.select("key", "th", "n", "sha", "side", F.explode(terms_of(F.col("text"))).alias("term")), ["key", "th", "n", "sha", "side"])
    one = fps.groupBy("key", "th", "n", "sha").agg(*(F.max(F.when(F.col("side") == i, F.col("fp"))).alias(c) for i, c in enumerate(("fp", "efp"))))
    one = materialize(one, "fingerprints")
    after = one.select(F.col("key").alias("next_key"), F.col("th").alias("next_th"), F.col("fp").alias("nfp"))
    out = one.join(links.select("key", "th", "next_key", "next_th"), ["key", "th"]).join(after, ["next_key", "next_th"])
    near = near_counts(one.select("fp")).withColumnRenamed("n", "near_fingerprints")
    out = dealt_join(out, near, "fp", "v", "left", counts=one.groupBy(F.col("fp").alias("key")).agg(F.count(F.lit(1)).alias("n")))
    return out.select(
        F.when(F.col("key") != null, F.col("key")).cast(kind).alias(id_col), F.col("n").alias("n_chars"), F.lower(F.hex("sha")).alias("edited_sha256"), hex16("fp").alias("fingerprint"), hex16("efp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("nfp")).alias("near_next"),
        F.coalesce("near_fingerprints", F.lit(0)).cast("long").alias("near_fingerprints"),
    )
