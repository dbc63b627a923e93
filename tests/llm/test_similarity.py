import hashlib
import math
import random

import numpy as np
import pytest
import xxhash

from tidewheel.llm import bitslice, decontaminate, fingerprints, near_dups


def _components(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            m = min(label[i], label[j])
            if label[i] != m or label[j] != m:
                label[i] = label[j] = m
                changed = True
    return label


def test_bit_planes_find_what_plain_distances_find():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    for i in range(300, 900):
        v[i] = v[rng.integers(0, i)]
        for _ in range(rng.integers(0, 5)):
            v[i] ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
    for radius in (0, 1, 3, 4, 7):
        close = np.bitwise_count(v[:, None] ^ v[None, :]) <= radius
        a, b = np.nonzero(close)
        want = bitslice.forest(len(v), a, b)
        got = bitslice.forest_of_block(v, radius)
        assert len(set(zip(want.tolist(), got.tolist(), strict=True))) == len(set(want.tolist())) == len(set(got.tolist()))
        run = np.sort(rng.integers(0, 40, len(v)))
        x, y = bitslice.links_in_short_runs(v, run, radius)
        assert set(zip(x.tolist(), y.tolist(), strict=True)) == {(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if i < j and run[i] == run[j]}


def _plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _corpus():
    rnd = random.Random(5)
    words = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(60)]
    texts = [None, "", " \x0b\n", "one", "two words", "A b C d", "x y z"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.choice([40, 120, 400]))) for _ in range(12)]
    for b in base:
        texts.append(b)
        for _ in range(4):
            w = b.split(" ")
            w[rnd.randrange(len(w))] = "new"
            texts.append(rnd.choice([" ", "\n"]).join(w))
    return [(100 - i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("tile", [4096, 3])
def test_near_duplicates(spark, tile):
    rows = _corpus()
    rows += [rows[9], (None, rows[9][1]), (None, "quite alone here")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    fp = [_plain_fingerprint(t) for _, t in rows]
    label = _components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 4])
    least = {c: min((r[0] for r, k in zip(rows, label, strict=True) if k == c and r[0] is not None), default=None) for c in set(label)}
    want = sorted(((r[0], f"{f:016x}", least[k]) for r, f, k in zip(rows, fp, label, strict=True)), key=str)
    near_dups_tile, near_dups.fingerprint_links.__defaults__ = near_dups.fingerprint_links.__defaults__, (4, tile)
    try:
        got = sorted((tuple(r) for r in near_dups.near_duplicates(docs).collect()), key=str)
    finally:
        near_dups.fingerprint_links.__defaults__ = near_dups_tile
    assert got == want


def test_near_duplicates_of_nothing(spark):
    assert near_dups.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


ITEMS = [(1, "The quick brown fox jumps over the lazy dog, and runs away from all of the hounds."), (2, "short one"), (3, ""), (4, None), (5, "a b c d e f g h i j k l m n o p q r s t"), (5, "another text of item five that has some words")]


def _contains(text, item):
    w, b = decontaminate.words_of(text or ""), decontaminate.words_of(item or "")
    k = min(5, len(b))
    s = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if k else set()
    d = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
    if 0 < k < 5 and w != b:  # a short item is found as a whole text only
        return None
    return (len(s & d), len(s)) if s and len(s & d) >= math.ceil(0.8 * len(s)) else None


def test_decontamination_against_brute_force(spark, monkeypatch):
    rnd = random.Random(1)
    filler = "the of and a fox dog quick b c d e f".split()
    texts = [None, "", "short one", "Short, one!", "a short one more", ITEMS[0][1].upper().replace(",", " ;"), "x " * 5000 + ITEMS[0][1] + " y" * 5000, "a b c d e f g h i j k l m n o p q r s zz", "a b c d e f g h i zz k l m n o p q r s t"]
    texts += [" ".join(rnd.choice(filler) for _ in range(80)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, "short one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", __import__("pyspark").sql.functions.lit("clash"))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted((i, k, *hit) for i, t in rows for k, item in ITEMS if t is not None and (hit := _contains(t, item)))
    for size in (16_000_000, 60):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        assert sorted((r.doc_id, r.item_id, r.shared, r.shingles) for r in decontaminate.contaminated(docs, bench).collect()) == want
        left = decontaminate.decontaminate(docs, bench)
        assert left.columns == docs.columns
        assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _ in rows if i not in {w[0] for w in want})
    assert {2, 3} <= {w[0] for w in want if w[1] == 2} and 4 not in {w[0] for w in want}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def _votes(text):
    sums = [0] * 64
    for w in __import__("re").split(r"\s+", text.lower(), flags=__import__("re").ASCII):
        h = xxhash.xxh64_intdigest(w.encode(), 42)
        for b in range(64):
            sums[b] += (1 if h >> b & 1 else -1) * (min(len(w), 16) ** 2)
    return sum(1 << b for b in range(64) if sums[b] > 0)


def test_edited_fingerprints(spark):
    rows = [(3, "Some words of a text that goes on"), (1, "first text é ü with more words in it"), (9, None), (7, "tiny"), (8, "x y z " * 300), (12, "first text é ü with more words in it")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_chars int")
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    order = sorted((i, t or "") for i, t in rows)
    like = lambda a, b: max(0.0, math.cos((a ^ b).bit_count() * math.pi / 64))
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[:cut]
        a, e, n = _votes(t), _votes(edited), _votes(nxt)
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}", f"{e:016x}")
        assert r.near_edited == pytest.approx(like(a, e)) and r.near_next == pytest.approx(like(a, n))
    assert got[1].fingerprint == got[12].fingerprint
    every = {int(r.fingerprint, 16) for r in got.values()}
    assert all(r.near_fingerprints == sum(0 < (int(r.fingerprint, 16) ^ f).bit_count() <= 3 for f in every) for r in got.values())
    assert fingerprints.edited_fingerprints(docs.limit(0)).count() == 0
    twice = docs.union(docs)
    assert fingerprints.edited_fingerprints(twice).count() == len(rows)
    assert {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs).collect()} == {i: got[i].fingerprint for i in got}


def test_block_tables_find_every_pair(spark):
    rng = np.random.default_rng(4)
    v = rng.integers(0, 1 << 64, 200, dtype=np.uint64)
    v[100:] = v[:100]
    for i in range(100, 200):
        for _ in range(i % 6):
            v[i] ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
    fps = spark.createDataFrame([(int(x),) for x in v.view(np.int64)] + [(None,)], "fp long")
    u = np.unique(v.view(np.int64))
    for radius, blocks in ((3, 5), (2, 4), (0, 1)):
        want = sorted((int(a), int(b), int(d)) for i, a in enumerate(u) for b in u[i + 1 :] if (d := int(np.bitwise_count((a ^ b).view(np.uint64)))) <= radius)
        for tile in (1024, 5):
            assert sorted(tuple(r) for r in fingerprints.near_pairs(fps, radius, blocks, tile=tile).collect()) == want
        around = {int(a): n for a in u if (n := sum(int(a) in p[:2] for p in want))}
        for tile in (1024, 5):
            assert {r.v: r.n for r in fingerprints.near_counts(fps, radius, blocks, tile=tile).collect()} == around
    with pytest.raises(ValueError):
        fingerprints.near_pairs(fps, 3, 3)
    group = spark.createDataFrame([(1 << i | 1 << j,) for i in range(30) for j in range(i)], "fp long")  # one bucket of 435 in most tables
    all_of = [1 << i | 1 << j for i in range(30) for j in range(i)]
    assert {r.v: r.n for r in fingerprints.near_counts(group, tile=50).collect()} == {v: sum(0 < (v ^ w).bit_count() <= 3 for w in all_of) for v in all_of}
    assert fingerprints.near_counts(group.limit(0)).count() == 0


def test_fingerprints_of_null_ids(spark):
    rows = [(None, "words without an id"), (4, "four words are here"), (None, None), (None, "words without an id")]
    got = [(r.doc_id, r.n_chars, r.fingerprint) for r in fingerprints.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = [(i, len(t or ""), f"{_votes(t or ''):016x}") for i, t in rows[:3]]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_hash_that_many_documents_hold(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1)
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(i, f"start {i} {item} end") for i in range(300)] + [(999, "nothing of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "one two three four five other words that are nowhere")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()) == [(i, 7) for i in range(300)]
    assert [r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()] == [999]
