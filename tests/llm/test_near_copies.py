import random

from tidewheel.llm import near_copies


def _set(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _kept(rows):
    sets = [_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    return {c: next(i for i in order if label[i] == c) for c in label}, label


def test_near_copies_against_brute_force(spark):
    rnd = random.Random(3)
    line = "this line is common to a great many of these texts and says nothing"
    base = [" ".join(f"w{rnd.randrange(9000)}" for _ in range(rnd.choice([6, 30, 100, 300]))) for _ in range(30)]
    texts = [None, "", " \n", "one", "One", "a b c d", "a b c d e"] + base
    for b in base:
        for _ in range(6):
            w = b.split()
            for _ in range(rnd.randrange(1, 5)):
                w[rnd.randrange(len(w))] = f"n{rnd.randrange(9000)}"
            texts.append(" ".join(w) + (" " + line if rnd.random() < 0.5 else ""))
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    rows += [(1000, "alone " + base[0][::-1]), (1000, base[2]), (None, "null id " + line), (None, "null id " + line), rows[40]]
    want, label = _kept(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, __key string")
    out = near_copies.keep_one(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((rows[i][0] is None, rows[i][0] or 0) for i in want.values())
    assert len(set(label)) < len(rows) - 30
    assert near_copies.keep_one(docs.limit(0)).count() == 0


def test_pipeline_stage_drops_what_fingerprints_miss(spark):
    import corpus_pipeline
    from tidewheel.llm import near_dups

    words = [f"word{i}" for i in range(200)]
    near = ["other" if i % 50 == 20 else w for i, w in enumerate(words)]
    fps = near_dups.simhash([" ".join(words), " ".join(near)])
    assert int(fps[0] ^ fps[1]).bit_count() > near_dups.RADIUS
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near))], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near_dup_stage(spark, docs, "").collect()] == [1]


def test_areas_in_tiles_against_brute_force(spark, monkeypatch):
    rnd = random.Random(6)
    rows = []
    for g in range(3):
        w = [f"g{g}w{i}" for i in range(60)]
        for _ in range(40):  # similarities on both sides of the threshold, linked in chains
            w = list(w)
            w[rnd.randrange(60)] = f"n{rnd.randrange(9999)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(i + 1000, t) for i, t in rows[:30]]
    want, _ = _kept(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for tile, size, split in ((4096, 16_000_000, 512), (7, 16_000_000, 512), (4096, 3000, 512), (4096, 16_000_000, 20)):
        monkeypatch.setattr(near_copies, "TILE", tile)
        monkeypatch.setattr(near_copies, "TILE_BYTES", size)
        monkeypatch.setattr(near_copies, "SPLIT", split)
        assert sorted(r.doc_id for r in near_copies.keep_one(docs).collect()) == sorted(rows[i][0] for i in want.values())


def test_equal_ids_of_different_texts_stay(spark):
    rows = [(1, "first words of a text alone"), (1, "quite another text under one id"), (2, "first words of a text alone"), (1, "quite another text under one id")]
    got = sorted(tuple(r) for r in near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(rows[:2])
