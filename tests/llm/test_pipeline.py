import corpus_pipeline
from tidewheel.llm import chunk_bpe, decontaminate, quality, secrets


def _shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages_follow_each_other(spark, tmp_path):
    src = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{src}/documents.parquet")
    docs, seen = rows, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, src)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.schema.names == rows.schema.names
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and rows.count() > seen[0] and seen[2] == seen[3] == seen[4]
    got = corpus_pipeline.run(spark, src)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in docs.collect())

    # the same by the parts' plain forms
    labels, bench = spark.read.parquet(f"{src}/labels.parquet"), spark.read.parquet(f"{src}/benchmark.parquet")
    text = {r.doc_id: r.text for r in rows.collect()}
    good = {r.doc_id for r in quality.quality_scores(rows, labels).collect() if r.predicted}
    sets, keep, label = {i: _shingles(text[i]) for i in sorted(good)}, set(), {}
    for i in sets:
        linked = {label[j] for j in label if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
        label[i] = min(linked, default=i)
        label = {j: label[i] if c in linked else c for j, c in label.items()}
    keep = set(label.values())
    index = decontaminate.Index([(r.item_id, r.text) for r in bench.collect()])
    keep = {i for i in keep if not index.find(text[i])}
    clean = {r.doc_id: r.text for r in secrets.redact(rows.where(rows.doc_id.isin(list(keep)))).collect()}
    enc = chunk_bpe.ChunkEncoder(chunk_bpe.tokenizer_path())
    assert {r.doc_id: bytes(r.ids) for r in got.collect()} == {i: enc.encode(t) for i, t in clean.items()}


def test_pipeline_of_empty_tables(spark, tmp_path):
    src = "/root/testdata/sf0.001"
    docs, labels, bench = (spark.read.parquet(f"{src}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    for name, d, rest in (("nothing", docs.limit(0), 0), ("no-labels", docs.limit(8), None)):
        d.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.limit(0).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        bench.limit(0).write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        n = corpus_pipeline.run(spark, f"{tmp_path}/{name}").count()
        assert n == rest if rest is not None else 0 < n <= 8
