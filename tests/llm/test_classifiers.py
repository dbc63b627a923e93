import random
import zlib

import numpy as np
import pytest

from tidewheel.llm import quality, toxicity


def _texts(n=240):
    rnd = random.Random(2)
    plain = ["river", "stone", "lamp", "quiet", "morning", "walk", "bread", "seven", "the", "of", "and"]
    rows = []
    for i in range(n):
        words = [rnd.choice(plain) + rnd.choice(["", "s", "ly", "ed"]) for _ in range(60)]
        toxic, good = i % 5 == 0, i % 4 != 0
        if toxic:
            words[rnd.randrange(60)] = rnd.choice(["grumblefix", "grumblefax", "grumblefox"])
        if not good:
            words = [w + rnd.choice(["###", "$$$"]) for w in words]
        rows.append((i, " ".join(words), int(good), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = _texts()
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, *_ in rows] + [(1000, None, 0.5), (1001, "", 0.5), (None, "x", 0.5), (3, rows[3][1], 0.5), (1002, "word " * 30_000, 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows] + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def _auc(pairs):
    good = [s for s, y in pairs if y]
    bad = [s for s, y in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("op, col, modulus, held", [(quality.quality_scores, 2, 3, 1), (toxicity.toxicity_scores, 3, 5, 0)])
def test_scores_on_held_out_rows(tables, op, col, modulus, held):
    docs, labels = tables
    rows = op(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r[0]: r[col] for r in _texts()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held)
    assert _auc([(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]) > 0.95


@pytest.mark.parametrize("op", [quality.quality_scores, toxicity.toxicity_scores])
def test_without_labels_or_documents(tables, op):
    docs, labels = tables
    assert op(docs, labels.limit(0)).count() == docs.count()
    assert op(docs.limit(0), labels).count() == 0


def test_rejected_documents_go(tables):
    docs, labels = tables
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    truth = {r[0]: r[2] for r in _texts()}
    assert np.mean([(i in ids) == bool(y) for i, y in truth.items()]) > 0.97


def test_unseen_spelling_shares_grams():
    rows = [(t, x) for _, t, _, x in _texts()]
    m = toxicity.train([t for t, _ in rows], [x for _, x in rows])
    s = m.word_logits([b"grumblefex", b"morning", b"river"])
    assert s[0] > s[1] + 1 and s[0] > s[2] + 1


def test_density_difference():
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, (4000, 2)), rng.normal(0, 3, (4000, 2))
    q = quality.Qda.fit(np.array([4000.0, 4000.0]), np.array([a.sum(0), b.sum(0)]), np.array([a.T @ a, b.T @ b]), np.full(2, -99.0), np.full(2, 99.0), shrink=0.0, ridge=0.0)
    x = np.array([[0.3, -1.0], [2.0, 2.0]])
    log = lambda v, m, c: -0.5 * ((v - m) @ np.linalg.inv(c) @ (v - m) + np.log(np.linalg.det(c)))
    want = [1 / (1 + np.exp(log(v, a.mean(0), np.cov(a.T, bias=True)) - log(v, b.mean(0), np.cov(b.T, bias=True)))) for v in x]
    assert q.scores(x) == pytest.approx(want)
    assert quality.Qda.fit(np.array([0.0, 3.0]), np.zeros((2, 2)), np.zeros((2, 2, 2)), np.zeros(2), np.zeros(2)) is None


def _log_odds_by_loops(model, text):
    words, odds = toxicity.words_of(text), 0.0
    for first in range(0, max(len(words) - toxicity.PASSAGE, 0) + toxicity.STRIDE, toxicity.STRIDE):
        if first and first + toxicity.PASSAGE - toxicity.STRIDE >= len(words):
            break
        found = [k for w in words[first : first + toxicity.PASSAGE] for k in toxicity.grams([w])[1].tolist()]
        odds += np.exp(sum(float(model.weight[k]) for k in found) / max(len(found), 1) + model.bias)
    return np.log(odds)


def test_scores_equal_plain_loops():
    rows = _texts(60)
    m = toxicity.train([t for _, t, *_ in rows], [x for *_, x in rows], epochs=8)
    texts = ["", "one", "a b c", "one two three four", "one two three four five", "#$", "river grumblefix " * 7] + [t for _, t, *_ in rows[:9]]
    assert m.log_odds(texts, {}) == pytest.approx([_log_odds_by_loops(m, t) for t in texts], abs=1e-5)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(3)
    bags = toxicity.Bags(["", "bad words in here for all", "a few calm words", "river walk bad", "quiet"], np.array([0.0, 1, 0, 1, 0]))
    params = [rng.normal(0, 1, (2, len(bags.used))), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)]
    _, grads = bags.step(*params, 0.01)
    for q, g in zip(params, grads, strict=True):
        for at in list(np.ndindex(q.shape))[:25]:
            old, ends = q[at], []
            for h in (1e-6, -1e-6):
                q[at] = old + h
                ends.append(bags.step(*params, 0.01)[0])
            q[at] = old
            assert g[at] == pytest.approx((ends[0] - ends[1]) / 2e-6, abs=1e-6)


def test_sample_has_a_row_an_id(tables):
    docs, labels = tables
    twice = labels.union(labels).union(labels.where("doc_id = 12").withColumn("toxic", 1 - labels.toxic))
    got = toxicity.labelled_sample(docs.union(docs), twice, sample=10)
    assert len(got) == 20 and sum(y for _, y in got) == 10
    assert len(toxicity.labelled_sample(docs.union(docs), twice)) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(240) if i != 12)


def test_quality_query_against_a_plain_fit(tables):
    docs, labels = tables
    y = {r.doc_id: r.quality for r in labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").collect()}
    rows = [(r.doc_id, quality.statistics(r.text or "")) for r in docs.collect()]
    train = [(np.array(x), y[i]) for i, x in rows if i in y and zlib.crc32(str(i).encode()) % 3 != 1]
    x = [np.array([v for v, k in train if k == c]) for c in (0, 1)]
    own = [np.cov(a.T, bias=True) for a in x]
    pooled = sum(len(a) * c for a, c in zip(x, own, strict=True)) / len(train)
    spread = np.diag(np.diag(pooled) + 1e-6)
    every = np.concatenate(x)

    def density(v, c):
        cov = 0.8 * own[c] + 0.2 * pooled + 1e-3 * spread + 1e-9 * np.eye(len(v))
        d = v - x[c].mean(axis=0)
        return np.log(len(x[c]) / len(train)) - 0.5 * (np.linalg.slogdet(cov)[1] + d @ np.linalg.solve(cov, d))

    want = {}
    for i, v in rows:
        v = np.clip(v, every.min(axis=0), every.max(axis=0))
        want[i] = 1 / (1 + np.exp(np.clip(density(v, 0) - density(v, 1), -60, 60)))
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert got.keys() == want.keys()
    assert [got[i] for i in want] == pytest.approx(list(want.values()), abs=1e-4)
