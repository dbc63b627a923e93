"""Toxicity: character n-gram embeddings averaged over passages into a linear softmax."""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import by_bytes
from .folds import remainder

ORDERS = (3, 4, 5)
BUCKETS = 1 << 18
SAMPLE = 2000  # labelled texts of each class that training sees, at most
MOST = 32_768  # bytes of the longest text that training sees
PASSAGE, STRIDE = 4, 2  # words of a passage, and words from one to the next
MEMO = 400_000  # words whose sums a worker remembers
#: Digits are all alike; ASCII characters other than letters and digits separate words.
_SPACED = bytes(48 if 48 <= b <= 57 else b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8").translate(_SPACED).split()


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of the n-grams of words, with a space on either side of a word as its marks."""
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    n = len(b)
    spaces = np.concatenate([[0], np.cumsum(b == 32)])
    at, out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    h = b.astype(np.uint32) + np.uint32(1)
    for k in range(2, min(max(ORDERS), n) + 1):
        h = (h[: n - k + 1] * np.uint32(0x01000193)) ^ b[k - 1 :].astype(np.uint32) * np.uint32(0x9E3779B1)
        if k in ORDERS:
            ok = np.flatnonzero(spaces[k - 1 : n] == spaces[1 : n - k + 2])  # no space strictly inside
            x = h[ok]
            at.append(spaces[ok + 1] - 1)
            out.append(((x ^ x >> np.uint32(15)) % np.uint32(BUCKETS)).astype(np.int64))
    return np.concatenate(at), np.concatenate(out)


def passages(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first word, end) of the passages of texts that stand one after the other, of ``lengths`` words.

    Passages of PASSAGE words begin every STRIDE words, so every run of STRIDE words lies in one; a
    text always has one, if of fewer words or none.
    """
    n = np.maximum(-(-(lengths - PASSAGE) // STRIDE), 0) + 1
    text = np.repeat(np.arange(len(lengths)), n)
    step = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    start = np.cumsum(lengths) - lengths
    first = start[text] + step * STRIDE
    return text, first, np.minimum(first + PASSAGE, (start + lengths)[text])


def pooled(text: np.ndarray, d: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of passages' log-odds d: each text's log-odds log(sum exp d), and each passage's share in it."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, text, d)
    e = np.exp(d - top[text])
    total = np.bincount(text, e, n)
    return top + np.log(total), e / total[text]


@dataclass
class Model:
    """For each bucket its embedding times the softmax's class difference, and the difference of the biases."""

    weight: np.ndarray
    bias: float

    def word_sums(self, words: list[bytes]) -> np.ndarray:
        """(sum of the weights of a word's n-grams, their number) of each word."""
        at, bucket = grams(words)
        n = len(words)
        return np.column_stack([np.bincount(at, self.weight[bucket], n)[:n], np.bincount(at, minlength=n)[:n]])

    def word_logits(self, words: list[bytes]) -> np.ndarray:
        """The log-odds of passages of one word each."""
        s = self.word_sums(words)
        return s[:, 0] / np.maximum(s[:, 1], 1) + self.bias

    def log_odds(self, texts: list[str], memo: dict[bytes, tuple[float, float]] | None = None) -> np.ndarray:
        memo = {} if memo is None else memo
        lists = [words_of(t) for t in texts]
        new = [w for w in set().union(*lists) if w not in memo]
        memo.update(zip(new, map(tuple, self.word_sums(new).tolist()), strict=True))
        sums = np.array([memo[w] for ws in lists for w in ws]).reshape(-1, 2)
        c = np.concatenate([np.zeros((1, 2)), np.cumsum(sums, axis=0)])
        text, first, end = passages(np.array([len(ws) for ws in lists], np.int64))
        total = c[end] - c[first]
        if len(memo) > MEMO:
            memo.clear()
        return pooled(text, total[:, 0] / np.maximum(total[:, 1], 1) + self.bias, len(texts))[0]

    def scores(self, texts: list[str], memo: dict[bytes, tuple[float, float]] | None = None) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(texts, memo), -40, 40))) if texts else np.zeros(0)


class Bags:
    """The training texts: their distinct words' n-grams, their tokens and their passages."""

    def __init__(self, texts: list[str], labels: np.ndarray):
        self.y = labels
        self.share = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / len(labels)  # classes weighed alike
        lists = [words_of(t) for t in texts]
        words = sorted(set().union(*lists))
        number = {w: i for i, w in enumerate(words)}
        self.words, self.token = len(words), np.array([number[w] for ws in lists for w in ws], np.int64)
        self.text, self.first, self.end = passages(np.array([len(ws) for ws in lists], np.int64))
        at, bucket = grams(words)
        order = np.argsort(at, kind="stable")
        at, bucket = at[order], bucket[order]
        self.has, self.starts = np.unique(at, return_index=True)
        by_bucket = np.argsort(bucket, kind="stable")
        self.used, self.first_of = np.unique(bucket[by_bucket], return_index=True)
        self.slot, self.word_of = np.searchsorted(self.used, bucket), at[by_bucket]
        size = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=self.words)[self.token])])
        self.size = np.maximum(size[self.end] - size[self.first], 1)

    def step(self, e: np.ndarray, w: np.ndarray, b: np.ndarray, decay: float) -> tuple[float, tuple[np.ndarray, ...]]:
        """Cross-entropy of the texts plus the embeddings' decay, and its gradients by embeddings (of the used buckets), weights and biases."""
        mean = np.zeros((len(e), len(self.text)))
        for k, row in enumerate(e):  # one dimension at a time bounds the memory
            sums = np.zeros(self.words)
            sums[self.has] = np.add.reduceat(row[self.slot], self.starts)
            c = np.concatenate([[0.0], np.cumsum(sums[self.token])])
            mean[k] = (c[self.end] - c[self.first]) / self.size
        odds, part = pooled(self.text, (w[:, 1] - w[:, 0]) @ mean + b[1] - b[0], len(self.y))
        p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        loss = -(self.share * np.log(np.where(self.y == 1, p, 1 - p) + 1e-300)).sum() + 0.5 * decay * float((e.astype(float) ** 2).sum())
        g = ((p - self.y) * self.share)[self.text] * part
        de = np.zeros(e.shape)
        for k in range(len(e)):
            x = g / self.size * (w[k, 1] - w[k, 0])
            n = len(self.token) + 1
            per_token = np.cumsum(np.bincount(self.first, x, n) - np.bincount(self.end, x, n))[:-1]
            de[k] = np.add.reduceat(np.bincount(self.token, per_token, self.words)[self.word_of], self.first_of) + decay * e[k]
        return loss, (de, np.column_stack([-mean @ g, mean @ g]), np.array([-g.sum(), g.sum()]))


def train(texts: list[str], labels: list[int], dim: int = 4, epochs: int = 60, rate: float = 0.08, seed: int = 7, decay: float = 3e-5) -> Model | None:
    """Embeddings and softmax, trained jointly by Adam on whole texts. None if the labels are all alike.

    A passage's vector is the mean of the embeddings of all n-grams of its words. The softmax
    gives its log-odds; the odds of a text are the sum of its passages' odds, so cross-entropy
    of whole texts trains everything, and a word drowns in no long text.
    """
    y = np.asarray(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return None
    bags = Bags(texts, y)
    rng = np.random.default_rng(seed)
    e, w, b = rng.normal(0, 0.1, (dim, BUCKETS)).astype(np.float32), rng.normal(0, 0.5, (dim, 2)), np.zeros(2)
    own = e[:, bags.used]
    if len(bags.used):
        state = [(np.zeros_like(p), np.zeros_like(p)) for p in (own, w, b)]
        for t in range(1, epochs + 1):
            for q, dq, (m, v) in zip((own, w, b), bags.step(own, w, b, decay)[1], state, strict=True):
                m += 0.1 * (dq - m)
                v += 0.01 * (dq * dq - v)
                q -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)).astype(q.dtype)
    e[:] = 0  # buckets that training didn't see say nothing
    e[:, bags.used] = own
    return Model(((w[:, 1] - w[:, 0]) @ e).astype(np.float32), float(b[1] - b[0]))


@functools.lru_cache(maxsize=2)
def _loaded(data: bytes) -> tuple[Model, dict[bytes, tuple[float, float]]]:
    return pickle.loads(data), {}


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = MOST, modulus: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most ``sample`` (text, label) of each label, outside the held-out fold: those of least hash, of at most ``most`` bytes.

    Both bounds are parameters of the fit, and bound what the driver collects. Ids are drawn
    first, one row an id; an id labelled both ways, null labels and null ids are left out, and
    an id that repeats gives its text of least digest.
    """
    rows = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)").where(remainder("id", modulus) != held)
    rows = rows.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").select("id", "y", F.xxhash64("id", F.lit("toxic")).alias("h"))
    drawn = rows.where("y = 0").orderBy("h", "id").limit(sample).unionByName(rows.where("y = 1").orderBy("h", "id").limit(sample))
    small = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).where(F.octet_length("t") <= most)
    found = small.join(F.broadcast(drawn), F.col("doc") == F.col("id")).groupBy("id").agg(F.first("y").alias("y"), F.first("h").alias("h"), F.min(F.struct(F.xxhash64("t"), "t")).alias("t"))
    return [(r.t, r.y) for r in found.select("t.t", "y", "h", "id").orderBy("h", "id").collect()]


def toxicity_scores(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; the model is learnt outside the held-out fold.

    Null text counts as empty. Without labels of both kinds every score is the only label
    known (0.5 for none). Repeated rows repeat; null ids are in fold 0; an empty table
    gives an empty result.
    """
    data = labelled_sample(docs, labels, modulus=modulus, held=held, id_col=id_col, text_col=text_col)
    model = train([t for t, _ in data], [y for _, y in data])
    flat = float(np.mean([y for _, y in data])) if data else 0.5
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, memo = _loaded(sent.value)
        for whole in batches:
            for b in by_bytes(whole, 1, 1_000_000):
                texts = b.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(texts), flat) if m is None else m.scores(texts, memo))], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    out = rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, score double")
    return out.select(F.col("id").alias(id_col), (remainder("id", modulus) == held).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
