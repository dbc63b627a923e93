"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.plans.storage import discard, materialize

from .batches import by_bytes
from .folds import remainder

#: Character classes of bytes: lower, upper, digit, space, line break, sentence marks, other ASCII, beyond ASCII.
_CLASS = np.array([
    4 if b in b"\n\r" else 3 if b in b" \t\x0b\x0c" else 0 if 97 <= b <= 122 else 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 5 if b in b".,;:!?'\"-()" else 7 if b >= 128 else 6
    for b in range(256)
])
_ENDS_WELL = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,;:!?'\")") | frozenset(range(128, 256))
NAMES = (
    "log_bytes", "log_words", "word_length", "log_longest", "lower", "upper", "digit", "space", "breaks", "marks", "symbols", "beyond",
    "entropy", "distinct_words", "top_word", "bare_words", "odd_ends", "line_words", "repeated_lines", "short_words",
)


def statistics(text: str) -> list[float]:
    """The statistics of one text, on scales on which they spread evenly: logs of sizes, square roots of shares."""
    data = text.encode("utf-8")
    n = len(data)
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = np.bincount(_CLASS, weights=by_byte, minlength=8) / max(n, 1)
    p = by_byte[by_byte > 0] / max(n, 1)
    words = data.split()
    k = max(len(words), 1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    bare = sum(c for w, c in counts.items() if len(w) == 1 and w[0] not in _ENDS_WELL)
    odd = sum(c for w, c in counts.items() if w[-1] not in _ENDS_WELL)
    short = sum(c for w, c in counts.items() if len(w) <= 3)
    lines = [x for x in data.split(b"\n") if x.strip()]
    root = math.sqrt
    return [
        math.log1p(n), math.log1p(len(words)), math.log1p(max(n - k, 0) / k), math.log1p(max(map(len, words), default=0)), *np.sqrt(share).tolist(),
        float(-(p * np.log2(p)).sum()), root(len(counts) / k), root(max(counts.values(), default=0) / k), root(bare / k), root(odd / k),
        math.log1p(len(words) / max(len(lines), 1)), root(1 - len(set(lines)) / max(len(lines), 1)), root(short / k),
    ]


@dataclass
class Qda:
    """Two Gaussian classes with cached Cholesky factors; class 0 first."""

    priors: np.ndarray
    means: np.ndarray
    factors: np.ndarray  # inverse of each lower Cholesky factor
    log_dets: np.ndarray
    low: np.ndarray  # statistics are clipped to the range that training saw
    high: np.ndarray

    @staticmethod
    def fit(n: np.ndarray, sums: np.ndarray, squares: np.ndarray, low: np.ndarray, high: np.ndarray, shrink: float = 0.1, ridge: float = 1e-3) -> Qda | None:
        """From counts, sums and outer-product sums by class: each covariance is drawn towards the pooled one, then to its diagonal.

        None if a class has no rows: then there is nothing to tell apart.
        """
        if (n <= 0).any():
            return None
        means = sums / n[:, None]
        own = squares / n[:, None, None] - means[:, :, None] * means[:, None, :]
        pooled = (own * n[:, None, None]).sum(axis=0) / n.sum()
        spread = np.diag(np.diag(pooled) + 1e-6)
        covs = [(1 - shrink) * c + shrink * pooled + ridge * spread + 1e-9 * np.eye(len(c)) for c in own]
        low_tri = [np.linalg.cholesky(c) for c in covs]
        return Qda(n / n.sum(), means, np.array([np.linalg.inv(x) for x in low_tri]), np.array([2 * np.log(np.diag(x)).sum() for x in low_tri]), low, high)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1: the logistic of the difference of Mahalanobis log-densities and priors."""
        x = np.clip(x, self.low, self.high)
        log = [math.log(p) - 0.5 * (d + (((x - m) @ f.T) ** 2).sum(axis=1)) for p, m, f, d in zip(self.priors, self.means, self.factors, self.log_dets, strict=True)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))


def quality_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x array<double>) of every row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_bytes(whole, 1):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([statistics(t.as_py()) for t in b.column(1)], pa.list_(pa.float64()))], names=["id", "x"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, x array<double>")


def _moments(rows: DataFrame) -> DataFrame:
    """(y, pos, total, low, high): sums of 1, x and x xT by class, one row a cell; summed in the tasks, then over them."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        low, high = np.full(d, np.inf), np.full(d, -np.inf)
        for b in batches:
            if not b.num_rows:
                continue
            y = b.column(0).to_numpy(zero_copy_only=False)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
            for c in (0, 1):
                z = x[y == c]
                total[c] += np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
        if np.isfinite(low).all():
            n = total.shape[1]
            edge = np.full((2, 2, n), np.nan)
            edge[0, :, 1 : d + 1], edge[1, :, 1 : d + 1] = low, high
            cols = [pa.array(np.repeat([0, 1], n), pa.int32()), pa.array(np.tile(np.arange(n), 2), pa.int32()), pa.array(total.ravel()), pa.array(edge[0].ravel(), from_pandas=True), pa.array(edge[1].ravel(), from_pandas=True)]
            yield pa.RecordBatch.from_arrays(cols, names=["y", "pos", "total", "low", "high"])

    cells = rows.mapInArrow(run, "y int, pos int, total double, low double, high double")
    return cells.groupBy("y", "pos").agg(F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))


def fit(features: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", shrink: float = 0.2) -> Qda | None:
    """The model of all labelled rows for which ``train`` (a condition on the column id) holds. Only sums come to the driver."""
    y = labels.select(F.col(id_col).alias("label_id"), F.col("quality").cast("int").alias("y")).where("label_id IS NOT NULL AND y IN (0, 1)")
    rows = features.where(train).join(y, F.col("id") == F.col("label_id")).select("y", "x")
    d = len(NAMES)
    total, low, high = np.zeros((2, 1 + d + d * d)), np.zeros(d), np.zeros(d)
    for r in _moments(rows).collect():
        total[r.y, r.pos] = r.total
        if r.low is not None:
            low[r.pos - 1], high[r.pos - 1] = r.low, r.high
    return Qda.fit(total[:, 0], total[:, 1 : d + 1], total[:, d + 1 :].reshape(2, d, d), low, high, shrink)


def _scored(features: DataFrame, model: Qda | None) -> DataFrame:
    """(id, score); without a model every score is 1, as nothing speaks against a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x) if model else np.ones(len(x)))], names=["id", "score"])

    return features.mapInArrow(run, f"id {features.schema['id'].dataType.simpleString()}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; fitted on all labelled rows outside the held-out fold.

    Statistics of a text are computed once and written; labels join them by id. Null text
    counts as empty; rows of a null id are scored but never learnt from; repeated rows repeat,
    and count as often in the fit; without labels of both kinds every score is 1.
    """
    features = materialize(quality_features(docs, id_col, text_col), "statistics")
    model = fit(features, labels, remainder("id", modulus) != held, id_col)
    out = _scored(features, model)
    return out.select(F.col("id").alias(id_col), (remainder("id", modulus) == held).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that the classifier rejects (score under 0.5). Columns stay.

    Texts are read twice, for the fit and for the decision, and never moved or written: only the
    vectors of statistics meet the labels. Null text counts as empty; without labels of both
    kinds every row stays; rows of a null id are judged but never learnt from.
    """
    features = materialize(quality_features(docs, id_col, text_col), "statistics")  # so that no task runs two Python workers
    model = fit(features, labels, remainder("id", modulus) != held, id_col)
    discard(features)
    if model is None:
        return docs
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_bytes(whole, at):
                x = np.array([statistics(t.as_py() or "") for t in b.column(at)]).reshape(-1, len(NAMES))
                yield b.filter(pa.array(model.scores(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
