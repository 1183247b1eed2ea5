"""Quality classifier by positive-unlabelled learning.

Trusted positives (labelled good) and unlabelled web text train a linear
model that minimises the non-negative unbiased risk (Kiryo et al., 2017)

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss, where R_p and R_u are mean losses over positives and
unlabelled text. Negative labels are never used. The class prior is estimated
from the same two samples: a classifier of positives against unlabelled text
ranks held-back rows, and the prior is the smallest ratio, with a confidence
bound, of unlabelled to positive mass above a threshold (best bin estimation,
Garg et al., 2021).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, remainder_of_id

#: Bounds of the fit: rows drawn of either kind.
POSITIVE_ROWS = 6_000
UNLABELLED_ROWS = 6_000
STEPS = 400
RATE = 0.05
RIDGE = 1e-4
THRESHOLD = 0.3
#: Byte shares, then shape features.
FEATURES = 256 + 8


def features(text: str | None) -> np.ndarray:
    """Features of one whole text; zeros without characters."""
    out = np.zeros(FEATURES, dtype=np.float64)
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    out[:256] = np.sqrt(np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) / len(raw))
    words = raw.split()
    n = len(words)
    if n:
        lines = raw.split(b"\n")
        counts: dict[bytes, int] = {}
        for word in words:
            counts[word] = counts.get(word, 0) + 1
        repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
        out[256] = np.log1p(n) / 10
        out[257] = len(counts) / n
        out[258] = max(counts.values()) / n
        out[259] = repeats / n
        out[260] = len(set(lines)) / len(lines)
        out[261] = len(raw) / n / 20
        out[262] = max(map(len, words)) / 100
        out[263] = sum(c for c in counts.values() if c > 1) / n
    return np.minimum(out, 5.0)


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid((rows - self.centre) / self.scale @ self.weights + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _adam(size: int):
    mean, square, step = np.zeros(size), np.zeros(size), 0

    def move(gradient: np.ndarray, rate: float) -> np.ndarray:
        nonlocal mean, square, step
        step += 1
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        return rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)

    return move


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> np.ndarray:
    """Weights with the bias last. Without a prior: positives against
    unlabelled; with one: the non-negative risk."""
    p = np.hstack([positive, np.ones((len(positive), 1))])
    u = np.hstack([unlabelled, np.ones((len(unlabelled), 1))])
    weights, move = np.zeros(p.shape[1]), _adam(p.shape[1])
    for _ in range(STEPS):
        at_p, at_u = _sigmoid(p @ weights), _sigmoid(u @ weights)
        up = -p.T @ (1 - at_p) / len(p)  # gradient of R_p(+)
        if prior is None:
            gradient = (up + u.T @ at_u / len(u)) / 2
        else:
            down = u.T @ at_u / len(u) - prior * (p.T @ at_p / len(p))
            risk = -np.log1p(-np.minimum(at_u, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(at_p, 1 - 1e-12)).mean()
            # where the negative part of the risk falls below zero, step back up along it
            gradient = prior * up + down if risk >= 0 else -down
        gradient[:-1] += RIDGE * weights[:-1]
        weights = weights - move(gradient, RATE)
    return weights


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """Share of positives in the unlabelled sample, from scores of held-back rows."""
    order = np.sort(np.concatenate([positive, unlabelled]))[::-1]
    p = np.searchsorted(np.sort(positive), order, side="left")
    u = np.searchsorted(np.sort(unlabelled), order, side="left")
    above_p, above_u = 1 - p / len(positive), 1 - u / len(unlabelled)
    slack = np.sqrt(np.log(4 / confidence) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    seen = above_p > 0
    at = np.argmin((above_u[seen] + slack) / above_p[seen])
    return float(np.clip(above_u[seen][at] / above_p[seen][at], 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """Fit on two bounded samples of feature rows; without either, every score is 0.5."""
    size = positive.shape[1]
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(size), np.ones(size), np.zeros(size), 0.0, 0.5)
    centre, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = (positive - centre) / scale, (unlabelled - centre) / scale
    prior = 0.5
    if min(len(p), len(u)) > 3:
        rough = _descend(p[::2], u[::2], None)
        held = (x[1::2] @ rough[:-1] for x in (p, u))
        prior = estimate_prior(*held)
    weights = _descend(p, u, prior)
    return Model(centre, scale, weights[:-1], float(weights[-1]), prior)


def held_out(doc_id):
    return remainder_of_id(doc_id, 5) == 0


def _matrix(rows: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).astype(np.float32).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["features"])

    found = map_arrow(rows.select("text"), run, "features binary").collect()
    if not found:
        return np.zeros((0, FEATURES))
    return np.stack([np.frombuffer(r[0], dtype=np.float32) for r in found]).astype(np.float64)


def _draw(rows: DataFrame, most: int, salt: str) -> DataFrame:
    """About ``most`` rows by a hash of the id and text, at most twice that many."""
    n = rows.count()
    draw = F.pmod(F.xxhash64("doc_id", F.octet_length("text"), F.lit(salt)), F.lit(1 << 30))
    return rows.filter(draw < int(min(1.0, most / max(1, n)) * (1 << 30))).limit(2 * most)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled-good and unlabelled rows outside the held-out fold.

    Both samples are bounded in rows: of a drawn good id one row is learned
    from, the one whose text has the least hash, however many rows share it.
    """
    learn = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text")
    good = labels.filter((F.col("quality") == 1) & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    good = _draw(good.withColumn("text", F.lit("")), POSITIVE_ROWS, "positive").select("doc_id")
    positive = learn.join(good, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return train(_matrix(positive), _matrix(_draw(learn, UNLABELLED_ROWS, "unlabelled")))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, held_out, score,
    predicted`` (1 if the score is at least ``THRESHOLD``).

    Whole texts are read. Null and empty texts have zero features and the
    score that follows; null ids and repeated rows are kept; an empty table
    gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()) for t in batch.column(2)]
            scores = shared.value.score(np.stack(rows)) if rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    return map_arrow(texts, run, "doc_id long, held_out boolean, score double, predicted int")
