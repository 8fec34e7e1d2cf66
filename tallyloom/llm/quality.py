"""Quality by positive-unlabelled learning.

An additive model over binned statistics of a text is fitted by minimising the
non-negative unbiased risk (du Plessis; Kiryo) on trusted positives and
unlabelled text. The class prior is estimated from the two: no region may hold
fewer unlabelled texts than the prior's share of positives. Labels of negatives
are never used. The fit is on bounded samples; every whole text is scored in tasks.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import free_prefix, majority_labels, map_batches, sampled_texts, sigmoid, text_of

#: Texts in the two samples that the model is fitted on.
POSITIVES, UNLABELLED = 3000, 6000
BINS = 12
ROUNDS, RATE, RIDGE = 400, 0.05, 1e-4


def _classes() -> np.ndarray:
    """By byte: 0 letter (also all of non-ASCII), 1 upper case, 2 digit, 3 blank, 4 line break, 5 anything else."""
    kinds = np.full(256, 5)
    kinds[128:] = 0
    kinds[[*range(97, 123)]], kinds[[*range(65, 91)]], kinds[[*range(48, 58)]] = 0, 1, 2
    kinds[[9, 11, 12, 13, 32]], kinds[10] = 3, 4
    return kinds


CLASSES = _classes()


def statistics(text: str) -> list[float]:
    """What the model sees of a text; all of it counts, an empty text is all zeros."""
    data = text.encode("utf-8", "replace")
    if not data:
        return [0.0] * 18
    codes = np.frombuffer(data, np.uint8)
    by_byte = np.bincount(codes, minlength=256)
    small, upper, digit, blank, line, other = np.bincount(CLASSES, by_byte, 6)
    punctuation = codes[CLASSES[codes] == 5]
    size = len(codes)
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    repeats = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x]
    share = by_byte[by_byte > 0] / size
    twice = np.count_nonzero((codes[1:] == codes[:-1]) & (CLASSES[codes[1:]] == 5))
    return [
        math.log1p(len(words)), small / size, upper / max(1, small + upper), digit / size, blank / size, line / size, other / size,
        twice / n, len(np.unique(punctuation)) / n, sum(len(w) for w in counts) / max(1, len(counts)),
        len(counts) / n, max(counts.values(), default=0) / n, pairs / max(1, n - 1), repeats / n,
        len(set(lines)) / max(1, len(lines)), sum(x[-1] in ".!?:;\"'" for x in lines) / max(1, len(lines)),
        -float(share @ np.log(share)), len(zlib.compress(data, 1)) / size,
    ]


@dataclass
class QualityModel:
    edges: np.ndarray  # statistic, edge
    weights: np.ndarray  # statistic, bin
    bias: float
    prior: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        found = np.full(len(rows), self.bias)
        for k in range(len(self.edges)):
            found += self.weights[k][self.edges[k].searchsorted(rows[:, k], "right")]
        return found


def _binned(rows: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One row of indicators per text, one group of bins per statistic, and 1 for the bias."""
    out = np.zeros((len(rows), edges.shape[0] * BINS + 1), np.float32)
    out[:, -1] = 1
    for k in range(edges.shape[0]):
        out[np.arange(len(rows)), k * BINS + edges[k].searchsorted(rows[:, k], "right")] = 1
    return out


def _descend(gradient, size: int) -> np.ndarray:
    """Adam for a fixed number of rounds."""
    weights, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, ROUNDS + 1):
        g = gradient(weights) + RIDGE * weights
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        weights -= RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return weights


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives among the unlabelled.

    A classifier of positives against unlabelled orders the texts; the prior is
    the least ratio of the unlabelled to the positives above any threshold that
    a tenth of the positives pass. Each half is judged by a fit on the other.
    """
    found = []
    for half in (0, 1):
        fit_p, fit_u, see_p, see_u = p[half::2], u[half::2], p[1 - half :: 2], u[1 - half :: 2]
        if not min(map(len, (fit_p, fit_u, see_p, see_u))):
            return 0.5

        def gradient(w):
            return -fit_p.T @ sigmoid(-(fit_p @ w)) / len(fit_p) + fit_u.T @ sigmoid(fit_u @ w) / len(fit_u)

        w = _descend(gradient, p.shape[1])
        high_p, high_u = np.sort(see_p @ w), np.sort(see_u @ w)
        steps = high_p[: int(len(high_p) * 0.9) + 1]
        passed_p = 1 - high_p.searchsorted(steps) / len(high_p)
        passed_u = 1 - high_u.searchsorted(steps) / len(high_u)
        found.append((passed_u / passed_p).min())
    return float(np.clip(np.mean(found), 0.02, 0.98))


def fit(positives: list[str], unlabelled: list[str]) -> QualityModel | None:
    """None where one of the samples is empty."""
    if not positives or not unlabelled:
        return None
    raw_p, raw_u = (np.array([statistics(t) for t in several]) for several in (positives, unlabelled))
    edges = np.quantile(np.vstack([raw_p, raw_u]), np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    p, u = _binned(raw_p, edges), _binned(raw_u, edges)
    prior = estimate_prior(p, u)

    def gradient(w):
        zp, zu = p @ w, u @ w
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        rest = u.T @ sigmoid(zu) / len(u) - prior * (p.T @ sigmoid(zp)) / len(p)
        if negative_risk < 0:  # the risk of negatives cannot be below zero: step back from the fit to noise
            return -rest
        return -prior * (p.T @ sigmoid(-zp)) / len(p) + rest

    w = _descend(gradient, p.shape[1])
    return QualityModel(edges, w[:-1].reshape(-1, BINS), float(w[-1]), prior)


def fit_quality(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> QualityModel | None:
    """Fit on rows of ``docs`` labelled 1 in ``labels.quality``, and on any rows of ``docs``; at most so many of each."""
    trusted = majority_labels(labels, "quality").where("label = 1")
    trusted = trusted.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    anyone = docs.select("doc_id", F.lit(None).alias("label")).where("doc_id IS NOT NULL")
    return fit([t for t, _ in sampled_texts(docs, trusted, positives)], [t for t, _ in sampled_texts(docs, anyone, unlabelled, seed=11)])


def score_quality(docs: DataFrame, model: QualityModel | None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all if None) with ``score``, the probability of good quality.

    * Null and empty texts are scored as a text of all-zero statistics.
    * Without a model (nothing to learn from) every score is 0.5.
    * A column called ``score`` is replaced; all others pass. Repeated rows are scored alike.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    scored = free_prefix("__scored", keep)
    rows = docs.select(*[F.col(c) for c in keep], text_of().alias(scored))
    schema = rows.drop(scored).withColumn("score", F.lit(0.0)).schema
    last = len(keep)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            if model is None:
                found = np.full(batch.num_rows, 0.5)
            else:
                found = sigmoid(model.logits(np.array([statistics(t) for t in batch.column(last).to_pylist()])))
            return pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(found)], [*keep, "score"])

        return step

    return map_batches(rows, make, schema)
