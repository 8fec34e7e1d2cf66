"""Toxic spans by a linear-chain conditional random field.

Documents carry one label, so tokens are labelled first: words that occur in
toxic documents beyond any chance, in documents with that label. A field of two
states is fitted to them; its features are the word, its ends and shape, and its
neighbours. Forward-backward marginals of every token of every whole text are
gathered into a document score, set to the labels by logistic calibration.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import free_prefix, majority_labels, map_batches, sampled_texts, sigmoid, text_of

#: Labelled documents in the sample that the field is fitted on.
DOCUMENTS = 2000
BUCKETS = 1 << 17
SPAN = 0.5
#: A word counts as toxic if chance gives its documents with less than this, divided by the number of words.
CHANCE = 1e-2
EPOCHS, PARTS, RATE = 12, 8, 0.15
_TOKEN = re.compile(r"\w+")
_CACHED = 200_000
_BATCH_TOKENS = 1 << 19


def _hashed(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}:{value}".encode("utf-8", "replace")) % BUCKETS


def features(word: str) -> tuple[list[int], int, int]:
    """Buckets for the word itself, and for being before and after another."""
    low = word.lower()
    shape = "A" if word.isupper() and len(word) > 1 else "a" if word.isalpha() else "0"
    own = [_hashed("w", low), _hashed("p", low[:3]), _hashed("s", low[-3:]), _hashed("c", f"{shape}{min(len(low), 12)}")]
    return own, _hashed("b", low), _hashed("a", low)


def marginals(unary: np.ndarray, first: np.ndarray, moves: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each token, and of each pair of states at (token before, token), shape (n, 2, 2).

    ``unary``: log-odds of toxic; ``first``: starts of documents; ``moves``: log
    weights of (state before, state). All documents are one chain: the matrix of a
    first token has equal rows, which forgets the state before. The chain is cut in
    chunks; products of chunks give the state that enters each, so the loops run
    along a chunk for all chunks at once. Exact.
    """
    n = len(unary)
    chunks = max(1, int(np.sqrt(n)))
    length = -(-n // chunks)
    odds = np.exp(np.clip(unary, -30, 30))
    m = np.zeros((chunks * length, 2, 2))
    m[:, 0, 0] = m[:, 1, 1] = 1
    e = np.exp(moves)
    m[:n, :, 0] = np.where(first[:, None], 1.0, e[None, :, 0])
    m[:n, :, 1] = np.where(first[:, None], np.exp(start), e[None, :, 1]) * odds[:, None]
    m = m.reshape(chunks, length, 2, 2)
    a, b, c, d = (np.ascontiguousarray(m[:, :, i, j].T) for i in (0, 1) for j in (0, 1))
    p = [np.ones(chunks), np.zeros(chunks), np.zeros(chunks), np.ones(chunks)]
    for t in range(length):
        p = [p[0] * a[t] + p[1] * c[t], p[0] * b[t] + p[1] * d[t], p[2] * a[t] + p[3] * c[t], p[2] * b[t] + p[3] * d[t]]
        total = p[0] + p[1] + p[2] + p[3]
        p = [x / total for x in p]
    enters, leaves = np.empty((chunks, 2)), np.empty((chunks, 2))
    x, y = 0.5, 0.5
    for k in range(chunks):
        enters[k] = x, y
        x, y = x * p[0][k] + y * p[2][k], x * p[1][k] + y * p[3][k]
        x, y = x / (x + y), y / (x + y)
    x, y = 0.5, 0.5
    for k in reversed(range(chunks)):
        leaves[k] = x, y
        x, y = p[0][k] * x + p[1][k] * y, p[2][k] * x + p[3][k] * y
        x, y = x / (x + y), y / (x + y)
    forward, backward = np.empty((2, length + 1, chunks)), np.empty((2, length + 1, chunks))
    x, y = enters[:, 0], enters[:, 1]
    forward[:, 0] = x, y
    for t in range(length):
        x, y = x * a[t] + y * c[t], x * b[t] + y * d[t]
        total = x + y
        x, y = x / total, y / total
        forward[:, t + 1] = x, y
    x, y = leaves[:, 0], leaves[:, 1]
    backward[:, length] = x, y
    for t in reversed(range(length)):
        x, y = a[t] * x + b[t] * y, c[t] * x + d[t] * y
        total = x + y
        x, y = x / total, y / total
        backward[:, t] = x, y
    both = forward[:, 1:] * backward[:, 1:]
    toxic = (both[1] / both.sum(0)).T.reshape(-1)[:n]
    pairs = np.stack([forward[i, :-1] * w * backward[j, 1:] for (i, j), w in zip(((0, 0), (0, 1), (1, 0), (1, 1)), (a, b, c, d))])
    pairs = (pairs / pairs.sum(0)).transpose(2, 1, 0).reshape(-1, 2, 2)[:n]
    return toxic, pairs


def toxic_words(sample: list[tuple[set[str], int]]) -> set[str]:
    """Words with more toxic documents than chance gives; a binomial bound, corrected for the number of words."""
    inside, everywhere = Counter(), Counter()
    for words, label in sample:
        everywhere.update(words)
        if label:
            inside.update(words)
    share = sum(label for _, label in sample) / max(1, len(sample))
    if not 0 < share < 1:
        return set()
    limit = np.log(CHANCE / max(1, len(everywhere)))

    def chance(k: int, n: int) -> float:
        """Logarithm of the probability of exactly k; the tail above is at most as much times n."""
        return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * np.log(share) + (n - k) * np.log(1 - share)

    return {w for w, k in inside.items() if k > everywhere[w] * (1 + share) / 2 and chance(k, everywhere[w]) < limit}


@dataclass
class ToxicityModel:
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    moves: np.ndarray
    start: float
    calibration: np.ndarray  # of 1, log of the expected toxic tokens, largest marginal
    share: float


class Reader:
    """Log-odds of the tokens of texts; the features of a word are looked up once."""

    def __init__(self, model: ToxicityModel) -> None:
        self.model, self.place, self.rows = model, {}, []

    def unary(self, documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-odds, starts of documents, and where each document with tokens begins."""
        if len(self.place) > _CACHED:
            self.place, self.rows = {}, []
        place, rows, m = self.place, self.rows, self.model
        for w in set().union(*documents):
            if w not in place:
                own, before, after = features(w)
                place[w] = len(rows)
                rows.append((m.own[own].sum(), m.before[before], m.after[after]))
        at = np.fromiter((place[w] for d in documents for w in d), np.int64)
        begins = np.cumsum([0, *map(len, documents)])[:-1]
        first = np.zeros(len(at), bool)
        first[begins] = True
        last = np.roll(first, -1)
        own, before, after = np.array(rows)[at].T
        total = own.copy()
        total[1:] += np.where(first[1:], 0, before[:-1])
        total[:-1] += np.where(last[:-1], 0, after[1:])
        return total, first, begins


def summary(toxic: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Per document: 1, log of the expected number of toxic tokens, largest marginal."""
    expected = np.add.reduceat(toxic, begins)
    return np.column_stack([np.ones(len(begins)), np.log(expected + 1e-4), np.maximum.reduceat(toxic, begins)])


def fit(sample: list[tuple[str, int]]) -> ToxicityModel | None:
    """None without labelled texts of both kinds."""
    documents = [(_TOKEN.findall(t), int(label)) for t, label in sample]
    share = sum(x for _, x in documents) / max(1, len(documents))
    documents = [(d, x) for d, x in documents if d]
    if not 0 < share < 1 or not documents:
        return None
    words = toxic_words([({w.lower() for w in d}, x) for d, x in documents])
    own, before, after = (np.zeros(BUCKETS) for _ in range(3))
    moves, start = np.zeros((2, 2)), np.zeros(1)
    squares = [np.full_like(x, 1e-8) for x in (own, before, after, moves, start)]
    known: dict[str, tuple[list[int], int, int]] = {}
    parts = []
    for k in range(PARTS):
        part = documents[k::PARTS]
        flat = [w for d, _ in part for w in d]
        if not flat:
            continue
        for w in set(flat):
            if w not in known:
                known[w] = features(w)
        ids = np.array([known[w][0] for w in flat], np.int32)
        prev, nxt = (np.fromiter((known[w][k] for w in flat), np.int32) for k in (1, 2))
        first = np.zeros(len(flat), bool)
        first[np.cumsum([0, *[len(d) for d, _ in part]])[:-1]] = True
        gold = np.array([x and w.lower() in words for d, x in part for w in d], float)
        parts.append((ids, prev, nxt, first, np.roll(first, -1), gold))
    for _ in range(EPOCHS):
        for ids, prev, nxt, first, last, gold in parts:
            unary = own[ids].sum(1)
            unary[1:] += np.where(first[1:], 0, before[prev[:-1]])
            unary[:-1] += np.where(last[:-1], 0, after[nxt[1:]])
            toxic, pairs = marginals(unary, first, moves, float(start[0]))
            off = gold - toxic
            state = gold.astype(int)
            seen = np.zeros((2, 2))
            np.add.at(seen, (state[:-1][~first[1:]], state[1:][~first[1:]]), 1)
            gradients = (
                np.bincount(ids.ravel(), np.repeat(off, ids.shape[1]), BUCKETS),
                np.bincount(prev[:-1], np.where(first[1:], 0, off[1:]), BUCKETS),
                np.bincount(nxt[1:], np.where(last[:-1], 0, off[:-1]), BUCKETS),
                seen - pairs[~first].sum(0), np.array([off[first].sum()]),
            )
            for value, g, square in zip((own, before, after, moves, start), gradients, squares):
                g = g - 1e-2 * value
                square += g * g
                value += RATE * g / np.sqrt(square)
    model = ToxicityModel(own, before, after, moves, float(start[0]), np.zeros(3), share)
    unary, first, begins = Reader(model).unary([d for d, _ in documents])
    rows = summary(marginals(unary, first, moves, model.start)[0], begins)
    labels, w = np.array([x for _, x in documents], float), np.zeros(3)
    for _ in range(50):  # Newton's method
        s = sigmoid(rows @ w)
        w = w + np.linalg.solve((rows * (s * (1 - s))[:, None]).T @ rows + 1e-2 * np.eye(3), rows.T @ (labels - s) - 1e-2 * w)
    model.calibration = w
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, documents: int = DOCUMENTS) -> ToxicityModel | None:
    """Fit on at most so many rows of ``docs`` with a label in ``labels.toxic``."""
    known = majority_labels(labels, "toxic").join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    return fit(sampled_texts(docs, known, documents))


SPANS = "array<struct<start:int,end:int,p:double>>"


def tag_toxic(docs: DataFrame, model: ToxicityModel | None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all if None) with ``score``, ``expected`` and ``spans``.

    ``score`` is the calibrated probability of the label, ``expected`` the sum of
    the tokens' marginals, ``spans`` (start, end, largest marginal) the runs of
    tokens that are toxic rather than not, in characters.

    * A null text and one without a word has no spans and the score of no evidence.
    * Without a model every score is 0.
    * Columns called as the results are replaced; all others pass. Repeated rows get the same result.
    """
    names = ["score", "expected", "spans"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    scored = free_prefix("__scored", keep)
    rows = docs.select(*[F.col(c) for c in keep], text_of().alias(scored))
    schema = rows.drop(scored).withColumns({"score": F.lit(0.0), "expected": F.lit(0.0), "spans": F.lit(None).cast(SPANS)}).schema
    last = len(keep)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def make():
        reader = Reader(model) if model else None

        def some(several: list[str], at: list[int], tokens: list[list[str]], out) -> None:
            unary, first, begins = reader.unary(tokens)
            toxic, _ = marginals(unary, first, model.moves, model.start)
            told = summary(toxic, begins)
            for k, i in enumerate(at):
                out[0][i], out[1][i] = float(sigmoid(told[k] @ model.calibration)), float(np.exp(told[k, 1]) - 1e-4)
                if told[k, 2] >= SPAN:
                    out[2][i] = runs(several[i], toxic[begins[k] : begins[k] + len(tokens[k])])

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            several = batch.column(last).to_pylist()
            nothing = float(sigmoid(np.array([1, np.log(1e-4), 0]) @ model.calibration)) if model else 0.0
            out = [nothing] * len(several), [0.0] * len(several), [[] for _ in several]
            at, tokens, size = [], [], 0
            for i, t in enumerate(several if model else []):
                if found := _TOKEN.findall(t):
                    at.append(i)
                    tokens.append(found)
                    size += len(found)
                if size > _BATCH_TOKENS:
                    some(several, at, tokens, out)
                    at, tokens, size = [], [], 0
            if at:
                some(several, at, tokens, out)
            results = [pa.array(out[0]), pa.array(out[1]), pa.array(out[2], span_type)]
            return pa.RecordBatch.from_arrays([*batch.columns[:last], *results], [*keep, *names])

        return step

    return map_batches(rows, make, schema)


def runs(text: str, toxic: np.ndarray) -> list[tuple[int, int, float]]:
    """Runs of neighbouring tokens whose marginal is at least ``SPAN``."""
    found, before = [], -2
    for k, token in enumerate(_TOKEN.finditer(text)):
        if toxic[k] >= SPAN:
            if before == k - 1:
                found[-1] = (found[-1][0], token.end(), max(found[-1][2], float(toxic[k])))
            else:
                found.append((token.start(), token.end(), float(toxic[k])))
            before = k
    return found
