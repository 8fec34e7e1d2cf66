"""Language identification by error-correcting output codes.

Each language has a codeword; one logistic classifier per bit predicts it from
hashed n-grams of bytes. Decoding takes the codeword of least loss, each bit
weighted by how well its classifier does, and flags texts with a close second.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import free_prefix, map_batches, sigmoid, text_of

#: Texts of each language that the classifiers are fitted on, and of all together; with many languages each has an equal share.
PER_LANGUAGE, IN_ALL = 1000, 6000
BUCKETS = 1 << 13
ROUNDS = 150
#: Less than this between the two likeliest languages is ambiguous.
AMBIGUOUS = 0.2
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_BLANKED = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BLOCK = 64


def grams(text: str) -> np.ndarray:
    """Square roots of the shares of the hashed one- to three-byte grams of the lower-cased text."""
    data = text.lower().encode("utf-8", "replace").translate(_BLANKED)
    codes = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    pairs = codes[:-1] * np.uint32(257) + codes[1:]
    threes = pairs[:-1] * np.uint32(263) + codes[2:]
    counts = np.bincount(codes, minlength=BUCKETS)
    for kind in (pairs, threes):
        counts += np.bincount((kind * np.uint32(2654435761)) >> np.uint32(19), minlength=BUCKETS)
    return np.sqrt(counts / counts.sum(), dtype=np.float32)


def codewords(languages: int, seed: int = 5) -> np.ndarray:
    """A row of +1 and -1 for each language: all dichotomies if few, else the random code with the largest least distance."""
    if languages <= 5:
        bits = [[1] + [1 if k >> i & 1 else -1 for i in range(languages - 1)] for k in range(2 ** (languages - 1) - 1)]
        return np.array(bits).reshape(-1, languages).T
    random, best, least = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = random.choice([-1, 1], (languages, int(np.ceil(10 * np.log2(languages)))))
        code = code[:, np.abs(code.sum(0)) < languages]
        distances = (code[:, None] != code[None]).sum(2) + np.eye(languages, dtype=int) * code.shape[1]
        if distances.min() > least:
            best, least = code, distances.min()
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # language, bit
    weights: np.ndarray  # bucket, bit
    bias: np.ndarray
    trust: np.ndarray  # of each bit

    def shares(self, rows: np.ndarray) -> np.ndarray:
        """Of each language, by loss-weighted decoding."""
        margins = rows @ self.weights + self.bias
        losses = np.logaddexp(0, -margins[:, None, :] * self.code[None]) @ self.trust
        raised = np.exp(losses.min(1, keepdims=True) - losses)
        return raised / raised.sum(1, keepdims=True)


def fit(sample: list[tuple[str, str]]) -> LanguageModel | None:
    """From (text, language); None without any."""
    sample = [(t, x) for t, x in sample if _LETTER.search(t)]
    if not sample:
        return None
    languages = sorted({x for _, x in sample})
    code = codewords(len(languages))
    rows = np.array([grams(t) for t, _ in sample])
    kind = np.array([languages.index(x) for _, x in sample])
    bits = (code[kind] > 0).astype(np.float32)
    # Every language counts the same, however many texts it has.
    each = (1 / np.bincount(kind)[kind] / len(languages)).astype(np.float32)[:, None]
    weights, bias = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
    for t in range(1, ROUNDS + 1):
        off = (sigmoid(rows @ weights + bias) - bits) * each
        for k, (value, g) in enumerate(((weights, rows.T @ off + 1e-6 * weights), (bias, off.sum(0)))):
            first, second = moments[2 * k], moments[2 * k + 1]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            value -= 0.2 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-7)
    right = (((rows @ weights + bias) > 0) == (bits > 0)).mean(0) if code.shape[1] else np.ones(0)
    return LanguageModel(languages, code, weights, bias, np.clip(right, 0.5, 1).astype(np.float32) ** 4)


def fit_language(docs: DataFrame, per_language: int = PER_LANGUAGE, in_all: int = IN_ALL) -> LanguageModel | None:
    """Fit on ``text`` and non-null ``lang`` of the rows, drawn by a hash of the id: at most so many of each language, which share what is drawn in all."""
    known = docs.where("lang IS NOT NULL").select("doc_id", text_of().alias("text"), "lang")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(in_all).collect()}
    if not counts:
        return None
    share = max(1, min(per_language, in_all // len(counts)))
    # Rows without an id are told apart by their text. Some more than the share are drawn, then ranked.
    draw = F.xxhash64(F.lit(3), "doc_id", F.expr("CASE WHEN doc_id IS NULL THEN text END"))
    more, parts, drawn = share + 6 * share**0.5 + 20, 1 << 40, None
    for lang, count in counts.items():
        one = (F.col("lang") == lang) & (F.pmod("draw", F.lit(parts)) < int(parts * min(1.0, more / count)))
        drawn = one if drawn is None else drawn | one
    order = Window.partitionBy("lang").orderBy(F.pmod("draw", F.lit(parts)), "doc_id", "text")
    ranked = known.withColumn("draw", draw).where(drawn).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= share)
    return fit([(r["text"], r["lang"]) for r in ranked.orderBy("lang", "rank").select("text", "lang").collect()])


def identify(docs: DataFrame, model: LanguageModel | None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all if None) with ``lang_pred``, ``score`` (share of that language) and ``ambiguous``.

    * A null text and one without a letter is ``und`` with score 0, and ambiguous; so is every text without a model.
    * Columns called as the results are replaced; all others pass. Repeated rows get the same result.
    """
    names = ["lang_pred", "score", "ambiguous"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    scored = free_prefix("__scored", keep)
    rows = docs.select(*[F.col(c) for c in keep], text_of().alias(scored))
    schema = rows.drop(scored).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "ambiguous": F.lit(True)}).schema
    last = len(keep)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            several = batch.column(last).to_pylist()
            found, score, close = [UNDETERMINED] * len(several), np.zeros(len(several)), np.ones(len(several), bool)
            told = [i for i, t in enumerate(several) if model is not None and _LETTER.search(t)]
            for begin in range(0, len(told), _BLOCK):
                at = told[begin : begin + _BLOCK]
                shares = model.shares(np.array([grams(several[i]) for i in at]))
                best = shares.argmax(1)
                ranked = np.sort(shares, 1)
                score[at] = ranked[:, -1]
                close[at] = ranked[:, -1] - ranked[:, -2] < AMBIGUOUS if shares.shape[1] > 1 else False
                for i, k in zip(at, best):
                    found[i] = model.languages[k]
            return pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(found), pa.array(score), pa.array(close)], [*keep, *names])

        return step

    return map_batches(rows, make, schema)
