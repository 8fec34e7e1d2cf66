"""Benchmark passages in documents by latent semantic retrieval.

Passages of documents (windows of ``WINDOW`` words) are TF-IDF vectors over the
words of the benchmark. A randomised singular value decomposition over all of
them, made in tasks, gives a latent space: one pass sketches the range with sparse
random signs, one forms the small Gram matrix in that range. The items weigh as
much in it as the corpus, or rare items would be lost among what is common.
Passages and items are compared by cosine in that space; candidates are settled
by longest common subsequences of words, so paraphrases that keep most words in
order count, and by the same for the item's answer.

Items come to the driver in blocks of at most ``ITEMS``, each with its own
vocabulary and space, so what is broadcast is bounded for any benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import BROADCAST_BYTES, kept_small, mix64, sliced, text_of
from tallyloom.plans.storage import materialize

WINDOW, STRIDE = 64, 32
#: Longer items are searched in pieces of so many words.
PIECE = 48
ITEMS = 2000
#: Dimensions of the latent space, and more that the sketch has.
RANK, EXTRA = 128, 8
#: Words in more than this share of all passages carry no weight, unless an item has nearly no others.
COMMON = 0.02
FEWEST = 4
COSINE = 0.55
#: Shares of an item's words, in order, that make a leak by themselves, and with the answer.
ALONE, WITH_ANSWER, ANSWER = 0.8, 0.6, 0.5
#: Nonzeros of the sketch per passage.
_SIGNS = 4
_ROWS = 128
_PUNCTUATION = re.compile("[\u2010-\u206f]")
_BLANKED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased words; ASCII other than letters and digits separates them, and general punctuation."""
    data = text.lower().encode("utf-8", "replace")
    if b"\xe2\x80" in data or b"\xe2\x81" in data:
        data = _PUNCTUATION.sub(" ", text.lower()).encode("utf-8", "replace")
    return data.translate(_BLANKED).split()


@dataclass
class Piece:
    item: object
    ids: np.ndarray
    answer: np.ndarray


def pieces_of(items: list[tuple[object, str, str | None]]) -> tuple[list[Piece], dict[bytes, int]]:
    """Pieces of items, and the ids of their words from 1. Without an answer, the last quarter of an item is its answer."""
    ids: dict[bytes, int] = {}
    found = []
    for item, text, answer in items:
        codes = np.array([ids.setdefault(w, len(ids) + 1) for w in words_of(text or "")], np.int64)
        known = np.array([ids.setdefault(w, len(ids) + 1) for w in words_of(answer or "")], np.int64)
        for begin in range(0, max(1, len(codes) - PIECE // 2), PIECE // 2) if len(codes) > PIECE else [0]:
            part = codes[begin : begin + PIECE]
            if len(part):
                found.append(Piece(item, part, known if len(known) else part[-max(3, len(part) // 4) :]))
    return found, ids


_CODED = "kind int, doc_id long, first int, codes binary"


def _coded(docs: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """Kind 0: the words of a document as ids (0: not in the benchmark). Kind 1, per task: passages, and how many hold each word."""
    kind = np.dtype("<u2" if len(ids) < 65_535 else "<u4")
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = shared.value, [c.split()[0] for c in _CODED.split(", ")]
        counts, blocks = np.zeros(len(known) + 1, np.int64), 0
        for batch in sliced(batches):
            rows, data, seen = [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text)
                codes = np.fromiter(map(known.get, words, repeat(0)), kind, len(words))
                here = np.nonzero(codes)[0]
                seen.append((here // STRIDE + blocks) * (len(known) + 1) + codes[here])
                blocks += -(-len(codes) // STRIDE)
                if len(here) > 1:
                    rows.append(k)
                    data.append(codes.tobytes())
            counts += np.bincount(np.unique(np.concatenate(seen)) % (len(known) + 1), minlength=len(counts))
            n = len(rows)
            doc_id = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), doc_id, pa.array([0] * n, pa.int32()), pa.array(data, pa.binary())], names)
        counts[0] = blocks
        parts = [(1, None, k, counts[k : k + 4096].tobytes()) for k in range(0, len(counts), 4096)]
        types = pa.int32(), pa.int64(), pa.int32(), pa.binary()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*parts), types)], names)

    return docs.mapInArrow(run, _CODED)


def _summed(parts: DataFrame, dtype: str) -> dict[int, np.ndarray]:
    """Sums by ``first`` of arrays that tasks have made; in two levels, so a group grows with the root of their number."""

    def added(frame):
        total = np.sum([np.frombuffer(x, dtype) for x in frame["codes"]], axis=0)
        return frame.iloc[:1].assign(codes=[total.tobytes()])

    tasks = max(1, int(parts.rdd.getNumPartitions() ** 0.5))
    rows = parts.select("first", (F.spark_partition_id() % tasks).alias("part"), "codes")
    schema = "first int, part int, codes binary"
    rows = rows.groupBy("first", "part").applyInPandas(added, schema).groupBy("first").applyInPandas(added, schema)
    return {r["first"]: np.frombuffer(r["codes"], dtype) for r in rows.collect()}


@dataclass
class Space:
    """The weighted words (0: none), their weights, and, as they come, the basis of the sketch and of the latent space."""

    term: np.ndarray  # word id to row, -1 if without weight
    weight: np.ndarray
    kind: str
    basis: np.ndarray | None = None

    def entries(self, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of several documents: (stretch, row, value) of the TF-IDF vectors of stretches of ``STRIDE`` words, and the first stretch of each.

        A passage is a stretch and the next one; one more without words ends each document.
        """
        stretches, rows, firsts, first = [], [], [], 0
        for found in codes:
            row = self.term[found]
            at = np.nonzero(row >= 0)[0]
            stretches.append(at // STRIDE + first)
            rows.append(row[at])
            firsts.append(first)
            first += -(-len(found) // STRIDE) + 1
        stretch, row = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (stretches, rows))
        key, tf = np.unique(stretch * len(self.weight) + row, return_counts=True)
        stretch, row = np.divmod(key, len(self.weight))
        return stretch, row, tf * self.weight[row], np.array([*firsts, first])

    def norms(self, stretch: np.ndarray, row: np.ndarray, value: np.ndarray, count: int) -> np.ndarray:
        """Lengths of the TF-IDF vectors of passages, 1 where a passage has none of the words."""
        key = np.concatenate([stretch, stretch - 1]) * len(self.weight) + np.concatenate([row, row])
        key, at = np.unique(key, return_inverse=True)
        both = np.bincount(at, np.concatenate([value, value]))
        passage = key // len(self.weight)
        squares = np.bincount(passage[passage >= 0], both[passage >= 0] ** 2, count)
        return np.sqrt(np.where(squares > 0, squares, 1))

    def project(self, stretch: np.ndarray, row: np.ndarray, value: np.ndarray, count: int) -> np.ndarray:
        """Vectors of all passages in the basis, not scaled: sums over a stretch and the next one."""
        sums = np.zeros((count + 1, self.basis.shape[1]), np.float32)
        if len(stretch):
            starts = np.concatenate([[0], np.nonzero(stretch[1:] != stretch[:-1])[0] + 1])
            ends = np.append(starts[1:], len(stretch))
            for k in range(0, len(starts), 1024):
                a, b = starts[k], ends[min(k + 1024, len(starts)) - 1]
                gathered = self.basis[row[a:b]]
                gathered *= value[a:b, None].astype(np.float32)
                sums[stretch[starts[k : k + 1024]]] = np.add.reduceat(gathered, starts[k : k + 1024] - a, axis=0)
        return sums[:-1] + sums[1:]


def _batches(batches: Iterator[pa.RecordBatch], space: Space, most: int = 400_000):
    """(ids, codes) of documents with about ``most`` words together."""
    ids, codes, size = [], [], 0
    for batch in batches:
        for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(doc_id)
            codes.append(np.frombuffer(data, space.kind))
            size += len(codes[-1])
            if size >= most:
                yield ids, codes
                ids, codes, size = [], [], 0
    if ids:
        yield ids, codes


def _partial(coded: DataFrame, space: Space, width: int, add, dtype: str) -> np.ndarray:
    """A matrix that each task adds its documents to, summed over tasks; it comes in blocks of rows."""
    height = len(space.weight) if add is _sketch else width
    shared = coded.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, total = shared.value, np.zeros((height, width), dtype)
        for ids, codes in _batches(batches, here):
            add(here, total, ids, codes)
        if total.any():
            parts = [(k, total[k : k + _ROWS].tobytes()) for k in range(0, height, _ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())], ["first", "codes"])

    result = np.zeros((height, width), dtype)
    for first, data in _summed(materialize(coded.mapInArrow(run, "first int, codes binary"), "partial"), dtype).items():
        result[first : first + _ROWS] = data.reshape(-1, width)
    return result


def _sketch(space: Space, total: np.ndarray, ids: list, codes: list[np.ndarray]) -> None:
    """Adds the transposed TF-IDF matrix times a sparse random sign matrix; signs depend on document and passage alone."""
    stretch, row, value, firsts = space.entries(codes)
    if not len(stretch):
        return
    count = int(firsts[-1])
    norms = space.norms(stretch, row, value, count)
    doc = firsts.searchsorted(np.arange(count), "right") - 1
    seed = np.array([hash(i) & 0xFFFFFFFF for i in ids], np.uint64)[doc] * np.uint64(1 << 20) + (np.arange(count) - firsts[doc]).astype(np.uint64)
    width = total.shape[1]
    for k in range(_SIGNS):
        drawn = mix64(seed * np.uint64(_SIGNS) + np.uint64(k))
        column = (drawn >> np.uint64(33)).astype(np.int64) % width
        scaled = (1.0 - 2.0 * (drawn & np.uint64(1)).astype(float)) / norms
        for shift in (0, 1):  # an entry is in the passage of its stretch and in the one before
            at = np.maximum(stretch - shift, 0)
            use = value * scaled[at] * (stretch >= shift)
            total += np.bincount(row * width + column[at], use, total.size).reshape(total.shape)


def _gram(space: Space, total: np.ndarray, ids: list, codes: list[np.ndarray]) -> None:
    stretch, row, value, firsts = space.entries(codes)
    count = int(firsts[-1])
    vectors = space.project(stretch, row, value, count) / space.norms(stretch, row, value, count)[:, None].astype(np.float32)
    total += vectors.T @ vectors


def lcs(masks: dict[int, int], length: int, several: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel; ``masks`` has the positions of each word of the item."""
    row, full = (1 << length) - 1, (1 << length) - 1
    for word in several:
        if mask := masks.get(word, 0):
            both = row & mask
            row = ((row + both) | (row - both)) & full
    return length - row.bit_count()


def _masks(ids: np.ndarray) -> dict[int, int]:
    found: dict[int, int] = {}
    for k, word in enumerate(ids.tolist()):
        found[word] = found.get(word, 0) | 1 << k
    return found


LEAKS = "doc_id long, item_id long, first_word int, last_word int, cosine double, share double, answer_share double"


def _leaks_of_block(docs: DataFrame, items: list[tuple[object, str, str | None]]) -> DataFrame | None:
    pieces, ids = pieces_of(items)
    if not pieces:
        return None
    coded = materialize(_coded(docs, ids), "coded")
    counts = _summed(coded.where("kind = 1").select("first", "codes"), "<i8")
    counts = np.concatenate([counts[k] for k in sorted(counts)]) if counts else np.zeros(len(ids) + 1, np.int64)
    total, counts = max(1, counts[0]), np.maximum(counts, 1)
    rare = counts <= COMMON * total
    rare[0] = False
    for piece in pieces:
        if len(set(piece.ids[rare[piece.ids]].tolist())) < FEWEST:
            rare[piece.ids] = True
    term = np.where(rare, np.cumsum(rare) - 1, -1)
    weight = np.log((total + 1) / counts[rare]) + 0.1
    space = Space(term, weight, "<u2" if len(ids) < 65_535 else "<u4")
    codes = coded.where("kind = 0").select("doc_id", "codes")
    width = min(RANK + EXTRA, len(weight))

    queries = np.zeros((len(pieces), len(weight)))
    for k, piece in enumerate(pieces):
        rows = term[piece.ids]
        np.add.at(queries[k], rows[rows >= 0], weight[rows[rows >= 0]])
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    # Every vector has length 1, so so many passages weigh as much as so many items.
    scale = np.sqrt(total / len(pieces))
    sketch = _partial(codes, space, width, _sketch, "<f8")
    sketch += scale * np.sqrt(_SIGNS) * queries.T @ np.random.default_rng(1).standard_normal((len(pieces), width))
    space.basis = np.linalg.qr(sketch)[0].astype(np.float32)
    seen = queries @ space.basis
    gram = _partial(codes, space, space.basis.shape[1], _gram, "<f8") + scale * scale * seen.T @ seen
    values, vectors = np.linalg.eigh(gram)
    space.basis = (space.basis @ vectors[:, ::-1][:, :RANK]).astype(np.float32)
    latent = queries @ space.basis
    latent = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)).T.astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((space, latent, pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, latent, pieces = shared.value
        whole = [_masks(p.ids) for p in pieces]
        content = [_masks(p.ids[space.term[p.ids] >= 0]) for p in pieces]
        sizes = [int((space.term[p.ids] >= 0).sum()) for p in pieces]
        answers = [_masks(p.answer) for p in pieces]
        for doc_ids, codes in _batches(batches, space):
            stretch, row, value, firsts = space.entries(codes)
            vectors = space.project(stretch, row, value, int(firsts[-1]))
            vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
            best: dict[tuple[int, int], tuple] = {}
            for k in range(0, len(vectors), 4096):
                cosine = vectors[k : k + 4096] @ latent
                for i, q in zip(*np.nonzero(cosine >= COSINE)):
                    at = k + int(i)
                    doc = int(firsts.searchsorted(at, "right") - 1)
                    begin = max(0, (at - int(firsts[doc])) * STRIDE - STRIDE)
                    region = codes[doc][begin : begin + WINDOW + 2 * STRIDE].tolist()
                    n = len(pieces[q].ids)
                    share = lcs(whole[q], n, region) / n
                    if share < WITH_ANSWER or lcs(content[q], sizes[q], region) < WITH_ANSWER * sizes[q]:
                        continue
                    answer = lcs(answers[q], len(pieces[q].answer), region) / len(pieces[q].answer)
                    if share < ALONE and answer < ANSWER:
                        continue
                    key, found = (doc, pieces[q].item), (share, float(cosine[i, q]), answer, begin, begin + len(region) - 1)
                    if key not in best or found > best[key]:
                        best[key] = found
            if best:
                rows = [(doc_ids[d], item, f[3], f[4], f[1], f[0], f[2]) for (d, item), f in best.items()]
                types = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [c.split()[0] for c in LEAKS.split(", ")])

    return codes.mapInArrow(run, LEAKS)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, last_word, cosine, share, answer_share): one row per document and item that it holds.

    ``benchmark`` has item_id and text, and may have an ``answer``. The words are a
    passage that holds the item; ``share`` is the part of its words found in order.

    * Null and empty texts and items hold nothing; items with a null id are reported with it.
    * A repeated document is reported for each of its rows, a repeated item for its id.
    * Other columns are not looked at. Empty tables give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"), answer.alias("answer"))
    items = items.withColumn("size", F.length("text"))
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("chars")).first()
    blocks = max(1, -(-size["n"] // ITEMS), -(-(size["chars"] or 0) * 4 // BROADCAST_BYTES))
    found = None
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        leaks = _leaks_of_block(rows, [(r["item_id"], r["text"], r["answer"]) for r in block])
        if leaks is not None:
            found = leaks if found is None else found.unionByName(leaks)
    return found if found is not None else docs.sparkSession.createDataFrame([], LEAKS)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without a leak, as they came; a row with a null id is never dropped."""
    leaking, _ = kept_small(find_leaks(docs, benchmark).select("doc_id").where("doc_id IS NOT NULL").distinct(), 16, "leaking")
    return docs.join(leaking, "doc_id", "left_anti").select(*docs.columns)
