"""Packing token sequences as a cutting-stock problem solved by column generation.

Documents become token ids in tasks. Full pieces of ``capacity`` ids are sequences
of their own; a remainder of more than half the capacity is cut at the half, as
many long pieces could not be put together without padding. The driver sees their histogram only (fewer counts than ``capacity``): a linear
program over patterns, whose columns are priced by a knapsack dynamic program.
Rounded patterns go back to the tasks as a table bounded by the capacity, where
the rank of a piece among those of its length gives its sequence and offset.
"""

from __future__ import annotations

import base64
import re
import sys
import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import map_batches, text_of, texts
from tallyloom.plans.storage import materialize

CAPACITY = 1024
END = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: A pattern program stops at this relative distance from its lower bound.
GAP = 1e-3
MOST_COLUMNS = 800
#: Rows of one length that are ranked in one group.
_RANKED = 50_000


class Encoder:
    """Ids of whole texts, as bytes: little-endian unsigned 32-bit integers.

    The ranks hold the vocabulary of the tokenizer file and give the same ids
    several times faster. The tokenizer itself takes the texts that ranks cannot or may not
    know as it does: those with one of its added tokens, with a run of white space that
    the pattern's look-ahead would follow too deep, or with characters that Unicode
    got, or put into another class, after version 3.2.
    """

    _RUN = 10_000

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.deep = re.compile(rf"\s{{{self._RUN}}}")
        self.settled: set[str] = set()
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _all_settled(self, text: str) -> bool:
        if text.isascii():
            return True
        old = unicodedata.ucd_3_2_0.category
        new = set(text) - self.settled
        self.settled |= {c for c in new if old(c) != "Cn" and old(c) == unicodedata.category(c)}
        return new <= self.settled

    def encode(self, text: str) -> bytes:
        deep = len(text) >= self._RUN and self.deep.search(text)
        if deep or not self._all_settled(text) or any(token in text for token in self.added):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            found = self.fast(text)
        ids = array("I", found)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Where a document of n ids is cut: full pieces, half a piece if the rest is longer, the rest."""
    ends = [*range(capacity, n + 1, capacity)]
    done = ends[-1] if ends else 0
    ends += [done + capacity // 2] if n - done > capacity // 2 else []
    ends += [n] if not ends or ends[-1] < n else []
    return list(zip([0, *ends], ends))


def pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document, with its end id, as ``cuts`` has it."""

    def make():
        encoder = Encoder(tokenizer_path, ranks_path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, several = batch.column("doc_id").to_pylist(), texts(batch)
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(ids, several):
                data = encoder.encode(text) + END.to_bytes(4, "little")
                n = len(data) // 4
                for start, end in cuts(n, capacity):
                    piece = data[4 * start : 4 * end]
                    for column, value in zip(out, (doc_id, start, end - start, zlib.crc32(piece), n)):
                        column.append(value)
            names = [c.split()[0] for c in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

        return step

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), make, PIECES)


# -- patterns ---------------------------------------------------------------


def best_pattern(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of lengths within the capacity: an unbounded knapsack."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = lengths.searchsorted(room, "right")
        best[room] = best[room - 1]
        if fits:
            totals = best[room - lengths[:fits]] + values[:fits]
            k = int(totals.argmax())
            if totals[k] > best[room] + 1e-12:
                best[room], choice[room] = totals[k], k
    counts, room = np.zeros(len(lengths)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        counts[choice[room]] += 1
        room -= lengths[choice[room]]
    return float(best[capacity]), counts


def _filling(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """A basis: column k is the pattern that uses up length k."""
    left, columns = demand.astype(float).copy(), np.diag(capacity // lengths).astype(float)
    open_ = np.ones(len(lengths), bool)
    for k in reversed(range(len(lengths))):
        while open_[k]:
            pattern, room = np.zeros(len(lengths)), capacity
            for i in range(k, -1, -1):
                if open_[i] and lengths[i] <= room:
                    pattern[i] = min(room // lengths[i], max(1, np.ceil(left[i])))
                    room -= pattern[i] * lengths[i]
            used = np.nonzero(pattern)[0]
            times = left[used] / pattern[used]
            out = used[int(times.argmin())]
            left[used] = np.maximum(left[used] - times.min() * pattern[used], 0)
            open_[out], columns[:, out] = False, pattern
    return columns


def fractional_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and their amounts of the linear program: least number of sequences that covers the demand.

    Revised simplex with an explicit inverse, from the patterns of a largest-first
    filling, each of which uses up one length. Columns are priced half way between the prices of the basis and those of the
    best lower bound so far (first: a length by its share of the capacity), which
    is far from the jumps of degenerate bases. It ends near the lower bound.
    """
    columns = _filling(lengths, demand, capacity)
    inverse = np.linalg.inv(columns)
    amounts = np.maximum(inverse @ demand, 0)
    prices = inverse.sum(axis=0)
    center = lengths / capacity
    bound = float(demand @ center)
    for _ in range(MOST_COLUMNS):
        if amounts.sum() <= bound * (1 + GAP):
            break
        for asked in ((prices + center) / 2, prices):
            worth, column = best_pattern(lengths, asked, capacity)
            if demand @ asked / worth > bound:
                bound, center = float(demand @ asked / worth), asked / worth
            worth = float(prices @ column)
            if worth > 1 + 1e-9:
                break
        else:
            break
        step = inverse @ column
        ratios = np.where(step > 1e-9, amounts / np.where(step > 1e-9, step, 1), np.inf)
        leaves = int(ratios.argmin())
        if not np.isfinite(ratios[leaves]):
            break
        pivot = inverse[leaves] / step[leaves]
        amounts = np.maximum(amounts - ratios[leaves] * step, 0)
        amounts[leaves] = ratios[leaves]
        inverse -= np.outer(step, pivot)
        inverse[leaves] = pivot
        prices = prices + (1 - worth) * pivot
        columns[:, leaves] = column
    return columns, amounts


def fitted(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """What rounding leaves, best fit first, largest length first: patterns and how often each."""
    open_by_room: dict[int, list[dict[int, int]]] = {}
    closed: dict[tuple, int] = {}

    def close(pattern: dict[int, int]) -> None:
        key = tuple(sorted(pattern.items()))
        closed[key] = closed.get(key, 0) + 1

    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            room = min((r for r, left in open_by_room.items() if r >= length and left), default=None)
            pattern = open_by_room[room].pop() if room is not None else {}
            room = (capacity if room is None else room) - length
            pattern[length] = pattern.get(length, 0) + 1
            if room:
                open_by_room.setdefault(room, []).append(pattern)
            else:
                close(pattern)
    for left in open_by_room.values():
        for pattern in left:
            close(pattern)
    return [(dict(key), n) for key, n in closed.items()]


def whole_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns (length to count) and how many sequences take each; every length is used exactly as often as it occurs."""
    left = {n: c for n, c in histogram.items() if 0 < n < capacity and c > 0}
    result = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    while sum(left.values()) > 0:
        lengths = np.array(sorted(left))
        columns, amounts = fractional_patterns(lengths, np.array([left[n] for n in lengths], float), capacity)
        taken = 0
        for k in np.argsort(-amounts, kind="stable"):
            pattern = {int(lengths[i]): int(columns[i, k]) for i in np.nonzero(columns[:, k])[0]}
            times = min([int(amounts[k] + 1e-6), *[left[n] // c for n, c in pattern.items()]])
            if times > 0:
                result.append((pattern, times))
                taken += times
                for n, c in pattern.items():
                    left[n] -= c * times
        left = {n: c for n, c in left.items() if c}
        if taken == 0 or sum(left.values()) < 4 * capacity:
            break
    return result + fitted(left, capacity)


def _slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, pieces per sequence, first sequence, first offset."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, ...]]] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            rank = used.get(length, 0)
            rows.setdefault(length, []).append((rank, pattern[length], sequence, offset))
            used[length] = rank + pattern[length] * times
            offset += length * pattern[length]
        sequence += times
    return {length: tuple(np.array(c) for c in zip(*r)) for length, r in rows.items()}


def _ranked(rows: DataFrame) -> DataFrame:
    """``rank`` among the pieces of a length, from 0, without bringing a length together."""
    buckets = max(1, rows.count() // _RANKED)
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.selectExpr(
        "length", "bucket",
        "sum(n) OVER (PARTITION BY length ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before",
    )
    numbered = dealt.selectExpr(
        "*", "row_number() OVER (PARTITION BY length, bucket ORDER BY doc_id, start, ids_crc32) - 1 AS place"
    )
    return numbered.join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("place"))


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: the columns of ``PIECES`` with ``sequence_id`` and ``offset``.

    ``tokenizer_path`` is a byte-level tokenizer file, ``ranks_path`` the same
    vocabulary as ranks, ``pattern`` how it splits text.

    * A null or empty text is a piece of the end id alone; null ids are allowed. Texts
      may be of any length and hold runs of any one character.
    * Repeated rows are packed as often as they occur.
    * A sequence holds whole pieces one after the other; only its end is padding.
    * Other columns are not looked at. An empty table gives no rows.
    """
    rows = materialize(pieces(docs, tokenizer_path, ranks_path, pattern, capacity), "pieces")
    histogram = {int(r["length"]): int(r["count"]) for r in rows.groupBy("length").count().collect()}
    slots = _slots(whole_patterns(histogram, capacity))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                at = np.nonzero(length == n)[0]
                first, per, base, start = slots[int(n)]
                k = first.searchsorted(rank[at], "right") - 1
                nth = rank[at] - first[k]
                sequence[at] = base[k] + nth // per[k]
                offset[at] = start[k] + nth % per[k] * n
            names = [c.split()[0] for c in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

        return step

    return map_batches(_ranked(rows), make, PIECES + ", sequence_id long, offset long")
