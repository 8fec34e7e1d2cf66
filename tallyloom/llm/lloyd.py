"""Vector codes by product quantisation, with a Lloyd iteration that compares active entries only.

Components become integers, so every distance, sum and mean is exact and does not
depend on how rows lie in partitions. Each row carries, per part, its assigned
entry and the exact distance to it. When the entries have been replaced, a part
whose assigned entry did not change still has a right distance, and compares it
with the entries that did change; only the other parts are compared with all.

A round is one pass that reads the rows of the round before and writes them anew,
and one aggregate of at most entries x components numbers. The driver sees the
codebooks, whose size the parameters bound, and nothing that grows with the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import kept_small, map_batches, sliced
from tallyloom.operators.skew import shuffled_for_join
from tallyloom.plans.storage import delete, new_path, written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Errors of a row stay below this.
_LARGEST = 1 << 62


@dataclass
class Codebooks:
    """Entries of each part as integers (parts, entries, width of a part), and what the rounds did."""

    entries: np.ndarray
    #: Per assignment: distances computed, and those that a plain rescan would compute.
    compared: list[tuple[int, int]] = field(default_factory=list)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector has a finite number in every component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return rows.where(F.col(vector).isNotNull() & finite)


def distances(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, entries) of integer vectors."""
    high = max(int(np.abs(part).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * high * high * max(1, part.shape[1]) < 1 << 53:  # then floating point is exact, and faster
        a, b = part.astype(float), entries.astype(float)
        found = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]
        return found.astype(np.int64)
    return (part * part).sum(1)[:, None] - 2 * (part @ entries.T) + (entries * entries).sum(1)[None]


def rescan(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row, the lowest index among equals, and its distance."""
    found = distances(part, entries)
    nearest = found.argmin(1)
    return nearest, found[np.arange(len(part)), nearest]


def reassign(
    part: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, held: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """The result of ``rescan`` from that for the entries before some ``moved``, and how many distances it took.

    A row whose entry stayed keeps its exact distance and looks at the moved
    entries alone, as all others are as far as before: a moved one wins if it is
    nearer, or as near with a lower index.
    """
    code, held = code.copy(), held.copy()
    lost = moved[code]
    if lost.any():
        code[lost], held[lost] = rescan(part[lost], entries)
    active, settled = np.nonzero(moved)[0], np.nonzero(~lost)[0]
    if len(active) and len(settled):
        found = distances(part[settled], entries[active])
        best = found.argmin(1)
        near, index = found[np.arange(len(settled)), best], active[best]
        wins = (near < held[settled]) | ((near == held[settled]) & (index < code[settled]))
        code[settled[wins]], held[settled[wins]] = index[wins], near[wins]
    return code, held, int(lost.sum()) * len(entries) + len(settled) * len(active)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    lists = batch.column(name)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, len(values) // batch.num_rows)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width) if width else np.zeros(n + 1), pa.int32()), pa.array(matrix.ravel()))


def _assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None, schema: str, kept: list[str]) -> DataFrame:
    """Rows with ``__ints``, ``__code``, ``__held`` and the distances it took; all entries are compared where ``moved`` is None."""
    n_parts, n_entries, width = books.shape

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ints = _matrix(batch, "__ints").astype(np.int64)
            code = np.zeros((len(ints), n_parts), np.int64)
            held = np.zeros((len(ints), n_parts), np.int64)
            took = np.zeros(len(ints), np.int64)
            old = None if moved is None else (_matrix(batch, "__code"), _matrix(batch, "__held"))
            for p in range(n_parts):
                part = ints[:, p * width : (p + 1) * width]
                if old is None:
                    code[:, p], held[:, p] = rescan(part, books[p])
                    took[0] += len(part) * n_entries
                else:
                    code[:, p], held[:, p], n = reassign(part, books[p], moved[p], old[0][:, p], old[1][:, p])
                    took[0] += n
            columns = [batch.column(c) for c in kept]
            columns += [_lists(ints.astype(np.int32)), _lists(code.astype(np.int32)), _lists(held), pa.array(took)]
            return pa.RecordBatch.from_arrays(columns, [*kept, "__ints", "__code", "__held", "__took"])

        return step

    return map_batches(rows, make, schema)


_SUMS = "part int, entry int, position int, total long, n long"


def _sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, position, total, n): component sums of the rows of each entry, added up in a task before the shuffle."""
    n_parts, n_entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(books.shape, np.int64), np.zeros((n_parts, n_entries), np.int64)
        for batch in sliced(batches):
            ints, code = _matrix(batch, "__ints").astype(float), _matrix(batch, "__code")
            for p in range(n_parts):
                counts[p] += np.bincount(code[:, p], minlength=n_entries)
                for i in range(width):
                    # Exact: a slice has too few rows for its sums to leave 53 bits.
                    added = np.bincount(code[:, p], weights=ints[:, p * width + i], minlength=n_entries)
                    totals[p, :, i] += added.astype(np.int64)
        part, entry, position = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, books.shape))
        columns = [pa.array(c, pa.int32()) for c in (part, entry, position)]
        columns += [pa.array(totals[part, entry, position]), pa.array(counts[part, entry])]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SUMS.split(", ")])

    parts = rows.select("__ints", "__code").mapInArrow(run, _SUMS)
    return parts.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def _moved_entries(books: np.ndarray, sums: list) -> np.ndarray:
    """New codebooks: component-wise floor of the mean; an entry without rows stays."""
    after = books.copy()
    for r in sums:
        after[r["part"], r["entry"], r["position"]] = r["total"] // r["n"]  # Python's floor goes down
    return after


def compress(
    rows: DataFrame, vector: str, order: str, keep: list[str],
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """Codes of the usable vectors and the codebooks they refer to.

    Returns the columns ``keep`` with ``codes`` (array of one 0-based entry per
    part) and ``error`` (long: squared distances summed over parts), written
    once. Codebooks start as the rows that come first by ``order``, then by
    component; a null there comes last, and a repeated row counts as often as it
    occurs. ``keep`` may not contain ``codes`` or ``error``.

    * A null vector, and one with a null or non-finite component, has no row.
    * Fewer usable rows than entries make smaller codebooks; no usable row makes
      empty codebooks and no rows.
    * Vectors of different lengths, of a length that ``parts`` does not divide, or
      with components whose squared distances need more than 62 bits (scaled ones
      beyond 2**27 with 64 of them) are refused with a ValueError, before any assignment.
    * Equal distances take the lowest index; repeated rows get equal codes.
    * Columns other than ``keep``, ``vector`` and ``order`` are not looked at.
    """
    if clash := {"codes", "error", "__ints", "__code", "__held", "__took"} & set(keep):
        raise ValueError(f"rename the columns {sorted(clash)}")
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    found = usable(rows, vector)
    size, high = F.size(vector), F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))
    low, top, largest = found.agg(F.min(size), F.max(size), F.max(high)).first()
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    schema += (", " if keep else "") + "__ints array<int>, __code array<int>, __held array<long>, __took long"
    if low is None:
        none = found.select(*keep, F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))
        return none.where("false"), Codebooks(np.zeros((parts, 0, 0), np.int64))
    if low != top or low % parts:
        raise ValueError(f"vectors have {low} to {top} components, not one multiple of {parts}")
    if 4 * ((largest or 0) * scale + 1) ** 2 * low >= _LARGEST:
        raise ValueError(f"a component of {largest} is too large for exact distances")
    width = low // parts
    seeds = found.select(F.col(order).alias("o"), ints.alias("v")).orderBy(F.asc_nulls_last("o"), "v").limit(entries).collect()
    books = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)

    table, moved, compared, before = found.select(*keep, ints.cast("array<int>").alias("__ints")), None, [], None
    for number in range(rounds + 1):
        path = new_path(rows.sparkSession, f"codes-{number}")
        table = written(_assigned(table, books, moved, schema, keep), path)
        if before:  # nothing reads the round before any more
            delete(rows.sparkSession, before)
        before = path
        took, n = table.agg(F.sum("__took"), F.count(F.lit(1))).first()
        compared.append((int(took), n * parts * books.shape[1]))
        if number < rounds:
            after = _moved_entries(books, _sums(table, books).collect())
            moved, books = (after != books).any(2), after
    held = F.aggregate("__held", F.lit(0).cast("long"), lambda total, d: total + d)
    return table.select(*keep, F.col("__code").alias("codes"), held.alias("error")), Codebooks(books, compared)


def with_group_error(codes: DataFrame, group: str, name: str) -> DataFrame:
    """The rows with the sum of ``error`` over all rows of the same ``group``, nulls together.

    Sums are made before anything is shuffled. They are broadcast where their
    count allows; otherwise the join is one that Spark can split at a hot group.
    """
    sums = codes.groupBy(F.col(group).alias("__group")).agg(F.sum("error").alias(name))
    sums, small = kept_small(sums, 48, "group-errors")
    sums = sums if small else shuffled_for_join(sums)
    joined = codes.join(sums, codes[group].eqNullSafe(sums["__group"]))
    return joined.select(*[codes[c] for c in codes.columns], sums[name])
