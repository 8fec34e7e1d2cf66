"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.storage import materialize

#: A table is broadcast on request only up to this many bytes; past it, joins shuffle.
BROADCAST_BYTES = 32 << 20


def text_of(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def id_remainder(modulus: int, name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % modulus


def free_prefix(prefix: str, columns: list[str]) -> str:
    """The prefix, longer until no column's name begins with it."""
    while any(c.lower().startswith(prefix.lower()) for c in columns):
        prefix += "_"
    return prefix


def kept_small(df: DataFrame, row_bytes: int, name: str) -> tuple[DataFrame, bool]:
    """The rows, written once, and whether they are few enough to broadcast (then hinted so)."""
    written = materialize(df, name)
    if written.count() * row_bytes <= BROADCAST_BYTES:
        return F.broadcast(written), True
    return written, False


#: Rows of an Arrow batch that are taken up at a time, so that only their texts are Python objects.
SLICE = 1024


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE):
            yield batch.slice(begin, SLICE)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str) -> DataFrame:
    """Each Arrow batch through a function that ``make`` sets up once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in sliced(batches):
            if (out := step(batch)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority_labels(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label): one row per labelled document; of contradicting labels the mean decides, 1 in a tie."""
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg((F.avg(column) >= 0.5).cast("int").alias("label"))


def sampled_texts(docs: DataFrame, labels: DataFrame, bound: int, seed: int = 7) -> list[tuple[str, object]]:
    """(text, label) of at most ``bound`` labelled documents, drawn by a hash of the id.

    Only the drawn ids, bounded by the parameter, are broadcast; no text is shuffled.
    """
    drawn = labels.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(bound)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(drawn), "doc_id")
    rows = rows.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "text").limit(bound).collect()
    return [(r["text"], r["label"]) for r in rows]
