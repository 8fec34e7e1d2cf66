"""Exact copies by progressive refinement: length, then a hash of the prefix, then of the whole text.

Only DataFrame functions. A row that is alone with its length, or with its
length and prefix, is settled without its text being hashed. What is shuffled
are lengths and hashes, counted in each task first, so a text that a third of
all rows repeat costs each task one row. Which rows go on to the next hash is asked
of a bitmap of the keys that several rows have: its size is bounded, so no text has
to move to be asked, whatever the number of keys. A bit that two keys set lets a row
go on in vain, and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import BROADCAST_BYTES, free_prefix
from tallyloom.plans.storage import materialize

PREFIX_CHARS = 128
#: Bits of a bitmap of shared keys. Spark makes rows of 4 KiB of them, so 32 MiB at most are broadcast.
BITMAP_BITS = 1 << 28
#: Bytes of a row with a full hash, as broadcast.
_GROUP_BYTES = 140


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS)) + 1


def _bitmap(keys: DataFrame, p: str) -> DataFrame:
    """(bucket, bits): the bits that the values of the only column set, in at most BITMAP_BITS / 32768 rows."""
    bit = _bit(F.col(keys.columns[0]))
    rows = keys.select(F.bitmap_bucket_number(bit).alias(f"{p}bucket"), F.bitmap_bit_position(bit).alias("at"))
    return F.broadcast(materialize(rows.groupBy(f"{p}bucket").agg(F.bitmap_construct_agg("at").alias(f"{p}bits")), "bitmap"))


def _marked(rows: DataFrame, key: str, shared: DataFrame, p: str, name: str) -> DataFrame:
    """The rows with a boolean: false where no key of ``shared`` is the row's."""
    bit = _bit(F.col(key))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(f"{p}bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    joined = rows.withColumn(f"{p}bucket", F.bitmap_bucket_number(bit)).join(_bitmap(shared, p), f"{p}bucket", "left")
    return joined.withColumn(name, found).drop(f"{p}bucket", f"{p}bits")


def _joined(docs: DataFrame, text: Column, prefix_chars: int, p: str) -> tuple[DataFrame, DataFrame]:
    """The rows with their hashes, and the groups of at least two equal texts."""
    length, prefix, full, more = (f"{p}{c}" for c in ("length", "prefix", "full", "more"))
    rows = docs.withColumn(length, F.octet_length(text))
    shared = rows.groupBy(length).count().where("count > 1").select(length)
    rows = _marked(rows, length, shared, p, more)
    rows = rows.withColumn(prefix, F.when(F.col(more), F.xxhash64(length, F.substring(text, 1, prefix_chars))))
    shared = rows.where(F.col(more)).groupBy(prefix).count().where("count > 1").select(prefix)
    rows = _marked(rows, prefix, shared, p, more)
    # Alone with its length or prefix: a key that no group has, different for each of these.
    alone = F.concat(F.lit("-"), F.coalesce(prefix, length).cast("string"))
    rows = rows.withColumn(full, F.when(F.col(more), F.sha2(text, 256)).otherwise(alone))
    by_id = rows.where(F.col(more)).groupBy(length, full, f"{p}id").agg(F.count(F.lit(1)).alias("n"))
    groups = by_id.groupBy(length, full).agg(
        F.sum("n").alias(f"{p}size"), F.max(F.struct(f"{p}id", "n")).alias(f"{p}keep")
    ).where(F.col(f"{p}size") > 1)
    return rows.drop(prefix, more), groups


def mark_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    normalise=None, prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """Every row with ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal when identical after ``normalise`` (a function of a column;
    none: no change). Of equal texts the row with the largest id stays.

    * A null text is the empty text; empty texts are copies of each other.
    * A null id is smaller than all others; a group of null ids keeps null.
    * Rows that share the text and the id that stays are all marked as kept: to
      this operator they are one document. ``drop_copies`` leaves one of them.
    * Other columns pass through; columns named as the three results are replaced.
    * An empty table gives an empty table.
    """
    marked, _, p = _mark(docs, id_column, text_column, normalise, prefix_chars)
    return marked.drop(f"{p}keepers", f"{p}full")


def _mark(docs, id_column, text_column, normalise, prefix_chars) -> tuple[DataFrame, DataFrame, str]:
    text = F.coalesce(F.col(text_column), F.lit(""))
    text = normalise(text) if normalise else text
    results, p = ("keep_id", "group_size", "kept"), free_prefix("__copy_", docs.columns)
    rows = docs.withColumn(f"{p}id", F.col(id_column))
    rows = rows.drop(*[c for c in results if c not in (id_column, text_column)])
    hashed, groups = _joined(rows, text, prefix_chars, p)
    groups = materialize(groups, "copies")
    found = F.broadcast(groups) if groups.count() * _GROUP_BYTES <= BROADCAST_BYTES else groups
    marked = hashed.join(found, [f"{p}length", f"{p}full"], "left").withColumns({
        "keep_id": F.when(F.col(f"{p}size").isNotNull(), F.col(f"{p}keep.{p}id")).otherwise(F.col(f"{p}id")),
        "group_size": F.coalesce(f"{p}size", F.lit(1).cast("long")),
        f"{p}keepers": F.coalesce(f"{p}keep.n", F.lit(1).cast("long")),
    }).withColumn("kept", F.col(f"{p}id").eqNullSafe(F.col("keep_id")))
    return marked.drop(f"{p}length", f"{p}size", f"{p}keep", f"{p}id"), groups, p


def drop_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    normalise=None, prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """The rows that stay, one of each text, with the columns they came with.

    Edge cases are those of ``mark_copies``; of rows that also share the id that
    stays, one is left.
    """
    marked, groups, p = _mark(docs, id_column, text_column, normalise, prefix_chars)
    kept = marked.where("kept")
    if groups.where(F.col(f"{p}keep.n") > 1).isEmpty():
        return kept.select(*docs.columns)
    single = kept.where(F.col(f"{p}keepers") == 1).select(*docs.columns)
    repeated = kept.where(F.col(f"{p}keepers") > 1).dropDuplicates([f"{p}full"]).select(*docs.columns)
    return single.unionByName(repeated)
