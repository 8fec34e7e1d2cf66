"""Nested groups ("bags") whose size stays bounded however hot a key is.

A first pass looks at digests and lengths only: it finds the keys that need
several bags, and the crowds of equal rows. With that each row knows its bag
before it moves, and is shuffled once, to where its bag is collected. Crowds are
counted in each task before. A bag's rows are found by a hash of the row, which
depends on the row alone, hence a task that is run again puts it into the same
bag. Bounds are those of a bag on average.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.layout import bucketed
from tallyloom.plans.storage import PARTITIONS, materialize, shuffled_into

BAG_SIZE = 10_000
# Bytes of the rows of a bag, so that one of long texts still fits into an array.
BAG_BYTES = 64 * 1024 * 1024
# Longest array made to number the bags of one key.
BLOCK = 4096
# Equal rows beyond this number are counted in each task before they are shuffled.
CROWD = 1_000


def profile(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``(key, digest, copies, bytes)`` of the distinct rows, by a digest of ``columns``; written once, no row is shuffled.

    Rows of equal digest count as equal here. That only decides how many bags a
    key gets and what is counted early, never what a bag holds.
    """
    item = F.struct(*columns)
    sizes = rows.select(key, F.xxhash64(item).alias("digest"), F.octet_length(item.cast("string")).cast("long").alias("bytes"))
    sizes = sizes.groupBy(key, "digest").agg(F.count(F.lit(1)).alias("copies"), F.max("bytes").alias("bytes"))
    return materialize(sizes, "profile")


def shuffled_size(*profiles: DataFrame) -> tuple[int, int]:
    """Rows and bytes that ``in_bags`` shuffles of the rows profiled, if each goes into one bag."""
    sent = F.least("copies", F.lit(CROWD))
    found = [profiled.agg(F.sum(sent), F.sum(sent * F.col("bytes"))).first() for profiled in profiles]
    return sum(rows or 0 for rows, _ in found), sum(size or 0 for _, size in found)


def in_bags(rows: DataFrame, profiled: DataFrame, key: Sequence[str], columns: Sequence[str], tasks: int) -> DataFrame:
    """Distinct ``(key..., columns...)`` with their ``copies``, lying together by ``key``: one shuffle of the rows.

    Members of a crowd are counted in each task first; only what is left of
    them is shuffled twice. Where the session has fewer than ``tasks`` partitions, the rows
    are written into so many buckets, so that a task that reads them holds a bounded share.
    """
    rows = rows.select(*key, *columns)
    crowds = profiled.where(F.col("copies") > CROWD).select(F.col("digest").alias("__crowd")).distinct()
    single = F.lit(1).cast("long").alias("copies")
    if crowds.isEmpty():
        counted = rows.select("*", single)
    else:
        marked = rows.join(crowds, F.xxhash64(F.struct(*columns)) == F.col("__crowd"), "left")
        alone = marked.where("__crowd IS NULL").drop("__crowd").select("*", single)
        counted = alone.unionByName(with_copies(marked.where("__crowd IS NOT NULL").drop("__crowd")))
    spark = rows.sparkSession
    if tasks > int(spark.conf.get(PARTITIONS)):
        with shuffled_into(spark, tasks):
            laid = bucketed(counted, "bags", list(key), tasks)
    else:
        laid = counted.repartition(*key)
    return laid.groupBy(*key, *columns).agg(F.sum("copies").alias("copies"))


def with_copies(rows: DataFrame) -> DataFrame:
    """Distinct rows, and how often each occurs; combined before the shuffle."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def bags_for(rows: Column, size: Column, bag_size: int, bag_bytes: int) -> Column:
    """Number of bags that so many rows of a key, of so many bytes in all, fill."""
    if bag_size < 1 or bag_bytes < 1:
        raise ValueError("bag_size and bag_bytes must be positive")
    return F.greatest(F.ceil(rows / bag_size), F.ceil(size / bag_bytes)).cast("bigint")


def bag_of(item: Column, bags: str) -> Column:
    return F.pmod(F.xxhash64(item), bags)


def in_every_bag(rows: DataFrame, bags: str, name: str) -> DataFrame:
    """Each row once per bag of its key, numbered from 0; in blocks, as there may be millions."""
    first = F.col("block") * BLOCK
    return (
        rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col(bags) - 1) / BLOCK))))
        .withColumn(name, F.explode(F.sequence(first, F.least(F.col(bags), first + BLOCK) - 1)))
        .drop("block")
    )
