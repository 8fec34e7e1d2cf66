"""Tables laid out so that joins by their key need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tallyloom.plans import storage


def bucketed(rows: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """The rows written once into ``buckets`` sorted files by a hash of ``keys``, as a table of the session.

    One file a bucket, as the rows are dealt out as the buckets are. Joins and
    groupings by all of ``keys`` with tables of the same number of buckets read
    them side by side. The files lie in the shared folder; the table's name
    is forgotten with the session or the scope, whichever ends first.
    """
    if buckets < 1:
        raise ValueError("at least one bucket is needed")
    spark = rows.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = storage.new_path(spark, name)
    writer = rows.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(table)
    storage.at_end(spark, f"DROP TABLE IF EXISTS {table}")
    return spark.table(table)
