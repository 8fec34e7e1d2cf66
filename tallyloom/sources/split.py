"""Good rows and rejects of one pass over lines."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.storage import materialize


class Split(NamedTuple):
    """Rows that could be read, and ``(value, reason)`` of the lines that could not."""

    rows: DataFrame
    rejects: DataFrame


def split_by_reason(judged: DataFrame, reason: Column, columns: list[str], name: str) -> Split:
    """``judged`` has the line as ``value`` and what was read from it; ``reason`` is null where that is good.

    The lines are read and judged once, and written once, in a folder per
    reason: rows and rejects are folders of one table, so neither reads the
    other's. A good row keeps no line, a reject nothing but its line.
    """
    good = F.col("__reason").isNull()
    told = judged.withColumn("__reason", reason).select(
        *[F.when(good, F.col(c)).alias(c) for c in columns],
        F.when(~good, F.col("value")).alias("__line"),
        F.coalesce("__reason", F.lit("")).alias("__reason"),
        good.alias("__good"),
    )
    written = materialize(told, name, partition_by=("__good", "__reason"))
    return Split(
        written.where("__good").select(*columns),
        written.where("NOT __good").select(F.col("__line").alias("value"), F.col("__reason").alias("reason")),
    )
