"""Help Spark to split hot keys at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame


def shuffled_for_join(rows: DataFrame) -> DataFrame:
    """Aggregated rows that do not bring their partitioning along into a join.

    Spark splits a hot key only in a join for which it shuffles both sides. A
    side that has just been grouped by the key lacks that shuffle, and the whole
    key goes through one task, so a second shuffle of its narrow rows pays off.
    """
    return rows.repartition(*rows.columns)
