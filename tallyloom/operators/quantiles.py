"""Exact quantiles of numbers of any type, several at once, without sorting the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.storage import materialize

# Relative error of the sketch is one in so many; the bracket of a quantile is twice as wide on either side.
ACCURACY = 2_000


def exact_quantiles(
    rows: DataFrame, group: str, value: str, fractions: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """``(group, fraction, quantile, n)``: the least value that at least this fraction of the group's values do not exceed.

    A mergeable sketch brackets each quantile; then one pass counts the values below
    the bracket and those in it by value, which gives the exact one. Only sketches, counts and the
    values in brackets are shuffled, some thousandths of the rows. A bracket
    that misses its quantile is opened to all values, so the result is exact however good the sketch is.

    Nulls don't count; a group without values has no row, a null group is one of its own. NaN is greater than all numbers. The type of the
    values is kept.
    """
    fractions = [float(f) for f in fractions]
    if not fractions or not all(0 <= f <= 1 for f in fractions) or len(set(fractions)) < len(fractions):
        raise ValueError("fractions must be different numbers from 0 to 1")
    known = rows.select(F.col(group).alias("g"), F.col(value).alias("v")).where("v IS NOT NULL")
    margin = 2 / accuracy
    edges = [e for f in fractions for e in (max(0.0, f - margin), min(1.0, f + margin))]
    sketch = known.groupBy("g").agg(F.percentile_approx("v", edges, accuracy).alias("e"), F.count(F.lit(1)).alias("n"))
    ranks = [(i, f) for i, f in enumerate(fractions)]
    # The 0-based place of a quantile among the sorted values.
    place = F.greatest(F.ceil(F.col("n") * F.col("fraction")) - 1, F.lit(0)).cast("long")
    wanted = F.explode(F.array(*[
        F.struct(F.lit(f).alias("fraction"), F.col("e")[2 * i].alias("low"), F.col("e")[2 * i + 1].alias("high")) for i, f in ranks
    ]))
    brackets = materialize(
        sketch.select("g", "n", wanted.alias("w")).select("g", "n", "w.*").withColumn("place", place), "quantile-brackets"
    )
    exact = _select(known, brackets)
    missed = brackets.join(exact, brackets["g"].eqNullSafe(exact["h"]) & (brackets["fraction"] == exact["f"]), "left_anti")
    missed = materialize(missed, "quantile-missed")
    if not missed.isEmpty():
        ends = known.groupBy(F.col("g").alias("k")).agg(F.min("v").alias("low"), F.max("v").alias("high"))
        opened = missed.drop("low", "high").join(ends, F.col("g").eqNullSafe(F.col("k"))).drop("k")
        exact = exact.unionByName(_select(known, materialize(opened.select(*brackets.columns), "quantile-opened")))
    return exact.select(F.col("h").alias(group), F.col("f").alias("fraction"), "quantile", "n")


def _select(known: DataFrame, brackets: DataFrame) -> DataFrame:
    """``(h, f, quantile, n)`` for the brackets that hold their place."""
    asked = brackets.groupBy(F.col("g").alias("h")).agg(F.collect_list(F.struct("fraction", "low", "high", "place", "n")).alias("b"))
    asked = materialize(asked, "quantile-asked")  # one row a group, as long as the fractions asked for
    near = known.join(asked, known["g"].eqNullSafe(asked["h"])).select("h", "v", F.explode("b").alias("b"))
    near = near.where(F.col("v") <= F.col("b.high"))
    # All values below a bracket are one count.
    inside = F.when(F.col("v") >= F.col("b.low"), F.col("v"))
    counts = near.groupBy("h", F.col("b.fraction").alias("f"), F.col("b.place").alias("place"), F.col("b.n").alias("n"), inside.alias("quantile")).agg(
        F.count(F.lit(1)).alias("c")
    )
    upto = F.sum("c").over(Window.partitionBy("h", "f").orderBy(F.asc_nulls_first("quantile")))
    counts = counts.select("*", upto.alias("upto"))
    right = "quantile IS NOT NULL AND upto > place AND upto - c <= place"
    return materialize(counts.where(right).select("h", "f", "quantile", "n"), "quantiles")
