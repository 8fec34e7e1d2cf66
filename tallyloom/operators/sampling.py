"""Repeatable samples of points, without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.storage import materialize

SEED = 42
# Hexadecimal digits of the order that are counted at a time: 4096 counts per x.
DIGITS = 3
ALL_DIGITS = 32
# Points beyond the sample of an x that are sorted along with it rather than counted once more.
SLACK = 1_000
# Follows every digest.
END = "g"


def sample_order(seed: int = SEED) -> Column:
    """A random but repeatable order of points, by a digest of seed and question id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col("qid").cast("string")))


def exact_sample(vectors: DataFrame, size: int, seed: int = SEED) -> DataFrame:
    """``size`` points from all of them (fewer if there are not as many)."""
    return vectors.orderBy(sample_order(seed), "x", "y").limit(size)


def stratified_sample(vectors: DataFrame, per_stratum: int, seed: int = SEED) -> DataFrame:
    """``per_stratum`` points for each x, with their place ``rn`` in the sample.

    Counts of the first digits of the order, which add up over tasks, say for
    each x up to which digits its sample reaches. Only points up to there are shuffled and sorted: the sample
    and at most ``SLACK`` or as many again, and those whose id is that of the last.
    """
    if per_stratum < 1:
        raise ValueError("per_stratum must be positive")
    placed = vectors.withColumn("__at", sample_order(seed))
    reach = _reach(placed, per_stratum)
    within = F.substring("__at", 1, F.length("__last")) <= F.col("__last")
    few = placed.join(reach, placed["x"].eqNullSafe(reach["__x"])).where(within)
    first = Window.partitionBy("x").orderBy("__at", "y")
    numbered = few.select(*vectors.columns, "__at").withColumn("rn", F.row_number().over(first))
    return numbered.where(F.col("rn") <= per_stratum).drop("__at")


def _reach(placed: DataFrame, per_stratum: int) -> DataFrame:
    """``(__x, __last)``: the digits with which the order of the last sampled point of each x begins; ``END`` where all points are sampled.

    Each round counts the next digits, of the points that begin like the last
    one, for every x where these are still too many.
    """
    done, digits = None, DIGITS
    points = placed.select(F.col("x").alias("__x"), "__at")
    found = points.select("__x", F.lit("").alias("begin"), F.lit(per_stratum).cast("long").alias("need"), F.substring("__at", 1, DIGITS).alias("next"))
    while True:
        counts = found.groupBy("__x", "begin", "need", "next").agg(F.count(F.lit(1)).alias("n"))
        ahead = F.sum("n").over(Window.partitionBy("__x").orderBy("next")) - F.col("n")
        total = F.sum("n").over(Window.partitionBy("__x"))
        counts = counts.select("*", ahead.alias("ahead"), total.alias("total"))
        whole = F.col("total") < F.col("need")
        at = (~whole & (F.col("ahead") < F.col("need")) & (F.col("ahead") + F.col("n") >= F.col("need"))) | (whole & (F.col("ahead") == 0))
        last = F.when(whole, F.lit(END)).otherwise(F.concat("begin", "next"))
        left = (F.col("need") - F.col("ahead")).alias("need")
        wide = ~whole & (F.col("n") > F.col("need") + SLACK)
        reached = materialize(counts.where(at).select("__x", last.alias("__last"), left, wide.alias("wide")), "sample-reach")
        open_ = reached.where("wide")
        finished = digits >= ALL_DIGITS or open_.isEmpty()
        closed = (reached if finished else reached.where("NOT wide")).select("__x", "__last")
        done = closed if done is None else done.unionByName(closed)
        if finished:
            return done
        open_ = open_.select(F.col("__x").alias("o"), F.col("__last").alias("begin"), "need")
        deeper = points.join(open_, F.col("__x").eqNullSafe(F.col("o"))).where(F.startswith("__at", "begin"))
        found = deeper.select("__x", "begin", "need", F.substring("__at", digits + 1, DIGITS).alias("next"))
        digits += DIGITS
