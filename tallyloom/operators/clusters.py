"""Integer k-means over weighted points, and what the clusters hold."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tallyloom.functions.geometry import Point, distances, nearest, total_movement
from tallyloom.functions.tokens import LANGUAGES
from tallyloom.operators.postings import SPREAD
from tallyloom.operators.sampling import SEED, exact_sample, stratified_sample

# Cluster count, convergence bound and iteration bound; a spread
# below MIN_STRATIFIED_SPREAD samples the start without regard to language.
KERNELS = 45
ETA = 20.0
MAX_ITERATIONS = 120
MIN_STRATIFIED_SPREAD = 500

# The cluster report.
REPORT_LINE = "%7d  %-17s (%-5.1f%%)      %7d"


@dataclass(frozen=True)
class ClusterSettings:
    languages: Sequence[str] = LANGUAGES
    spread: int = SPREAD
    kernels: int = KERNELS
    eta: float = ETA
    max_iterations: int = MAX_ITERATIONS
    seed: int = SEED

    def __post_init__(self):
        if self.spread <= 0:
            raise ValueError("spread must be positive")
        if not self.languages or self.kernels < 1 or self.kernels % len(self.languages):
            raise ValueError("kernels must be a multiple of the number of languages")
        if self.max_iterations < 1:
            raise ValueError("max_iterations must be positive")

    @property
    def per_language(self) -> int:
        return self.kernels // len(self.languages)


def initial_means(vectors: DataFrame, settings: ClusterSettings = ClusterSettings()) -> list[Point]:
    """The ``kernels`` points to start from; an error if the data holds too few."""
    if settings.spread < MIN_STRATIFIED_SPREAD:
        sample = exact_sample(vectors, settings.kernels, settings.seed).collect()
    else:
        sample = sorted(
            stratified_sample(vectors, settings.per_language, settings.seed).collect(),
            key=lambda row: (row.x, row.rn),
        )
    if len(sample) != settings.kernels:
        raise ValueError(f"sampled {len(sample)} points where {settings.kernels} are needed")
    return [(row.x, row.y) for row in sample]


def weigh_points(vectors: DataFrame) -> DataFrame:
    """Distinct points ``(x, y, w)`` with their number of occurrences.

    Everything below works on these: sums of integers do not depend on how
    equal points are grouped, and their number is that of distinct scores
    rather than of questions.
    """
    return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))


def assign(points: DataFrame, means: Sequence[Point]) -> DataFrame:
    """Rows with the index of the nearest mean as ``cluster``; narrow."""
    return (
        points.withColumn("distances", distances("x", "y", means))
        .withColumn("cluster", nearest("distances"))
        .drop("distances")
    )


def average(points: DataFrame, means: Sequence[Point]) -> DataFrame:
    """Truncated integer mean ``(cluster, cx, cy)`` of each cluster that has points."""
    def mean(name: str):
        return F.expr(f"sum({name} * w) div sum(w)")

    return assign(points, means).groupBy("cluster").agg(mean("x").alias("cx"), mean("y").alias("cy"))


@dataclass(frozen=True)
class Clustering:
    """Means after the last iteration, and how it came to them (all of size k on the driver)."""

    means: list[Point]
    iterations: int
    distance: float
    converged: bool
    history: list[tuple] = field(default_factory=list)

    def means_frame(self, spark: SparkSession) -> DataFrame:
        return means_frame(spark, self.means)

    def history_frame(self, spark: SparkSession) -> DataFrame:
        """One row per iteration and mean, with the squared distance it moved."""
        return spark.createDataFrame(
            self.history,
            "iteration int, idx int, old_x bigint, old_y bigint, new_x bigint, new_y bigint, distance double",
        )


def means_frame(spark: SparkSession, means: Sequence[Point]) -> DataFrame:
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(means)], "idx int, cx bigint, cy bigint")


def move_means(points: DataFrame, means: Sequence[Point]) -> list[Point]:
    """Means after one iteration; an empty cluster keeps its old one."""
    moved = list(means)
    for row in average(points, means).collect():
        if row.cluster < 0:
            raise ValueError("a point has no coordinates")
        moved[row.cluster] = (row.cx, row.cy)
    return moved


def kmeans(
    points: DataFrame,
    means: Sequence[Point],
    eta: float = ETA,
    max_iterations: int = MAX_ITERATIONS,
) -> Clustering:
    """Lloyd's iterations over weighted points until the means move less than ``eta``.

    Ends with a warning, and ``converged`` false, at the bound of iterations.

    ``eta`` bounds the sum of squared distances. Each iteration is one job that
    shuffles and returns at most k partial sums per task. ``points`` should be
    read from storage (``plans.storage.materialize``), so that an executor
    lost on the way costs a re-read and no recomputation.
    """
    already_cached = points.storageLevel != StorageLevel.NONE
    if not already_cached:
        points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        old, history, iteration = list(means), [], 0
        while True:
            iteration += 1
            new = move_means(points, old)
            distance = total_movement(old, new)
            history += [
                (iteration, i, *before, *after, total_movement([before], [after]))
                for i, (before, after) in enumerate(zip(old, new))
            ]
            if distance < eta or iteration >= max_iterations:
                if distance >= eta:
                    warnings.warn(f"means still moved by {distance} after {iteration} iterations", stacklevel=2)
                return Clustering(new, iteration, distance, distance < eta, history)
            old = new
    finally:
        if not already_cached:
            points.unpersist()


# A 32-bit value is split into halves of this many bits.
HALF_BITS = 16


def exact_median(points: DataFrame, group: str, value: str, weight: str) -> DataFrame:
    """``(group, median)``: exact weighted median of an INT column, truncated to an integer.

    Works like a radix selection: a histogram over the upper 16 bits finds the
    bucket of each middle rank, and a histogram over the lower 16 bits of that
    bucket finds the value. Points are first summed by value, in each task and then
    over all, by group and value, so a group with most points is spread like its
    values; both histograms come from these sums, and no points are joined.
    """
    halves = points.select(
        group,
        F.shiftright(value, HALF_BITS).alias("upper"),
        F.col(value).bitwiseAND(2**HALF_BITS - 1).alias("lower"),
        F.col(weight).alias("weight"),
    ).groupBy(group, "upper", "lower").agg(F.sum("weight").alias("weight"))
    ascending = Window.partitionBy(group).orderBy("upper")
    coarse = halves.groupBy(group, "upper").agg(F.sum("weight").alias("weight")).select(
        group,
        "upper",
        "weight",
        (F.sum("weight").over(ascending) - F.col("weight")).alias("before"),
        F.sum("weight").over(Window.partitionBy(group)).alias("total"),
    )
    middles = F.array(F.expr("(total - 1) div 2"), F.expr("total div 2"))
    buckets = coarse.select(group, "upper", "weight", "before", F.posexplode(middles).alias("side", "rank"))
    buckets = buckets.where("before <= rank AND rank < before + weight").select(
        group, "upper", "side", (F.col("rank") - F.col("before")).alias("rank")
    )
    ascending = Window.partitionBy(group, "side").orderBy("lower")
    fine = (
        halves.join(buckets, [group, "upper"])
        .groupBy(group, "side", "rank", "upper", "lower")
        .agg(F.sum("weight").alias("weight"))
        .repartition(group)
        .withColumn("before", F.sum("weight").over(ascending) - F.col("weight"))
        .where("before <= rank AND rank < before + weight")
    )
    found = F.col("upper").cast("bigint") * 2**HALF_BITS + F.col("lower")
    return fine.groupBy(group).agg(F.sum(found).alias("both")).select(
        group, F.expr("cast(both div 2 AS int)").alias("median")
    )


def summarize_clusters(
    points: DataFrame, means: Sequence[Point], settings: ClusterSettings = ClusterSettings()
) -> DataFrame:
    """``(lang, pct_int, pct, size, median)`` of each cluster that has points, by median.

    The language is that of the most frequent x (the lowest on ties). ``pct`` is
    its share; ``pct_int`` is the share in whole hundreds, as integer division
    gives it: 100 for a pure cluster, otherwise 0.
    """
    assigned = assign(points, means)
    by_x = assigned.groupBy("cluster", "x").agg(F.sum("w").alias("w"))
    shares = by_x.groupBy("cluster").agg(
        F.max_by("x", F.struct("w", -F.col("x"))).alias("x"),
        F.max("w").alias("n"),
        F.sum("w").alias("size"),
    )
    names = F.array(*[F.lit(name) for name in settings.languages])
    position = F.expr(f"cast(x div {settings.spread} AS int)")
    return (
        shares.join(exact_median(assigned, "cluster", "y", "w"), "cluster")
        .select(
            "cluster",
            F.element_at(names, position + 1).alias("lang"),
            (F.expr("n div size") * 100).cast("double").alias("pct_int"),
            (F.col("n") * 100 / F.col("size")).alias("pct"),
            "size",
            "median",
        )
        .orderBy("median", "lang", "size", "cluster")
        .drop("cluster")
    )


def format_report(summary: DataFrame) -> DataFrame:
    """Cluster summary as report lines ``(position, line)``, numbered from 1 in the order of the summary.

    The numbers keep the order when the lines are written; they are given in one
    task, which has as many rows as there are clusters.
    """
    order = Window.orderBy("median", "lang", "size", "pct")
    return summary.select(
        F.row_number().over(order).alias("position"),
        F.format_string(REPORT_LINE, "median", "lang", "pct_int", "size").alias("line")
    )
