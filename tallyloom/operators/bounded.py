"""The same k-means, comparing only those points with all means that may have changed their cluster.

Triangle-inequality bounds, kept for each point in a written table: the cluster the
point had when the table was written, and how far the second nearest mean was. While
the means have not drifted further than that leaves room for, one distance shows that
the point stays. Means, history and ties are those of ``clusters.kmeans``.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.geometry import Point, distances, nearest, total_movement
from tallyloom.operators.clusters import ETA, MAX_ITERATIONS, Clustering
from tallyloom.plans.storage import delete, new_path, written

#: Bounds are taken apart by this share, far above the rounding of doubles, so that a point
#: near a tie is compared with all means.
MARGIN = 1e-9
#: The bounds are written anew once so many comparisons of all points were made since.
RENEW_AFTER = 1.0


@dataclass(frozen=True)
class Work:
    """What one iteration cost, in rows of the points' table."""

    iteration: int
    points: int
    compared: int  # points that were compared with all means
    written: bool  # bounds were written in this iteration


@dataclass(frozen=True)
class BoundedClustering(Clustering):
    work: list[Work] = field(default_factory=list)

    def distances_computed(self) -> int:
        """All means for a compared point, one for any other."""
        return sum(w.compared * len(self.means) + w.points - w.compared for w in self.work)


def _list(values: Sequence[float]) -> str:
    return "array(" + ", ".join("double('Infinity')" if math.isinf(v) else f"{float(v)!r}D" for v in values) + ")"


#: The distance to the nearest mean but the own one; no other gives infinity.
_SECOND = """coalesce(sqrt(array_min(concat(
slice(distances, 1, greatest(cluster, 0)), slice(distances, cluster + 2, size(distances))))), double('Infinity'))"""


def anchored(points: DataFrame, means: Sequence[Point]) -> DataFrame:
    """``(x, y, w, cluster, second, compared)``: the nearest mean, and how far the nearest of the others is.

    A tie gives a ``second`` equal to the first; with one mean it is infinite. A point
    without coordinates has cluster -1. Every row is ``compared`` with all means.
    """
    return (
        points.select("x", "y", "w", distances("x", "y", means).alias("distances"))
        .withColumn("cluster", nearest("distances"))
        .withColumns({"second": F.expr(_SECOND), "compared": F.lit(True)})
        .drop("distances")
    )


def _room(anchors: Sequence[Point], means: Sequence[Point]) -> tuple[list[float], list[float]]:
    """By mean: the furthest that another one has drifted, and half the way to the nearest other one (k values each)."""
    drifts = [math.dist(a, m) for a, m in zip(anchors, means)]
    by_drift = sorted(range(len(means)), key=lambda i: -drifts[i])[:2]
    furthest = [max((drifts[j] for j in by_drift if j != i), default=0.0) for i in range(len(means))]
    halves = [min((math.dist(a, b) for j, b in enumerate(means) if j != i), default=math.inf) / 2 for i, a in enumerate(means)]
    return furthest, halves


def reassign(rows: DataFrame, anchors: Sequence[Point], means: Sequence[Point]) -> DataFrame:
    """Rows of ``anchored`` or of this function, whose bounds hold for ``anchors``, with those for ``means``.

    Narrow. A row keeps its cluster if its mean is nearer than the others can be: they were
    at least ``second`` away and came nearer by their drift at most, and none is nearer than
    the way between the means less the row's own distance. ``compared`` marks the other rows,
    for which all means were looked at; only they get an exact ``second``, the rest a lower bound.
    """
    furthest, halves = _room(anchors, means)

    def of_own(values: Sequence[float]) -> str:
        return f"element_at({_list(values)}, greatest(cluster, 0) + 1)"

    def apart(name: str, axis: int) -> str:
        return f"pow(cast({name} AS double) - {of_own([m[axis] for m in means])}, 2D)"

    less, more = f"{1 - MARGIN!r}D", f"{1 + MARGIN!r}D"
    bounds = rows.withColumns({
        "own": F.expr(f"sqrt({apart('x', 0)} + {apart('y', 1)}) * {more}"),
        "drifted": F.expr(f"second * {less} - {of_own(furthest)} * {more}"),
        "half": F.expr(f"{of_own(halves)} * {less}"),
    })
    # Without coordinates (cluster -1) ``own`` is null, and all means are looked at.
    settled = F.expr("cluster >= 0 AND own < greatest(drifted, half)")
    looked = bounds.withColumn("distances", F.when(settled, F.lit(None)).otherwise(distances("x", "y", means)))
    compared = F.col("distances").isNotNull()
    looked = looked.withColumn("cluster", F.when(compared, nearest("distances")).otherwise(F.col("cluster")))
    return looked.select(
        "x", "y", "w", "cluster",
        F.when(compared, F.expr(_SECOND)).otherwise(F.expr("greatest(drifted, 2 * half - own)")).alias("second"),
        compared.alias("compared"),
    )


def _move(rows: DataFrame, means: Sequence[Point]) -> tuple[list[Point], int, int]:
    """The means after one iteration, the rows and those compared, from one aggregate of k rows."""
    found = rows.groupBy("cluster").agg(
        F.expr("sum(x * w) div sum(w)").alias("cx"),
        F.expr("sum(y * w) div sum(w)").alias("cy"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if("compared").alias("compared"),
    ).collect()
    moved = list(means)
    for row in found:
        if row.cluster < 0:
            raise ValueError("a point has no coordinates")
        moved[row.cluster] = (row.cx, row.cy)
    return moved, sum(r.rows for r in found), sum(r.compared for r in found)


def kmeans(
    points: DataFrame,
    means: Sequence[Point],
    eta: float = ETA,
    max_iterations: int = MAX_ITERATIONS,
    renew_after: float = RENEW_AFTER,
) -> BoundedClustering:
    """``clusters.kmeans`` with bounds: equal means, history and end, fewer distances.

    The bounds lie in a table in the shared folder, so a lost executor costs a re-read. It is
    written for the first means, and again in the iteration after the rows compared since are
    ``renew_after`` times all rows; the table before is deleted then. Each iteration is one
    aggregate that returns k rows.
    """
    spark = points.sparkSession
    old, anchors, path, rows = list(means), list(means), None, None
    history, work, since = [], [], 0
    try:
        while True:
            iteration = len(work) + 1
            found = reassign(rows, anchors, old) if rows is not None else anchored(points, old)
            write = rows is None or since >= renew_after * work[-1].points
            if write:
                before, path = path, new_path(spark, "bounds")
                found = rows = written(found, path)
                anchors, since = old, 0
                if before:
                    delete(spark, before)
            new, count, compared = _move(found, old)
            since += 0 if write else compared
            work.append(Work(iteration, count, compared, write))
            distance = total_movement(old, new)
            history += [
                (iteration, i, *a, *b, total_movement([a], [b])) for i, (a, b) in enumerate(zip(old, new))
            ]
            if distance < eta or iteration >= max_iterations:
                if distance >= eta:
                    warnings.warn(f"means still moved by {distance} after {iteration} iterations", stacklevel=2)
                return BoundedClustering(new, iteration, distance, distance < eta, history, work)
            old = new
    finally:
        if path:
            delete(spark, path)
