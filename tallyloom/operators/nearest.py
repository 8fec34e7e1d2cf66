"""The nearest of very many centres, by a table of grid cells.

The plane is cut into square cells, coarse ones first, and only those that hold
points are looked at. A cell keeps the centres that can be nearest to a point in it:
one whose least distance to the cell is greater than another's greatest distance
cannot. Cells with few centres left are finished; the others are cut further. So the index
adapts to where points and centres are dense, and nothing in a plan grows with
the number of centres.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.storage import delete, materialize, new_path, written

# A cell with no more centres than this is not cut further.
LEAF = 64
# Bits by which the side of a cell shrinks at a time: a cell has 16 parts.
STEP = 2
# Bytes in memory of a row of cells, and of each centre in a list.
CELL_BYTES, CENTER_BYTES = 112, 40


class CenterIndex(NamedTuple):
    """``cells`` ``(shift, u, v, centers)``: cell (u, v) of side 2**shift from the origin, and its centres.

    It serves points in the cells that the points it was made for lie in. ``size``
    is the memory that the cells take, in bytes.
    """

    cells: DataFrame
    origin: tuple[int, int]
    shifts: list[int]
    size: int


def _side(rows: DataFrame, size: int) -> DataFrame:
    """The side of a join, broadcast if its bytes in memory are within the session's limit, or else shuffled.

    Left alone, Spark takes the length of the files for the size of a table: encoded
    cells and lists of centres are tens of times as large in the driver that broadcasts them.
    """
    limit = rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(rows) if size <= limit else rows.hint("merge")


def _cell(shift: int, origin: tuple[int, int]) -> list[Column]:
    return [
        F.shiftright(F.col(name).cast("long") - low, shift).alias(at) for name, low, at in zip("xy", origin, "uv")
    ]


def _reach(shift: int, origin: tuple[int, int]) -> tuple[Column, Column]:
    """Least and greatest squared distance from a centre to the integer points of its cell.

    Doubles, as all distances here are: rounding keeps the order of what is
    certainly nearer, so pruning by these agrees with comparing the distances.
    """
    least, greatest = [], []
    for name, low, at in zip(("cx", "cy"), origin, "uv"):
        first = F.shiftleft(F.col(at), shift) + low
        before, after = first - F.col(name), F.col(name) - (first + ((1 << shift) - 1))
        nearest = F.greatest(before, after, F.lit(0).cast("long")).cast("double")
        furthest = F.greatest(F.abs(before), F.abs(after)).cast("double")
        least.append(nearest * nearest)
        greatest.append(furthest * furthest)
    return least[0] + least[1], greatest[0] + greatest[1]


def _cells(wide: DataFrame, parts: DataFrame, size: int, shift: int, origin: tuple[int, int]) -> DataFrame:
    """The cells ``parts`` ``(u, v, u0, v0)``, of so many bytes, with their ``bound``, and the number ``n`` of centres that can be nearest there.

    ``wide`` are the centres ``(u0, v0, idx, cx, cy)`` of the cells that are cut. Each meets all
    parts of its cell, but that is only summed up within the join's tasks: no such row is shuffled or written.
    """
    least, greatest = _reach(shift, origin)
    bounds = wide.join(_side(parts, size), ["u0", "v0"]).groupBy("u", "v").agg(F.min(greatest).alias("bound"))
    whole = [F.shiftright(at, STEP).alias(f"{at}0") for at in "uv"]
    bounds = materialize(bounds.select("u", "v", *whole, "bound"), "cell-bounds")
    sizes = wide.join(_side(bounds, size), ["u0", "v0"]).where(least <= F.col("bound")).groupBy("u", "v", "bound").agg(F.count(F.lit(1)).alias("n"))
    return materialize(sizes.select("u", "v", *whole, "bound", "n"), "sizes")


def _pruned(wide: DataFrame, cells: DataFrame, size: int, shift: int, origin: tuple[int, int]) -> DataFrame:
    """Rows ``(u, v, idx, cx, cy)`` of the centres that can be nearest in one of ``cells``, which take so many bytes."""
    least, _ = _reach(shift, origin)
    return wide.join(_side(cells.drop("n"), size), ["u0", "v0"]).where(least <= F.col("bound")).select("u", "v", "idx", "cx", "cy")


def index_centers(centers: DataFrame, points: DataFrame, leaf: int = LEAF) -> CenterIndex:
    """The cells in which ``points`` ``(x, y)`` lie, each with the ``centers`` ``(idx, cx, cy)`` that matter there.

    Of centres at one place only the lowest index can be nearest. A ValueError if there are no centres,
    or one has no index or place.
    """
    long = [F.col(c).cast("long").alias(c) for c in ("idx", "cx", "cy")]
    placed = centers.select(*long).groupBy("cx", "cy").agg(F.min("idx").alias("idx"), F.count("idx").alias("n"), F.count(F.lit(1)).alias("rows"))
    placed = materialize(placed, "centers")
    checked = placed.agg(F.count(F.lit(1)), F.count_if(F.expr("n < rows OR cx IS NULL OR cy IS NULL"))).first()
    if checked[0] == 0 or checked[1] > 0:
        raise ValueError("at least one centre is needed, and each needs an index and a place")
    spots = materialize(points.select("x", "y").where("x IS NOT NULL AND y IS NOT NULL").distinct(), "spots")
    low_x, high_x, low_y, high_y = spots.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if low_x is None:
        low_x, high_x, low_y, high_y = 0, 0, 0, 0
    origin = (int(low_x), int(low_y))
    span = max(int(high_x) - origin[0], int(high_y) - origin[1])
    shift = -(-span.bit_length() // STEP) * STEP
    spark, zero = points.sparkSession, F.lit(0).cast("long")
    wide, path = placed.select(zero.alias("u0"), zero.alias("v0"), "idx", "cx", "cy"), None
    parts, n_parts = spark.range(1).select(*[zero.alias(at) for at in ("u", "v", "u0", "v0")]), 1
    folder, shifts, size = new_path(spark, "center-index"), [], 0
    while True:
        shifts.append(shift)
        cells = _cells(wide, parts, n_parts * CELL_BYTES, shift, origin)
        fits = F.expr(f"n <= {leaf}" if shift else "true")
        few, many = cells.where(fits), cells.where(~fits)
        n_few, n_many, listed = cells.agg(F.count_if(fits), F.count_if(~fits), F.sum(F.when(fits, F.col("n")))).first()
        last = n_many == 0
        if last or n_few:
            size += n_few * CELL_BYTES + (listed or 0 if shift else n_few) * CENTER_BYTES
            found = _pruned(wide, few, n_few * CELL_BYTES, shift, origin).groupBy("u", "v")
            lists = F.collect_list(F.struct("cx", "cy", "idx"))
            if shift == 0:  # one point: all that are left are as near
                best = F.min(F.struct("idx", "cx", "cy"))
                lists = F.array(F.struct(*[best[c].alias(c) for c in ("cx", "cy", "idx")]))
            written(found.agg(lists.alias("centers")), f"{folder}/shift={shift}")
        if last:
            break
        here = new_path(spark, "cells")
        kept = written(_pruned(wide, many, n_many * CELL_BYTES, shift, origin).select(F.col("u").alias("u0"), F.col("v").alias("v0"), "idx", "cx", "cy"), here)
        if path:
            delete(spark, path)  # nothing reads it again
        wide, path = kept, here
        shift -= STEP
        parts = spots.select(*_cell(shift, origin)).distinct().select(
            "u", "v", *[F.shiftright(at, STEP).alias(f"{at}0") for at in "uv"]
        )
        whole = _side(many.select(F.col("u").alias("u0"), F.col("v").alias("v0")), n_many * CELL_BYTES)
        parts = materialize(parts.join(whole, ["u0", "v0"]), "parts")
        n_parts = parts.count()
    if path:
        delete(spark, path)
    index = spark.read.schema("u long, v long, centers array<struct<cx:long,cy:long,idx:long>>, shift int").parquet(folder)
    return CenterIndex(index.select("shift", "u", "v", "centers"), origin, shifts, size)


def assign_nearest(points: DataFrame, index: CenterIndex) -> DataFrame:
    """The rows with the index of the nearest centre as ``cluster``; the lowest wins ties, and no place gives -1.

    A point looks for its cell among those of each size, of which one has it. The
    cells are broadcast where their size in memory allows.
    """
    cells = [F.struct(F.lit(shift).alias("shift"), *_cell(shift, index.origin)) for shift in index.shifts]
    looked = points.where("x IS NOT NULL AND y IS NOT NULL").withColumn("__cell", F.explode(F.array(*cells)))
    centers = index.cells.select(F.struct("shift", "u", "v").alias("__cell"), F.col("centers").alias("__centers"))

    def distance(c: Column) -> Column:
        dx, dy = (F.col(p).cast("double") - c[q].cast("double") for p, q in (("x", "cx"), ("y", "cy")))
        return F.struct((dx * dx + dy * dy).alias("d"), c["idx"].alias("i"))

    best = F.array_min(F.transform("__centers", distance))["i"]
    assigned = looked.join(_side(centers, index.size), "__cell").select(*points.columns, best.alias("cluster"))
    nowhere = points.where("x IS NULL OR y IS NULL").select(*points.columns, F.lit(-1).cast("long").alias("cluster"))
    return assigned.unionByName(nowhere)
