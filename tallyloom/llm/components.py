"""Connected components of a graph given as edges, in joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.storage import materialize


def components(edges: DataFrame) -> DataFrame | None:
    """(node, root): the smallest node of each node's component; None without edges.

    Each round hangs every node on its smallest neighbour, follows these pointers
    to their roots by doubling, and contracts the graph to the roots. A star of any
    size is one round; a hot node costs each task one partial minimum.
    """
    left = materialize(edges.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").where("a < b").distinct(), "edges")
    found = None
    while not left.isEmpty():
        both = left.unionByName(left.selectExpr("b AS a", "a AS b"))
        up = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root"))
        up = materialize(up, "roots")
        while True:
            next_ = up.selectExpr("node AS root", "root AS above")
            jumped = materialize(up.join(next_, "root").selectExpr("node", "above AS root", "root <> above AS moved"), "roots")
            up = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = up
        else:
            higher = up.selectExpr("node AS root", "root AS above")
            found = found.join(higher, "root", "left").selectExpr("node", "coalesce(above, root) AS root")
        ends = [up.selectExpr(f"node AS {x}", f"root AS {x}_root") for x in "ab"]
        contracted = left.join(ends[0], "a").join(ends[1], "b")
        contracted = contracted.selectExpr("least(a_root, b_root) AS a", "greatest(a_root, b_root) AS b")
        left = materialize(contracted.where("a < b").distinct(), "edges")
    return found if found is None else materialize(found, "components")
