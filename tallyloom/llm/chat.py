"""Chat formatting from reply trees, in DataFrame functions only.

Paths are enumerated by self-joins that double the distance each time, over ids
and scores alone; texts join in once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.storage import materialize

# Fixed values of the template.
START, END, ASSISTANT = "<|im_start|>", "<|im_end|>\n", "assistant"


def escape(text: Column) -> Column:
    """Backslashes doubled, control strings broken by one: no ``<|`` is left, and ``unescape`` gives the text back."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As ``escape``, and a line break becomes two characters, as it ends the role."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    """The first marker stands for a backslash while the line breaks are put back."""
    hidden = F.replace(F.replace(role, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\-"))
    return F.replace(F.replace(hidden, F.lit("\\n"), F.lit("\n")), F.lit("\\-"), F.lit("\\"))


def best_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, branch, rank, score, node, depth): the nodes of each chosen root-to-leaf path.

    ``nodes`` has tree, node, parent and score, a node once. A branch is named by
    its leaf and scored by the mean of its nodes; ``branches`` best ones of each
    tree are taken, all if None; ties go to the smaller leaf.

    * A parent that is null or missing makes a root; a null score is 0.
    * Nodes that lead into a cycle have no root and give no path.
    """
    plain = nodes.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = plain.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    rooted = plain.join(known, plain.tree.eqNullSafe(known.t) & (plain.parent == known.p), "left")
    base = materialize(rooted.select(
        "tree", "node", F.col("p").alias("up"), F.when(F.col("p").isNotNull(), 1).otherwise(0).cast("long").alias("steps"), F.col("score").alias("total"),
    ), "paths")
    # Nodes whose pointer has reached a root are done; only the others are joined again.
    done, open_ = base.where("up IS NULL"), base.where("up IS NOT NULL")
    most, levels = base.count(), []
    while not open_.isEmpty() and 1 << len(levels) <= 2 * most:
        levels.append(open_)
        above = done.unionByName(open_).select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("total").alias("plus"))
        joined = open_.join(above, open_.tree.eqNullSafe(above.t) & (open_.up == above.n))
        moved = materialize(joined.select(
            "tree", "node", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("total") + F.col("plus")).alias("total"),
        ), "paths")
        done, open_ = done.unionByName(moved.where("up IS NULL")), moved.where("up IS NOT NULL")
    parents = rooted.where("p IS NOT NULL").select(F.col("tree").alias("t"), F.col("p").alias("n")).distinct()
    leaves = done.join(parents, done.tree.eqNullSafe(parents.t) & (done.node == parents.n), "left_anti")
    mean = (F.col("total") / (F.col("steps") + 1)).alias("score")
    leaves = leaves.select("tree", F.col("node").alias("branch"), F.col("steps").alias("length"), mean)
    if branches == 1:
        best = F.max_by(F.struct("branch", "length", "score"), F.struct("score", -F.col("branch"))).alias("b")
        chosen = leaves.groupBy("tree").agg(best).select("tree", "b.*", F.lit(1).alias("rank"))
    else:
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "branch"))
        chosen = leaves.withColumn("rank", rank)
        chosen = chosen if branches is None else chosen.where(F.col("rank") <= branches)
    # Written at each step: the plan of the next one would hold this one twice.
    members = materialize(chosen, "paths").withColumns({"node": F.col("branch"), "depth": F.col("length")})
    for k in reversed(range(len(levels))):
        up = levels[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        higher = members.join(up, members.tree.eqNullSafe(up.t) & (members.node == up.n))
        higher = higher.select("tree", "branch", "length", "score", "rank", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))
        members = materialize(members.select(*higher.columns).unionByName(higher), "paths")
    return members.select("tree", "branch", "rank", "score", "node", "depth")


def format_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, branch, rank, score, formatted, loss): each chosen path as one conversation.

    ``nodes`` has tree, node, parent, score, role and text. ``loss`` lists the
    spans (start, end) of assistant texts in the formatted string, in characters.

    * Null roles and texts are empty. Control strings and backslashes in them are escaped.
    * A conversation is one row, so as large as its texts together; trees are never brought together.
    * Other columns are not looked at. An empty table gives no rows.
    """
    header = F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    turns = nodes.select(
        F.col("tree").alias("t"), F.col("node").alias("n"), header.alias("header"),
        escape(F.coalesce("text", F.lit(""))).alias("body"), (F.col("role") == ASSISTANT).alias("learned"),
    )
    paths = best_paths(nodes, branches)
    rows = paths.join(turns, paths.tree.eqNullSafe(turns.t) & (paths.node == turns.n))
    turn = F.concat("header", "body", F.lit(END))
    so_far = Window.partitionBy("tree", "branch").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begin = F.sum(F.length(turn)).over(so_far) - F.length(turn) + F.length("header")
    rows = rows.select("tree", "branch", "rank", "score", "depth", turn.alias("turn"), "learned", begin.alias("begin"), (begin + F.length("body")).alias("end"))
    ordered = F.sort_array(F.collect_list(F.struct("depth", "turn", F.coalesce("learned", F.lit(False)).alias("learned"), "begin", "end")))
    grouped = rows.groupBy("tree", "branch", "rank", "score").agg(ordered.alias("turns"))
    learned = F.filter("turns", lambda t: t["learned"])
    return grouped.select(
        "tree", "branch", "rank", "score",
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.transform(learned, lambda t: F.struct(t["begin"].alias("start"), t["end"].alias("end"))).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        inner = F.substring(part, F.lit(len(START) + 1), F.length(part))
        role = F.substring_index(inner, "\n", 1)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substring(inner, F.length(role) + 2, F.length(inner))).alias("text"))

    return F.transform(parts, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def turns_as_trees(conversations: DataFrame) -> DataFrame:
    """Rows by turn as nodes: each turn answers the one before it; equal turn numbers follow each other by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    rows = conversations.select(F.col("conv_id").alias("tree"), node.alias("node"), "role", "text")
    return rows.withColumns({"parent": F.when(F.col("node") > 1, F.col("node") - 1), "score": F.lit(0.0)})
