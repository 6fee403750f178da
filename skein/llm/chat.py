"""Chat formatting of reply trees (operator 2), in DataFrame functions only.

A tree's nodes (tree, node, parent, role, text, score) are joined with themselves again and again,
each time doubling the distance to the ancestor a node knows; after log2(depth) joins every node
has its depth and the summed score of its path from the root. Leaves are ranked by that sum within
their tree; the same joins, run from the longest distance down, list the nodes of each chosen
root-to-leaf path, which is then formatted as one conversation.

Turns are written as <s>[INST]role[/INST]\\ntext</s>\\n; these control strings inside roles and texts
are escaped with ~, reversibly. loss holds the ranges of formatted (code points, end exclusive) that
are assistants' texts. Null roles and texts are empty. A node whose parent is missing is
a root; nodes of a cycle belong to no path and are left out. Ties go to the smaller node. A repeated
(tree, node) counts once. Without rows the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from .common import saved

BEGIN, HEAD, END = "<s>[INST]", "[/INST]\n", "</s>\n"
#: The escapes, the first of which is the escape character's own.
ESCAPES = [("~", "~0"), ("<s>", "~1"), ("</s>", "~2"), ("[INST]", "~3"), ("[/INST]", "~4")]


def escaped(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescaped(c: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def formatted_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), escaped(role), F.lit(HEAD), escaped(text), F.lit(END))


def masked(formatted: Column, loss: Column) -> Column:
    """The texts under a loss mask, unescaped, nothing between them."""
    return F.array_join(F.transform(loss, lambda r: unescaped(F.substr(formatted, r["start"] + 1, r["end"] - r["start"]))), "")


def parsed(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    parts = F.split(formatted, END, -1)
    body = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda t: F.substr(t, F.lit(len(BEGIN) + 1)))
    return F.transform(body, lambda t: F.struct(unescaped(F.substring_index(t, HEAD, 1)).alias("role"), unescaped(F.substr(t, F.length(F.substring_index(t, HEAD, 1)) + len(HEAD) + 1)).alias("text")))


def root_paths(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, depth, total) of every node with a root, and the tables (tree, node, up) by doubled distance."""
    parents = nodes.select("tree", F.col("node").alias("parent"), F.lit(1).alias("there"))
    now = nodes.select("tree", "node", "parent", "score").join(parents, ["tree", "parent"], "left")
    now = now.select("tree", "node", F.when(F.col("there") == 1, F.col("parent")).alias("up"), F.when(F.col("there") == 1, 1).otherwise(0).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).cast("double").alias("total"))
    now, jumps, left = saved(now, "jumps"), [], None
    while True:
        jumps.append(now.where("up is not null").select("tree", "node", "up"))
        more = jumps[-1].count()
        if more == 0 or more == left:  # whatever stays is a cycle
            break
        left = more
        above = now.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("total").alias("t2"))
        now = now.join(above, ["tree", "up"], "left").select("tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"), (F.col("total") + F.coalesce("t2", F.lit(0.0))).alias("total"))
        now = saved(now, "jumps")
    return now.where("up is null").drop("up"), jumps


def format_trees(nodes: DataFrame, paths: int = 1) -> DataFrame:
    """tree, leaf, rank, total, n_turns, loss, formatted: the paths best root-to-leaf paths of each tree."""
    nodes = nodes.dropDuplicates(["tree", "node"])
    known, jumps = root_paths(nodes)
    leaves = known.join(jumps[0].select("tree", F.col("up").alias("node")), ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.col("total").desc(), "node")
    chosen = saved(leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= paths).select("tree", F.col("node").alias("leaf"), "rank", "total"), "leaves")
    on = chosen.select("tree", "leaf", F.col("leaf").alias("node"))
    for jump in reversed(jumps[:-1]):
        on = saved(on.union(on.join(jump, ["tree", "node"]).select("tree", "leaf", "up")), "paths")
    turns = on.join(known.select("tree", "node", "depth"), ["tree", "node"]).join(nodes.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")), ["tree", "node"])
    turns = turns.withColumn("turn", formatted_turn(F.col("role"), F.col("text")))
    # where each turn ends, by a running sum over the rows that the grouping below needs together anyway
    turns = turns.withColumn("end", F.sum(F.length("turn")).over(Window.partitionBy("tree", "leaf").orderBy("depth", "node")).cast("int") - len(END))
    turns = turns.withColumn("start", F.col("end") - F.length(escaped(F.col("text"))))
    whole = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("depth", "node", "role", "turn", "start", "end"))).alias("turns"))
    whole = whole.join(chosen, ["tree", "leaf"])
    loss = F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return whole.select("tree", "leaf", "rank", "total", F.size("turns").cast("long").alias("n_turns"), loss.alias("loss"), F.array_join(F.col("turns.turn"), "").alias("formatted"))


def chain_nodes(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees: each row replies to the one before it, by turn, role, text."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = rows.select(F.col("conv_id").alias("tree"), "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.length(F.coalesce("text", F.lit(""))).cast("double").alias("score"))
