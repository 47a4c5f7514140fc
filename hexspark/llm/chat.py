"""Reply trees formatted as conversations, with DataFrame operations only.

A message points to the one it answers.  Iterative self-joins double the reach of every message's
ancestor pointer, so the number of rounds is the logarithm of the longest chain; they give each leaf
its root, its depth and the score of its branch.  Branches are ranked within their tree, and a second
run of doublings lists the messages of the chosen branches only.  Texts join last, once.

Template: each turn is ``### role: text</turn>`` and a line feed.  ``#``, ``<``, ``:`` (in roles) and
``\\`` inside roles and texts are written as ``\\h``, ``\\l``, ``\\c`` and ``\\b``, so no control string
can occur in them, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexspark.llm import common

OPEN, CLOSE = "### ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    # The escape character itself comes last: until then each one starts a code.
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def branch_table(messages: DataFrame) -> DataFrame:
    """One row per leaf: tree, leaf, root, depth (messages on the branch), score (sum over the branch).

    messages: tree, node, parent, score; node is unique.  A parent that is null or not among the nodes
    makes a root.  Messages on a cycle, and those that answer them, belong to no branch: after as many
    doublings as the number of messages has bits, every other message has reached its root.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    ids = nodes.select(F.col("node").alias("p"))
    nodes = nodes.join(ids, F.col("parent") == F.col("p"), "left").drop("parent").withColumnRenamed("p", "parent")
    nodes = common.stored(nodes, "nodes")
    parents = nodes.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    # reach: score and depth of the node and the ancestors before `up`; up is the next ancestor, null at a root.
    reach = nodes.select("tree", "node", F.col("parent").alias("up"), "score", F.lit(1).cast("long").alias("depth"), F.col("node").alias("top"))
    reach = common.stored(reach, "reach")
    for _ in range(reach.count().bit_length()):
        if reach.where("up is not null").isEmpty():
            break
        far = reach.select(F.col("node").alias("n2"), F.col("up").alias("up2"), F.col("score").alias("s2"), F.col("depth").alias("d2"), F.col("top").alias("t2"))
        # Only messages that have not reached their root are joined; every pointer has its row in far.
        further = reach.where("up is not null").join(far, F.col("up") == F.col("n2")).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("score") + F.col("s2")).alias("score"),
            (F.col("depth") + F.col("d2")).alias("depth"), F.col("t2").alias("top"),
        )
        reach = common.stored(reach.where("up is null").unionByName(further), "reach")
    leaves = reach.where("up is null").join(parents, "node", "left_anti")
    return leaves.select("tree", F.col("node").alias("leaf"), F.col("top").alias("root"), "depth", "score")


def chosen_branches(branches: DataFrame, per_root: int | None = 1) -> DataFrame:
    """The best branches of each root by score, then depth, then leaf id; None keeps all."""
    order = Window.partitionBy("root").orderBy(F.desc("score"), F.desc("depth"), "leaf")
    ranked = branches.withColumn("branch", F.row_number().over(order))
    return ranked if per_root is None else ranked.where(F.col("branch") <= per_root)


def branch_members(messages: DataFrame, branches: DataFrame) -> DataFrame:
    """root, branch, node, back (steps from the leaf) for every message of the given branches.

    Round k adds to each branch the ancestors 2^k to 2^(k+1)-1 steps from its leaf, by one self-join
    with the table of 2^k-step pointers; the rows made are the rows returned.
    """
    jump = messages.select("node", F.col("parent").alias("up")).where("up is not null")
    members = branches.select("root", "branch", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("back"), "depth")
    reach, longest = 1, branches.agg(F.max("depth")).first()[0] or 0
    while reach < longest:
        step = jump.select(F.col("node").alias("n2"), "up")
        more = members.where(F.col("back") + reach < F.col("depth")).join(step, F.col("node") == F.col("n2"))
        more = more.select("root", "branch", "leaf", F.col("up").alias("node"), (F.col("back") + reach).alias("back"), "depth")
        members = common.stored(members.unionByName(more), "members")
        far = jump.select(F.col("node").alias("n2"), F.col("up").alias("up2"))
        jump = common.stored(jump.join(far, F.col("up") == F.col("n2")).select("node", F.col("up2").alias("up")), "jump")
        reach *= 2
    return members.select("root", "branch", "node", "back", "depth")


def format_branches(messages: DataFrame, per_root: int | None = 1) -> DataFrame:
    """One row per chosen branch: tree, branch, score, formatted, loss_spans.

    messages: tree, node (unique), parent, score, role, text.  Null roles and texts count as empty.
    loss_spans lists the code point ranges [start, end) of formatted that hold assistant texts.
    A tree of cycles only gives no row; an empty table gives none.  Of branches of one score the deeper goes first, then that of the smaller leaf; texts
    of any length stay whole, a branch's together 2 GB at most.  Other columns are not read, whatever their names.
    """
    links = common.stored(messages.select("tree", "node", "parent", "score"), "links")
    branches = common.stored(chosen_branches(branch_table(links), per_root), "branches")
    members = branch_members(links, branches)
    texts = messages.select(
        F.col("node").alias("n2"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = members.join(texts, F.col("node") == F.col("n2")).select(
        "root", "branch",
        F.struct(
            (F.col("depth") - F.col("back")).alias("at"),
            (F.col("role") == "assistant").alias("own"),
            F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(": ")).alias("head"),
            escape(F.col("text")).alias("body"),
        ).alias("turn"),
    )
    done = turns.groupBy("root", "branch").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE)))
    # A running position per turn; each assistant body begins after its head.
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda a, t: F.struct(
            (a["pos"] + F.length(t["head"]) + F.length(t["body"]) + len(CLOSE)).alias("pos"),
            F.when(
                t["own"],
                F.concat(
                    a["spans"],
                    F.array(F.struct((a["pos"] + F.length(t["head"])).alias("start"), (a["pos"] + F.length(t["head"]) + F.length(t["body"])).alias("end"))),
                ),
            ).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    out = done.select("root", "branch", F.array_join(pieces, "").alias("formatted"), spans.alias("loss_spans"))
    back = branches.select(F.col("root").alias("r2"), F.col("branch").alias("b2"), "tree", "score")
    return out.join(back, (F.col("root") == F.col("r2")) & (F.col("branch") == F.col("b2"))).select("tree", "branch", "score", "formatted", "loss_spans")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, "</turn>\n"), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring(F.substring_index(p, ":", 1), F.lit(len(OPEN) + 1), F.length(p))).alias("role"),
            unescape(F.substring(p, F.length(F.substring_index(p, ":", 1)) + 3, F.length(p))).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), ""
    )


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Linear conversations as reply trees: each turn answers the one before it.

    Turns go by turn number (nulls first), then role and text; repeated rows are turns of their own.
    A null conv_id is a conversation like any other, and not that named "null".  The turns of one
    conversation are numbered in one task, and its text is one value, 2 GB at most.  Other columns are not read, whatever their names.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    key = F.concat(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")), F.lit("/"))
    rows = rows.withColumn("at", F.row_number().over(order))
    return rows.select(
        F.col("conv_id").alias("tree"),
        F.concat(key, F.col("at").cast("string")).alias("node"),
        F.when(F.col("at") > 1, F.concat(key, (F.col("at") - 1).cast("string"))).alias("parent"),
        F.lit(1.0).alias("score"), "role", "text",
    )
