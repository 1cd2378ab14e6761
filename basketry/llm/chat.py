"""Chat formatting of reply trees, with DataFrame operations only.

Messages form trees (``tree, node, parent``).  Ancestor tables that double
their reach are built by self-joins; they give each node its depth and path
score, and then expand each chosen leaf into its whole root-to-leaf path.
Branches are ranked by score per tree, and each chosen path becomes one
formatted conversation with a loss mask.

Template: ``<turn ROLE>TEXT</turn>`` and a newline per turn.  Inside a text
every ``<`` + backslashes + ``turn``/``/turn`` gets one more backslash, so no
text contains a marker and unescaping is exact.

Defined results: null text or role counts as empty; a null tree key is a tree
of its own, and a null node a message like any other, to which nothing replies;
a null parent, or one that is not in the tree, makes its child a root; of
messages with one key the smallest (parent, score) and the smallest (role,
text) hold; nodes on a parent cycle have
no root and are left out; an empty table gives no rows; other columns are
ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import written

OPEN, CLOSE = "<turn ", "</turn>\n"


def escape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)(/?turn)", r"<\\$1$2")


def unescape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)(/?turn)", r"<$1$2")


def _escape_role(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(c, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _unescape_role(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def parse_chat(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    pieces = F.filter(F.split(formatted, CLOSE), lambda p: p != "")

    def turn(p):
        end = F.instr(p, ">")
        return F.struct(_unescape_role(F.substr(p, F.lit(len(OPEN) + 1), end - F.lit(len(OPEN) + 1))).alias("role"),
                        unescape_text(F.substr(p, end + F.lit(1))).alias("text"))
    return F.transform(pieces, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and in order."""
    return F.concat_ws("", F.transform(
        spans, lambda s: unescape_text(F.substr(formatted, s["start"], s["length"]))))


def _keyed(messages: DataFrame) -> DataFrame:
    """Keys as structs, which are equal if both are null."""
    parent = F.col("parent").cast(messages.schema["node"].dataType)
    return messages.withColumns({"tree": F.struct(F.col("tree").alias("k")), "node": F.struct(F.col("node").alias("k")),
                                 "parent": F.when(parent.isNotNull(), F.struct(parent.alias("k")))})


def reply_paths(messages: DataFrame, top_k: int | None = 1) -> DataFrame:
    """Root-to-leaf paths: ``tree, leaf, branch_rank, branch_score, node, up``
    (``up``: steps from the leaf).  A branch scores the sum of its messages'
    scores (null: 0); the ``top_k`` best per tree are kept (None: all)."""
    keys = {c: F.col(f"{c}.k") for c in ("tree", "leaf", "node")}
    return _paths(_keyed(messages), top_k).withColumns(keys)


def _paths(messages: DataFrame, top_k: int | None) -> DataFrame:
    nodes = written(messages.groupBy("tree", "node")
                    .agg(F.min(F.struct("parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")))
                         .alias("m")).select("tree", "node", "m.parent", "m.score"), "chat-nodes")
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    level = written(nodes.join(known, ["tree", "parent"], "left")
                    .select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("up_node"),
                            F.col("score").alias("path")), "chat-up")
    jumps, rounds = [], max(1, nodes.count()).bit_length() + 1
    while True:
        # rows that still have an ancestor 2^k steps up go on; the others have their whole path
        going, done = level.filter("up_node is not null"), level.filter("up_node is null")
        if not going.head(1) or len(jumps) > rounds:
            break
        jumps.append(going.select("tree", "node", "up_node"))
        above = level.select("tree", F.col("node").alias("up_node"), F.col("up_node").alias("next"),
                             F.col("path").alias("more"))
        level = written(going.join(above, ["tree", "up_node"])
                        .select("tree", "node", F.col("next").alias("up_node"),
                                (F.col("path") + F.col("more")).alias("path")).union(done), "chat-up")
    leaves = (done.select("tree", "node", "path")
              .join(nodes.select("tree", F.col("parent").alias("node")), ["tree", "node"], "left_anti"))
    best = W.partitionBy("tree").orderBy(F.desc("path"), "node")
    leaves = leaves.withColumn("branch_rank", F.row_number().over(best))
    if top_k is not None:
        leaves = leaves.filter(F.col("branch_rank") <= top_k)
    paths = leaves.select("tree", F.col("node").alias("leaf"), "branch_rank", F.col("path").alias("branch_score"),
                          "node", F.lit(0).alias("up"))
    for k, jump in reversed(list(enumerate(jumps))):
        here = F.struct("node", "up")
        there = F.struct(F.col("up_node").alias("node"), (F.col("up") + F.lit(1 << k)).alias("up"))
        paths = (paths.join(jump, ["tree", "node"], "left")
                 .select("tree", "leaf", "branch_rank", "branch_score",
                         F.explode(F.when(F.col("up_node").isNull(), F.array(here))
                                   .otherwise(F.array(here, there))).alias("s"))
                 .select("tree", "leaf", "branch_rank", "branch_score", "s.node", "s.up"))
    return paths


def format_trees(messages: DataFrame, top_k: int | None = 1, loss_role: str = "assistant") -> DataFrame:
    """``messages(tree, node, parent, role, text, score)`` to one row per
    chosen path: ``tree, leaf, branch_rank, branch_score, n_turns, formatted,
    loss_spans`` (1-based start and length in code points of each text whose
    role is ``loss_role``, as escaped in ``formatted``)."""
    messages = _keyed(messages)
    texts = messages.groupBy("tree", "node").agg(F.min(F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("m"))
    texts = texts.select("tree", "node", "m.role", escape_text(F.col("m.text")).alias("body"),
                         F.concat(F.lit(OPEN), _escape_role(F.col("m.role")), F.lit(">")).alias("head"))
    size = F.length("head") + F.length("body") + F.lit(len(CLOSE))
    path = ["tree", "leaf"]
    order = W.partitionBy(*path).orderBy(F.desc("up"))
    turns = (_paths(messages, top_k).join(texts, ["tree", "node"])
             .withColumn("end", F.sum(size.cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0))))
    piece = F.struct(
        (-F.col("up")).alias("at"), F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
        F.when(F.col("role") == loss_role, F.struct(
            (F.col("end") - F.lit(len(CLOSE)) - F.length("body") + 1).cast("int").alias("start"),
            F.length("body").alias("length"))).alias("span"))
    rows = turns.groupBy(*path).agg(F.min("branch_rank").alias("branch_rank"),
                                    F.min("branch_score").alias("branch_score"),
                                    F.count("*").alias("n_turns"),
                                    F.array_sort(F.collect_list(piece)).alias("p"))
    return rows.select(*[F.col(f"{c}.k").alias(c) for c in path], "branch_rank", "branch_score", "n_turns",
                       F.concat_ws("", F.col("p.piece")).alias("formatted"),
                       F.filter(F.col("p.span"), lambda s: s.isNotNull()).alias("loss_spans"))


def threads(conversations: DataFrame) -> DataFrame:
    """Linear conversations as trees: each row answers the one before it (by
    turn, then role and text; null turns first)."""
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    rows = conversations.select(tree.alias("tree"), "turn", "role", "text")
    node = F.row_number().over(W.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    return (rows.withColumn("node", node)
                .select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                        "role", "text", F.lit(0.0).alias("score")))


def format_digest(formatted: DataFrame) -> DataFrame:
    """Contract columns of ``op1``, read back from the formatted output."""
    turns, masked = F.col("turns"), F.col("masked")
    joined = F.concat_ws("", F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return (formatted.withColumn("turns", parse_chat(F.col("formatted")))
            .withColumn("masked", masked_text(F.col("formatted"), F.col("loss_spans")))
            .select(F.when(F.col("tree") != "null", F.col("tree").cast("long")).alias("conv_id"),
                    F.size(turns).cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
                    F.length(masked).cast("long").alias("loss_chars"), F.sha2(masked, 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
