"""Prefix trie of conversations over minimal-perfect-hash node tables.

Every turn has a 120-bit digest (SHA-256 of its role and text).  A prefix's key
is a hash of the sum of its turns' hashes, each taken with its place, so keys
come from running sums in blocks of turns and a very long conversation is not
walked by one task.  Equal conversations are one path with a count.

The trie is cut into pieces: nodes with more than ``PIECE`` path rows at or
below them form the crown, and every subtree that hangs from the crown is a
piece; pieces are dealt to shards of a bounded number of nodes.  In a shard
the distinct prefix keys get slots of a minimal perfect hash; each slot keeps
its key, and a look-up counts only if that key agrees.  Counts are scattered
into flat numpy arrays by slot, and leaves and savings are added up through
the array of parent slots, deepest level first.  Sums of the pieces' tops go
to the crown, which is cut into pieces again until nothing is left but the
root.  A crown that is one long chain takes a round per ``PIECE`` nodes.

All rows of a node must agree in depth, parent key and turn digest; by
induction the whole prefixes agree then.  If not, two prefixes share a key and
the query fails.

Defined results: null roles and texts are empty; rows without a conversation
id belong to no conversation and are left out; rows with the same turn number
(null first) follow the order of their digests; repeated rows are turns of
their own; an empty table gives no rows, not even a root; other columns are
ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import numbered, written

PIECE = 1 << 16
SHARD = 1 << 16
BLOCK = 4096
LANES = 4
#: Lane values are under 2^31, so the sums of 2^32 turns fit a long.
LANE_BITS = 31
HEADS = 3
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()
KEY = ["k1", "k2"]


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys: levels of bit arrays in
    which a key takes the first place that it has to itself; its slot is the
    number of places taken before.  ``find`` verifies the slot's own key."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.levels, self.n = [], len(k1)
        self.slot1, self.slot2 = np.empty_like(k1), np.empty_like(k2)
        left, taken = np.arange(len(k1)), 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("keys are not distinct")
            size = max(64, 2 * len(left))
            at = self._place(k1[left], k2[left], size, len(self.levels))
            alone = np.bincount(at, minlength=size) == 1
            slot = taken + np.cumsum(alone) - 1
            mine = alone[at]
            self.slot1[slot[at[mine]]], self.slot2[slot[at[mine]]] = k1[left[mine]], k2[left[mine]]
            self.levels.append((alone, slot))
            taken += int(mine.sum())
            left = left[~mine]

    @staticmethod
    def _place(k1: np.ndarray, k2: np.ndarray, size: int, level: int) -> np.ndarray:
        x = k1.view(np.uint64) + (k2.view(np.uint64) ^ np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(mult)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 for keys that are not in the table."""
        out, left = np.full(len(k1), -1), np.arange(len(k1))
        for level, (alone, slot) in enumerate(self.levels):
            at = self._place(k1[left], k2[left], len(alone), level)
            hit = alone[at]
            out[left[hit]] = slot[at[hit]]
            left = left[~hit]
        known = out >= 0
        known[known] = (self.slot1[out[known]] == k1[known]) & (self.slot2[out[known]] == k2[known])
        return np.where(known, out, -1)


# ---------------------------------------------------------------------------
# Rebuilt conversations and their prefix keys
# ---------------------------------------------------------------------------

def turn_digests(conversations: DataFrame) -> DataFrame:
    """``conv, turn, t1, t2, words``: two 60-bit halves of a turn's digest, and
    the words of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring("sha", at, 15), 16, 10).cast("long")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", sha.alias("sha"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return rows.select("conv", "turn", half(1).alias("t1"), half(16).alias("t2"), "words")


def with_shared_heads(turns: DataFrame, group: int = 20) -> tuple[DataFrame, DataFrame]:
    """(turns ``conv, at, t1, t2, words`` with ``at`` from 1, conversations
    ``conv, len``): conversation c starts with the first h turns of c - c%group
    and goes on with its own after its first h; h = crc32(c) % 4."""
    rows, _ = numbered(written(turns, "trie-turns"), ["conv", "turn", "t1", "t2"], "trie-order")
    first = written(rows.groupBy("conv").agg(F.min("row_number").alias("first"), F.count("*").alias("n")), "trie-convs")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % (HEADS + 1)).cast("int")
    placed = rows.join(first, "conv").select("conv", (F.col("row_number") - F.col("first")).alias("pos"),
                                             "t1", "t2", "words")
    turn = F.struct("pos", "t1", "t2", "words")
    heads = (placed.filter((F.col("conv") % group == 0) & (F.col("pos") < HEADS))
             .groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(turn)).alias("head")))
    shape = (first.withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % group)
             .join(heads, "base", "left"))
    head = F.when(F.col("head").isNull() | (F.col("h") == 0), F.array().cast(heads.schema["head"].dataType)).otherwise(
        F.slice("head", F.lit(1), F.greatest("h", F.lit(1))))
    shape = written(shape.select("conv", "n", "h", head.alias("head")), "trie-shape")
    own = placed.join(shape.select("conv", "h", F.size("head").alias("b")), "conv").filter(F.col("pos") >= F.col("h"))
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("b") + 1).alias("at"), "t1", "t2", "words")
    taken = shape.select("conv", F.posexplode("head").alias("i", "x")).select(
        "conv", (F.col("i") + 1).cast("long").alias("at"), "x.t1", "x.t2", "x.words")
    size = F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return own.union(taken), shape.select("conv", size.cast("long").alias("len"))


def prefix_rows(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Turns with the key of the prefix that they end (``k1, k2``) and of the
    one before (``p1, p2``)."""
    lanes = [f"l{i}" for i in range(LANES)]
    rows = turns.withColumn("blk", F.floor((F.col("at") - 1) / block).cast("long")).withColumns(
        {c: F.pmod(F.xxhash64(F.lit(i), "at", "t1", "t2"), F.lit(1 << LANE_BITS)) for i, c in enumerate(lanes)})
    inside = W.partitionBy("conv", "blk").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    sums = rows.withColumns({f"s{i}": F.sum(c).over(inside) for i, c in enumerate(lanes)})
    before = W.partitionBy("conv").orderBy("blk").rowsBetween(W.unboundedPreceding, -1)  # one row per block
    ahead = (rows.groupBy("conv", "blk").agg(*[F.sum(c).alias(c) for c in lanes])
             .select("conv", "blk", *[F.sum(c).over(before).alias(f"b{i}") for i, c in enumerate(lanes)])
             .filter("blk > 0"))
    full = sums.join(ahead, ["conv", "blk"], "left").withColumns(
        {f"s{i}": F.col(f"s{i}") + F.coalesce(f"b{i}", F.lit(0)) for i in range(LANES)})
    here = [F.col(f"s{i}") for i in range(LANES)]
    ahead = [F.col(f"s{i}") - F.col(c) for i, c in enumerate(lanes)]
    return full.select("conv", "at", "t1", "t2", "words", *_keys("k", F.col("at"), here),
                       *_keys("p", F.col("at") - 1, ahead))


def _keys(name: str, at: Column, sums: list[Column]) -> list[Column]:
    """Two 64-bit hashes of a prefix's length and lane sums; zeros for the root."""
    at, root = at.cast("long"), F.lit(0).cast("long")
    return [F.when(at == 0, root).otherwise(F.xxhash64(F.lit(i), at, *sums)).alias(f"{name}{i}") for i in (1, 2)]


def end_digests(ends: DataFrame) -> DataFrame:
    """Per key of ``ends(k1, k2, conv)`` the SHA-256 of its ids, ascending and
    joined by commas; hashed as the sorted rows stream by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = [("k1", pa.int64()), ("k2", pa.int64()), ("ends", pa.string())]
        here, state = None, None
        for batch in batches:
            k1, k2, conv = (batch.column(c).to_numpy() for c in ("k1", "k2", "conv"))
            cut = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]) if len(k1) else []
            done = []
            for a, b in zip(cut, np.r_[cut[1:], len(k1)] if len(k1) else []):
                key, text = (int(k1[a]), int(k2[a])), ",".join(map(str, conv[a:b].tolist())).encode()
                if key == here:
                    state.update(b"," + text)
                    continue
                if here is not None:
                    done.append((*here, state.hexdigest()))
                here, state = key, hashlib.sha256(text)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(list(zip(*done)) or [[]] * 3, kind)],
                                             [n for n, _ in kind])
        if here is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, (_, t) in zip((*here, state.hexdigest()), kind)],
                                             [n for n, _ in kind])
    return (ends.select(*KEY, "conv").repartition(*KEY).sortWithinPartitions(*KEY, "conv")
            .mapInArrow(run, "k1 long, k2 long, ends string"))


# ---------------------------------------------------------------------------
# Node tables
# ---------------------------------------------------------------------------

NODE = ("k1 long, k2 long, p1 long, p2 long, conv long, depth long, parent long, n_convs long, n_children long,"
        " n_leaves long, saved long")


def _accumulate(nodes: pd.DataFrame) -> pd.DataFrame:
    """Totals of one shard's nodes."""
    k1, k2, p1, p2 = (nodes[c].to_numpy(np.int64) for c in ("k1", "k2", "p1", "p2"))
    table = PerfectHash(k1, k2)
    slot = table.find(k1, k2)
    if (slot < 0).any():
        raise AssertionError("a key has no slot of its own")
    n = len(nodes)

    def scattered(values: np.ndarray) -> np.ndarray:
        flat = np.zeros(n, np.int64)
        flat[slot] = values
        return flat
    parent = scattered(table.find(p1, p2))
    depth, conv, n_convs = (scattered(nodes[c].to_numpy(np.int64)) for c in ("depth", "conv", "n_convs"))
    children, leaves, saved = (scattered(nodes[c].to_numpy(np.int64)) for c in ("n_children", "n_leaves", "saved"))
    inner = parent >= 0
    children += np.bincount(parent[inner], minlength=n)
    leaves += children == 0
    saved += (n_convs - 1) * scattered(nodes["words"].to_numpy(np.int64))
    order = np.argsort(-depth, kind="stable")
    cut = np.flatnonzero(np.r_[True, np.diff(depth[order]) != 0, True])
    for a, b in zip(cut[:-1], cut[1:]):  # deepest level first
        level = order[a:b]
        level = level[inner[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    above = pd.array(conv[np.maximum(parent, 0)], dtype="Int64")
    above[~inner] = pd.NA
    out = {"depth": depth, "conv": conv, "n_convs": n_convs, "n_children": children, "n_leaves": leaves, "saved": saved}
    return pd.DataFrame({"k1": k1, "k2": k2, "p1": p1, "p2": p2, **{c: v[slot] for c, v in out.items()},
                         "parent": above[slot]})[[c.split()[0] for c in NODE.split(", ")]]


def _distinct_nodes(rows: DataFrame, more: list[str]) -> DataFrame:
    """One row per prefix key; fails if rows of one key disagree."""
    same = ["at", "p1", "p2", "t1", "t2", "words", *more]
    nodes = rows.groupBy(*KEY).agg(F.min("path").alias("conv"), F.sum("copies").alias("n_convs"),
                                   *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_") for c in same])
    alike = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"{c}_") for c in same])
    at = F.when(alike, F.col("at")).otherwise(F.raise_error(F.lit("two prefixes share a key")).cast("long"))
    return nodes.select(*KEY, "p1", "p2", "conv", "n_convs", at.alias("depth"), "words", *more)


def trie(turns: DataFrame, sizes: DataFrame, piece: int = PIECE, shard: int = SHARD) -> DataFrame:
    """The trie's nodes from ``turns(conv, at, t1, t2, words)`` and
    ``sizes(conv, len)``: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``."""
    rows = written(prefix_rows(turns), "trie-prefixes")
    last = rows.join(sizes, "conv").filter(F.col("at") == F.col("len")).select("conv", "len", *KEY)
    none = sizes.filter("len = 0").select("conv", "len", F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"))
    ends = written(last.union(none), "trie-ends")
    paths = ends.groupBy(*KEY, "len").agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    rows = written(rows.join(paths.select("conv", "len", "copies").filter("len > 0"), "conv")
                   .withColumnRenamed("conv", "path"), "trie-paths")
    spark = rows.sparkSession
    sent = spark.createDataFrame([], "k1 long, k2 long, n_children long, n_leaves long, saved long")
    made = []
    while True:
        heavy = written(rows.groupBy(*KEY).agg(F.sum(F.col("len") - F.col("at") + 1).alias("below"))
                        .filter(F.col("below") > piece).select(*KEY), "trie-crown")
        crown = bool(heavy.head(1))
        if crown:
            cut = rows.join(heavy, KEY, "left_semi").groupBy("path").agg((F.max("at") + 1).alias("cut"))
            rows = written(rows.join(cut, "path", "left").withColumn("cut", F.coalesce("cut", F.lit(1))), "trie-cut")
        else:
            rows = rows.withColumn("cut", F.lit(1).cast("long"))
        tops = rows.filter("at = cut").select("path", F.col("k1").alias("r1"), F.col("k2").alias("r2"))
        nodes = _distinct_nodes(rows.filter("at >= cut").join(tops, "path"), ["r1", "r2"]).join(sent, KEY, "left").na.fill(
            0, ["n_children", "n_leaves", "saved"])
        nodes = written(nodes, "trie-nodes")
        shards = max(1, -(-nodes.count() // shard))
        dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("r1", "r2"), F.lit(shards)))
        made.append(written(dealt.groupBy("shard").applyInPandas(_accumulate, NODE), "trie-totals"))
        tops = made[-1].filter("parent is null").select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_leaves", "saved")
        tops = tops.groupBy(*KEY).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                                      F.sum("saved").alias("saved"))
        # sums for a node of the crown may come from pieces of several rounds
        sent = written(sent.unionByName(tops).groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in
                                                                ("n_children", "n_leaves", "saved")]), "trie-sums")
        if not crown:
            break
        upper = rows.filter("at < cut").withColumn("len", F.col("cut") - 1).drop("cut")
        joint = (upper.filter("at = len").groupBy(*KEY).agg(F.min("path").alias("path"), F.sum("copies").alias("copies"))
                 .select("path", "copies"))
        rows = written(upper.drop("copies").join(joint, "path"), "trie-paths")
    root = _root(sizes, sent)
    nodes = reduce(DataFrame.unionByName, made)
    known = reduce(DataFrame.unionByName, [root, *made[1:]]).select(F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                                                                   F.col("conv").alias("above"))
    nodes = nodes.join(known, ["p1", "p2"], "left").withColumn("parent", F.coalesce("parent", "above")).drop("above")
    full = nodes.unionByName(root).join(end_digests(ends), KEY, "left")
    return full.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
                       "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                       F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))


def _root(sizes: DataFrame, sent: DataFrame) -> DataFrame:
    """The textless root as a node row; none without conversations."""
    zero = F.lit(0).cast("long")
    null = F.lit(None).cast("long")
    top = sizes.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter("n_convs > 0").withColumns(
        {"k1": zero, "k2": zero}).join(sent, KEY, "left")
    return top.select(*KEY, null.alias("p1"), null.alias("p2"), "conv", zero.alias("depth"), null.alias("parent"),
                      "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                      F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
                      F.coalesce("saved", zero).alias("saved"))


def conversation_trie(conversations: DataFrame, piece: int = PIECE, shard: int = SHARD) -> DataFrame:
    """Contract rows of ``op13``."""
    turns, sizes = with_shared_heads(turn_digests(conversations))
    return trie(turns, sizes, piece, shard)
