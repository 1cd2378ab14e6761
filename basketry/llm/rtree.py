"""Hard-negative mining over R-trees packed by sort-tile-recursive order (STR).

All rows are put in the order (vector length, label, first component, id) and
cut into shards of a bounded number of rows; each shard is one packed R-tree:
its rows are tiled coordinate by coordinate (widest first) into leaf pages,
pages are grouped level by level, and every node has a minimum bounding box,
an interval of labels and its smallest id.

A box gives an interval per coordinate, so q·x of any row x inside lies between
Σ min(q_j·lo_j, q_j·hi_j) and Σ max(q_j·lo_j, q_j·hi_j).  A search takes a block
of anchors through one tree: a queue gives the node with the greatest upper
bound first, and a node is left out for an anchor whose score window it misses,
whose k-th best score it stays strictly under, or (at exactly that score) all
whose ids are greater.  Every anchor block meets every shard of its vector
length, and the shards' best rows are merged, so results are exact.

Rows are numbered, so rows that repeat an id stay rows of their own.

Defined results: rows whose id, label or vector is null, or whose vector holds
a null or non-finite component, take no part; only vectors of one length are
compared (an empty vector scores 0); a component must fit 32 bits after
scaling, and every score 63, else the query fails rather than return a wrong
score; an empty table, or one without anchors, gives no rows; other columns
are ignored.
"""
from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import numbered, written

#: Rows of a shard at least and at most, shards aimed at, anchors of a block.
SHARD_ROWS = (1024, 16384)
SHARDS = 64
ANCHORS = 512
LEAF = 64
FANOUT = 8
NO_ID = np.iinfo(np.int64).max


def scaled(vector: str, by: int = 256) -> Column:
    """``floor(by * x)`` of every component x as a double."""
    def one(x: Column) -> Column:
        y = F.floor(x.cast("double") * F.lit(float(by)))
        return F.when(F.abs(x.cast("double") * F.lit(float(by))) < F.lit(2.0 ** 31), y).otherwise(
            F.raise_error(F.lit("a component does not fit 32 bits"))).cast("int")
    return F.transform(vector, one)


def finite(vector: str) -> Column:
    """True if the vector is there and each component is a finite number."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))),
                      F.lit(False))


# ---------------------------------------------------------------------------
# Packing
# ---------------------------------------------------------------------------

def str_order(q: np.ndarray, page: int = LEAF) -> np.ndarray:
    """Row order in which consecutive runs of ``page`` rows are STR tiles: a
    sort by the widest coordinate cuts the rows into slabs of whole pages, each
    slab is cut by the next coordinate, and so on."""
    dims = np.argsort(-q.var(axis=0), kind="stable") if q.shape[1] else np.empty(0, int)

    def tile(rows: np.ndarray, level: int) -> list[np.ndarray]:
        pages = -(-len(rows) // page)
        if pages <= 1 or level >= len(dims):
            return [rows]
        slabs = max(2, int(np.ceil(pages ** (1.0 / (len(dims) - level)) - 1e-9)))
        rows = rows[np.argsort(q[rows, dims[level]], kind="stable")]
        step = -(-pages // slabs) * page
        return [part for at in range(0, len(rows), step) for part in tile(rows[at:at + step], level + 1)]
    return np.concatenate(tile(np.arange(len(q)), 0)) if len(q) else np.empty(0, int)


class Tree:
    """A packed R-tree: rows in page order, and per level (leaves first) the
    boxes ``lo, hi``, label intervals and smallest ids of its nodes.  A node's
    children are ``FANOUT`` consecutive nodes of the level below."""

    def __init__(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, refs: np.ndarray):
        self.q, self.ids, self.labels, self.refs = q, ids, labels, refs
        start = np.arange(0, len(q), LEAF)
        self.levels = [(np.minimum.reduceat(q, start), np.maximum.reduceat(q, start),
                        np.minimum.reduceat(labels, start), np.maximum.reduceat(labels, start),
                        np.minimum.reduceat(ids, start))]
        while len(self.levels[-1][0]) > 1:
            lo, hi, first, last, least = self.levels[-1]
            start = np.arange(0, len(lo), FANOUT)
            self.levels.append((np.minimum.reduceat(lo, start), np.maximum.reduceat(hi, start),
                                np.minimum.reduceat(first, start), np.maximum.reduceat(last, start),
                                np.minimum.reduceat(least, start)))


def _pack(table: pa.Table) -> pa.Table:
    """One shard's rows, sorted by number, to one row with its columns in page order."""
    table = table.sort_by("ref")
    n = table.num_rows
    q = table["q"].combine_chunks().flatten().to_numpy().reshape(n, -1).astype(np.int32)
    order = str_order(q)
    return pa.table({
        "d": pa.array([q.shape[1]], pa.int32()), "slab": table["slab"].slice(0, 1),
        "q": [np.ascontiguousarray(q[order]).tobytes()],
        **{c: [np.ascontiguousarray(table[c].to_numpy()[order]).tobytes()] for c in ("id", "label", "ref")}})


def pack_shards(rows: DataFrame, shard_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(numbered rows ``id, label, q, d, slab, ref``, shards ``d, slab, q, id,
    label, ref`` with one row per packed tree)."""
    keyed = rows.select("id", F.col("label").cast("long").alias("label"), "q", F.size("q").alias("d"),
                        F.get("q", F.lit(0)).alias("first"), *[c for c in rows.columns if c not in ("id", "label", "q")])
    placed, n = numbered(keyed, ["d", "label", "first", "id"], "rtree-rows")
    size = shard_rows or min(SHARD_ROWS[1], max(SHARD_ROWS[0], -(-n // SHARDS)))
    placed = placed.withColumn("slab", F.floor(F.col("row_number") / size).cast("long")) \
                   .withColumnRenamed("row_number", "ref")
    shards = placed.select("id", "label", "q", "d", "slab", "ref").groupBy("d", "slab").applyInArrow(
        _pack, "d int, slab long, q binary, id binary, label binary, ref binary")
    return placed, written(shards, "rtree-shards")


# ---------------------------------------------------------------------------
# Best-first search of one tree by a block of queries
# ---------------------------------------------------------------------------

def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a·bᵀ of integers, exactly: in doubles where they hold every sum."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2.0 ** 56:  # 100 times a score still fits
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise OverflowError("a score may not fit 63 bits")


class Best:
    """The k best (score, id) of every query, higher score and smaller id first."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), NO_ID)

    def may_improve(self, rows: np.ndarray, upper: np.ndarray, least: np.ndarray) -> np.ndarray:
        """False where everything is strictly below the k-th best of a query (an
        equal score is below it if its id is greater)."""
        kth, kid = self.score[rows, -1], self.id[rows, -1]
        return (upper > kth) | ((upper == kth) & (least < kid))

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(row):
            return
        touched = np.unique(row)
        r = np.r_[np.repeat(touched, self.k), row]
        s = np.r_[self.score[touched].ravel(), score]
        i = np.r_[self.id[touched].ravel(), ids]
        order = np.lexsort((i, ~s, r))
        r, s, i = r[order], s[order], i[order]
        first = np.searchsorted(r, touched)
        take = (first[:, None] + np.arange(self.k)).ravel()
        self.score[touched], self.id[touched] = s[take].reshape(-1, self.k), i[take].reshape(-1, self.k)


def search(tree: Tree, q: np.ndarray, of: np.ndarray, best: Best,
           wants: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray],
           takes: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> None:
    """Fills ``best`` for the queries ``of`` (query w asks with vector q[of[w]]).

    ``wants(w, lower, upper, first label, last label)`` says which queries can
    have rows in a node; ``takes(w, rows, scores)`` which rows a query takes.
    """
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)

    def alive(level: int, node: int, w: np.ndarray) -> tuple[np.ndarray, int]:
        """Queries of ``w`` that the node can serve, and its greatest upper bound."""
        lo, hi, first, last, least = (x[node] for x in tree.levels[level])
        vec, back = np.unique(of[w], return_inverse=True)
        p, m = plus[vec], minus[vec]
        upper = (_dot(p, hi[None]) + _dot(m, lo[None]))[:, 0][back]
        lower = (_dot(p, lo[None]) + _dot(m, hi[None]))[:, 0][back]
        keep = wants(w, lower, upper, first, last) & best.may_improve(w, upper, np.broadcast_to(least, len(w)))
        return w[keep], upper[keep]

    queue: list = []
    made = 0

    def push(level: int, node: int, w: np.ndarray) -> None:
        nonlocal made
        w, upper = alive(level, node, w)
        if len(w):
            made += 1
            heapq.heappush(queue, (-int(upper.max()), made, level, node, w, upper))

    push(len(tree.levels) - 1, 0, np.arange(len(of)))
    while queue:
        _, _, level, node, w, upper = heapq.heappop(queue)
        keep = best.may_improve(w, upper, np.broadcast_to(tree.levels[level][4][node], len(w)))
        w = w[keep]  # the k-th best may have risen since
        if not len(w):
            continue
        if level:
            for child in range(node * FANOUT, min((node + 1) * FANOUT, len(tree.levels[level - 1][0]))):
                push(level - 1, child, w)
            continue
        rows = np.arange(node * LEAF, min((node + 1) * LEAF, len(tree.q)))
        vec, back = np.unique(of[w], return_inverse=True)
        score = _dot(q[vec], tree.q[rows])[back]
        good = takes(w, rows, score) & (score >= best.score[w, -1][:, None])
        i, j = np.nonzero(good)
        best.add(w[i], score[i, j], tree.ids[rows[j]])


def _read_tree(batch: pa.RecordBatch, k: int) -> Tree:
    d = batch.column("d")[k].as_py()
    ids, labels, refs = (np.frombuffer(batch.column(c)[k].as_buffer(), np.int64) for c in ("id", "label", "ref"))
    return Tree(np.frombuffer(batch.column("q")[k].as_buffer(), np.int32).reshape(len(ids), d).astype(np.int64),
                ids, labels, refs)


def _trees_met(blocks: DataFrame, shards: DataFrame) -> DataFrame:
    """Every block next to every shard of its vector length: block rows go to
    the shards' numbers in an equi-join."""
    known = shards.groupBy("d").agg(F.min("slab").alias("from"), F.max("slab").alias("to"))
    dealt = blocks.join(known, "d").withColumn("slab", F.explode(F.sequence("from", "to"))).drop("from", "to")
    return dealt.join(shards, ["d", "slab"])


def _blocks(anchors: DataFrame, cols: list[str], n: int) -> DataFrame:
    """Anchors packed into blocks of about ``ANCHORS`` by a hash of their number."""
    block = F.pmod(F.xxhash64("ref"), F.lit(max(1, -(-n // ANCHORS))))
    rows = anchors.groupBy("d", block.alias("block")).agg(F.collect_list(F.struct("ref", "label", "q", *cols)).alias("a"))
    return rows.select("d", F.col("a.ref").alias("a_ref"), F.col("a.label").alias("a_label"),
                       F.flatten("a.q").alias("a_q"), *[F.col(f"a.{c}").alias(f"a_{c}") for c in cols])


def _anchor_arrays(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ref, label, q = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("a_ref", "a_label", "a_q"))
    return ref, label, q.reshape(len(ref), -1).astype(np.int64)


def _positives(k: int) -> Callable:
    """The k best other rows of an anchor's label in each tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ref, label, q = _anchor_arrays(batch, at)
                tree = _read_tree(batch, at)
                best = Best(len(ref), k)
                search(tree, q, np.arange(len(ref)), best,
                       lambda w, lower, upper, first, last: (first <= label[w]) & (label[w] <= last),
                       lambda w, rows, score: (tree.labels[rows] == label[w][:, None]) & (tree.refs[rows] != ref[w][:, None]))
                i, j = np.nonzero(best.id != NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array(ref[i]), pa.array(best.id[i, j]), pa.array(best.score[i, j])],
                                                 ["ref", "id", "score"])
    return run


def _negatives(k: int, low: int, high: int) -> Callable:
    """Per anchor and positive, the k best rows of another label inside the
    window low·positive <= 100·score <= high·positive in each tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ref, label, q = _anchor_arrays(batch, at)
                tree = _read_tree(batch, at)
                lists = batch.column("a_scores")[at].values
                counts = lists.value_lengths().to_numpy()
                of = np.repeat(np.arange(len(ref)), counts)
                positive = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                place = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
                least, most = low * positive, high * positive
                best = Best(len(of), k)

                def wants(w, lower, upper, first, last):
                    pure = (first == last) & (label[of[w]] == first)
                    return ~pure & (100 * upper >= least[w]) & (100 * lower <= most[w])

                def takes(w, rows, score):
                    return ((tree.labels[rows] != label[of[w]][:, None]) & (100 * score >= least[w][:, None])
                            & (100 * score <= most[w][:, None]))
                search(tree, q, of, best, wants, takes)
                i, j = np.nonzero(best.id != NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ref[of[i]]), pa.array(place[i].astype(np.int32)), pa.array(best.id[i, j]),
                     pa.array(best.score[i, j])], ["ref", "place", "id", "score"])
    return run


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         shard_rows: int | None = None) -> DataFrame:
    """Hard negatives of the anchors among ``rows(id, label, q array<int>)``:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on the rows.  An anchor's positives are the
    ``positives`` best other rows of its label; for each, the ``negatives`` best
    rows of another label whose score lies between ``low`` and ``high`` percent
    of the positive's come back, ranked from 1.
    """
    placed, shards = pack_shards(rows.withColumn("anchor", F.coalesce(is_anchor, F.lit(False))), shard_rows)
    anchors = written(placed.filter("anchor").select("ref", "id", "label", "q", "d"), "rtree-anchors")
    n = anchors.count()
    met = _trees_met(_blocks(anchors, [], n), shards).select("a_ref", "a_label", "a_q", "d", "q", "id", "label", "ref")
    order = W.partitionBy("ref").orderBy(F.desc("score"), "id")
    found = (met.mapInArrow(_positives(positives), "ref long, id long, score long")
             .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives))
    own = found.groupBy("ref").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("p"))
    with_own = written(anchors.withColumnRenamed("id", "anchor_id").join(own, "ref"), "rtree-positives")
    scores = with_own.withColumn("scores", F.col("p.score"))
    met = _trees_met(_blocks(scores, ["scores"], n), shards).select(
        "a_ref", "a_label", "a_q", "a_scores", "d", "q", "id", "label", "ref")
    order = W.partitionBy("ref", "place").orderBy(F.desc("score"), "id")
    hard = (met.mapInArrow(_negatives(negatives, low, high), "ref long, place int, id long, score long")
            .withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= negatives))
    mine_ = F.get("p", F.col("place"))
    return (hard.join(with_own.select("ref", "anchor_id", "p"), "ref")
            .select("anchor_id", mine_["id"].alias("positive_id"), "rank", F.col("id").alias("negative_id"),
                    mine_["score"].alias("positive_score"), F.col("score").alias("negative_score")))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Contract rows of ``op11``: labels of ids divisible by 7 are moved on by
    one (mod 10), components become floor(256x), anchors are the ids divisible
    by 50."""
    usable = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable.select(F.col("vec_id").cast("long").alias("id"), moved.cast("long").alias("label"),
                         scaled("embedding").alias("q"))
    return mine(rows, F.col("id") % 50 == 0)
