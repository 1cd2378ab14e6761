"""Embedding near-duplicates by iterative quantisation (ITQ).

A rotation is learned on a bounded sample so that the signs of the rotated,
centred vectors are balanced codes; rotations from different starts give codes
each as long as the vector.  Codes are cut into keys, one hash table per key
(multi-index Hamming look-up: codes that differ in fewer bits than there are
tables agree in one key at least).  Keys get longer as the table grows, so the
number of rotations is not fixed: from ``ROTATIONS`` on they are added until
``RECALL`` of made-up neighbours of the sample, at a cosine of exactly the
threshold, share a key; where ``MOST_BITS`` of code do not reach that, keys
get shorter.  The neighbours are of vectors that the rotations have not seen,
unless the sample is the whole table.

Every vector is put into all tables.  Codes that share a bucket are compared
first, by Hamming distance; only vectors with a code near theirs (no farther
than the made-up neighbours' codes, and some) are fetched and compared by the
cosine of their original values in double precision.  A pair counts in the
first table that brings it together only.

Vectors of different lengths are not compared.  The most frequent length, and
each other with more than ``RARE`` distinct vectors, has rotations of its own;
those of rarer lengths are compared exactly, length by length.

Equal vectors form one class before all this.  Buckets over ``BLOCK`` rows are
cut into blocks, and each pair of blocks is one cell, so a cell never holds
more than two blocks' rows; a cell returns sums and a star of links per group
found, not its pairs.  As the numbers of links are exact, the work on a bucket
of near copies is quadratic in its size, in cells that spread over tasks.

The sample bounds training only: every vector is indexed and searched.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components link with nothing; null ids are ignored when the
smallest id is taken; repeated ids and vectors are rows of their own; an empty
table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, hash_sample, written

SAMPLE = 20_000
#: Rotations at least and at most, and bits of all codes of a vector at most.
ROTATIONS = 3
MOST_ROTATIONS = 128
MOST_BITS = 4096
#: Share of the pairs at exactly the threshold that must meet in a table.
RECALL = 0.999
PROBES = 20_000
ITERATIONS = 40
BLOCK = 1024
#: Cells of up to so many rows are compared row against shifted row, all together.
SMALL = 48
KEY_BITS = (10, 28)
#: Distinct vectors of one length up to which they are compared exactly.
RARE = 2048


def learn_rotations(sample: np.ndarray, rotations: int = ROTATIONS, iterations: int = ITERATIONS,
                    seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(mean, dim x rotations*dim matrix): ITQ on unit vectors, each rotation
    from its own random orthogonal start."""
    mean = sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])
    x = sample - mean
    dim = x.shape[1]
    _, axes = np.linalg.eigh(x.T @ x)
    v = x @ axes
    found = []
    for k in range(rotations):
        r = np.linalg.qr(np.random.default_rng(seed + k).standard_normal((dim, dim)))[0]
        for _ in range(iterations if len(sample) else 0):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        found.append(axes @ r)
    return mean, np.hstack(found)


def key_width(n: int) -> int:
    """Bits per key: buckets of a constant size on balanced codes."""
    return min(KEY_BITS[1], max(KEY_BITS[0], math.ceil(math.log2(max(2, n))) - 4))


def table_keys(unit: np.ndarray, mean: np.ndarray, rotation: np.ndarray, width: int) -> np.ndarray:
    """One key per table and row: consecutive, disjoint bits of the codes."""
    bits = (unit - mean) @ rotation >= 0
    if not width:  # one table with one bucket
        return np.zeros((len(unit), 1), np.int64)
    tables = bits.shape[1] // width
    weights = 1 << np.arange(width, dtype=np.int64)
    return bits[:, :tables * width].reshape(len(unit), tables, width) @ weights


def codes(unit: np.ndarray, mean: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Packed sign bits, one row of bytes per vector (whole 64-bit words)."""
    bits = (unit - mean) @ rotation >= 0
    return np.packbits(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64))), axis=1, bitorder="little")


def code_keys(code: np.ndarray, width: int, n_bits: int) -> np.ndarray:
    """The keys of ``table_keys`` from packed codes."""
    if not width:
        return np.zeros((len(code), 1), np.int64)
    tables = n_bits // width
    bits = np.unpackbits(code, axis=1, bitorder="little", count=tables * width)
    return bits.reshape(len(code), tables, width) @ (1 << np.arange(width, dtype=np.int64))


def _reach(a: np.ndarray, b: np.ndarray, mean: np.ndarray, rotation: np.ndarray) -> int:
    """Hamming distance that no pair at the threshold should exceed: the most
    among the made-up ones, and a fifth more."""
    apart = np.bitwise_count(codes(a, mean, rotation) ^ codes(b, mean, rotation)).sum(axis=1, dtype=np.int64)
    return int(1.2 * apart.max(initial=0)) + 4


def neighbours(sample: np.ndarray, threshold: float, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the sample, each next to one at a cosine of
    ``threshold`` in a random direction."""
    dim = sample.shape[1]
    n = min(PROBES, max(PROBES // 10, (1 << 21) // dim)) if len(sample) else 0
    a = sample[np.arange(n) % max(1, len(sample))]
    away = np.random.default_rng(seed).standard_normal(a.shape)
    away -= (away * a).sum(axis=1, keepdims=True) * a
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-9)
    cos = min(1.0, max(-1.0, threshold)) if dim > 1 else 1.0
    return a, cos * a + math.sqrt(1 - cos * cos) * away


def learn_tables(sample: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(mean, rotations, key width, greatest Hamming distance) for ``n`` vectors:
    as many rotations as the width needs for ``RECALL`` at the threshold."""
    kept = np.arange(len(sample)) % 5 == 0 if n > len(sample) > 5 else np.zeros(len(sample), bool)
    pairs = neighbours(sample[kept] if kept.any() else sample, threshold)
    sample = sample[~kept]
    mean, learned = learn_rotations(sample)
    dim, least = len(mean), learned.shape[1] // len(mean)
    most = max(least, min(MOST_ROTATIONS, MOST_BITS // dim))
    for width in range(key_width(n), -1, -1):
        a, b = pairs
        for k in range(least, most + 1):
            if learned.shape[1] < k * dim:
                learned = np.hstack([learned, learn_rotations(sample, 1, seed=10 + k)[1]])
            rotation = learned[:, :k * dim]
            apart = (table_keys(a, mean, rotation, width) != table_keys(b, mean, rotation, width)).all(axis=1)
            a, b = a[apart], b[apart]
            if len(a) <= (1 - RECALL) * len(pairs[0]):
                return mean, rotation, width, _reach(*pairs, mean, rotation)
    raise AssertionError("without keys all pairs meet")


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors in double precision of a list column without nulls."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _one_zero(v: Column) -> Column:
    return F.transform(v, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))


def vector_classes(rows: DataFrame, vector: str) -> DataFrame:
    """Usable vectors: ``id, v`` (as stored, with one zero)."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.filter(F.coalesce(sound, F.lit(False))).select("id", _one_zero(v).alias("v"))


CELL = ["t", "key", "lo", "hi"]


def _cells(entries: DataFrame) -> DataFrame:
    """``entries(cls, t, key)`` of buckets with company, in the cells of every
    pair of their bucket's blocks: ``t, key, lo, hi, mine, cls``."""
    size = entries.groupBy("t", "key").agg(F.count("*").alias("size")).filter("size > 1")
    return (entries.join(size, ["t", "key"]).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
            .withColumn("mine", F.pmod(F.xxhash64("cls", "t"), F.col("blocks")).cast("int"))
            .select("cls", "t", "key", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            .select("t", "key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "cls"))


def _compared(cells: DataFrame, width: int, n_bits: int, threshold: float) -> DataFrame:
    """Links of the cells' rows ``..., n, v, code``: ``kind, a, b``."""
    dealt = cells.select(*CELL, "mine", "cls", "n", "v", "code").repartition(*CELL).sortWithinPartitions(*CELL, "mine")
    return written(dealt.mapInArrow(lambda batches: _compare(batches, width, n_bits, threshold),
                                    "kind int, a long, b long"), "itq-links")


def find_links(classes: DataFrame, dim: int, threshold: float, sample: int = SAMPLE) -> DataFrame:
    """``kind`` 0: (class a, number of other vectors in linked classes b);
    ``kind`` 1: an edge a - b of a star.  ``classes``: ``cls, n, v`` of one length."""
    spark = classes.sparkSession
    few = hash_sample(classes.select("v"), F.col("v"), sample).toArrow()
    learned = learn_tables(_unit(few["v"].combine_chunks(), dim), classes.count(), threshold)
    width, n_bits = learned[2], learned[1].shape[1]
    model = spark.sparkContext.broadcast(learned)

    def add_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, rotation, width, _ = model.value
        for b in batches:
            code = codes(_unit(b.column("v"), dim), mean, rotation)
            keys = code_keys(code, width, n_bits).astype(np.int32)
            cut = pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([c.tobytes() for c in code], pa.binary()),
                 pa.ListArray.from_arrays(cut, pa.array(keys.ravel()))], ["cls", "n", "v", "code", "keys"])
    coded = written(classes.select("cls", "n", "v").mapInArrow(
        add_codes, f"cls long, n long, v {classes.schema['v'].dataType.simpleString()}, code binary, keys array<int>"),
        "itq-codes")
    cells = _cells(coded.select("cls", F.posexplode("keys").alias("t", "key")))
    near = (cells.join(coded.select("cls", "code"), "cls").select(*CELL, "mine", "cls", "code")
            .repartition(*CELL).sortWithinPartitions(*CELL, "mine")
            .mapInArrow(lambda batches: _near_codes(batches, model.value[3]),
                        "t int, key int, lo int, hi int, mine int, cls long"))
    near = written(near, "itq-near")
    return _compared(near.join(coded.drop("keys"), "cls"), width, n_bits, threshold)


def exact_links(classes: DataFrame, threshold: float) -> DataFrame:
    """As ``find_links`` for ``classes(cls, n, v, d)`` of rare lengths: vectors of
    one length are one bucket, without codes."""
    entries = classes.select("cls", F.lit(0).alias("t"), F.col("d").alias("key"))
    rows = _cells(entries).join(classes.select("cls", "n", "v", F.lit(b"").alias("code")), "cls")
    return _compared(rows, 0, 0, threshold)


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by cell in tables of whole cells; holds one batch and one cell."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
        ids = np.stack([rows[c].to_numpy() for c in CELL])
        last = len(rows) - int(np.argmin(np.r_[(ids[:, ::-1] == ids[:, -1:]).all(axis=0), False]))
        if last:
            yield rows.slice(0, last)
        rest = rows.slice(last)
    if rest is not None and len(rest):
        yield rest


def _starts(*columns: np.ndarray) -> np.ndarray:
    """True where a row's columns differ from the row before."""
    return np.r_[True, np.any([np.diff(c) != 0 for c in columns], axis=0)]


def _near_codes(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """Rows of cells whose code has one within ``reach`` bits in its cell (of two
    blocks: in the other block)."""
    for rows in _by_cell(batches):
        t, key, lo, hi, mine = (rows[c].to_numpy() for c in (*CELL, "mine"))
        code = rows["code"].combine_chunks()
        words = np.frombuffer(b"".join(code.to_pylist()), np.uint64).reshape(len(rows), -1)
        first = np.flatnonzero(_starts(t, key, lo, hi))
        size = np.diff(np.r_[first, len(rows)])
        kept = np.zeros(len(rows), bool)
        cell = np.repeat(np.arange(len(first)), size)
        small = np.flatnonzero(size[cell] <= SMALL)
        for gap in range(1, SMALL):  # rows of small cells, all cells at once
            i = small[:-gap][cell[small[gap:]] == cell[small[:-gap]]] if gap < len(small) else small[:0]
            if not len(i):
                break
            good = np.bitwise_count(words[i] ^ words[i + gap]).sum(axis=1, dtype=np.int64) <= reach
            good &= (lo[i] == hi[i]) | (mine[i] != mine[i + gap])
            kept[i[good]] = kept[i[good] + gap] = True
        for c in np.flatnonzero(size > SMALL):
            at = np.arange(first[c], first[c] + size[c])
            for part in np.array_split(at, -(-len(at) // 128)):
                apart = np.bitwise_count(words[part][:, None] ^ words[at][None]).sum(axis=2, dtype=np.int64)
                good = (apart <= reach) & (part[:, None] != at[None])
                if lo[at[0]] != hi[at[0]]:
                    good &= mine[part][:, None] != mine[at][None]
                kept[part] |= good.any(axis=1)
        found = rows.drop_columns(["code"]).filter(pa.array(kept))
        yield from found.combine_chunks().to_batches()


def _compare(batches: Iterator[pa.RecordBatch], width: int, n_bits: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell to sums and stars."""
    def done(rows: pa.Table) -> pa.RecordBatch:
        t, key, lo, hi, mine, cls, n = (rows[c].to_numpy() for c in (*CELL, "mine", "cls", "n"))
        v = rows["v"].combine_chunks()
        u = _unit(v, len(v.flatten()) // len(v))
        code = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(u), -1)
        keys = code_keys(code, width, n_bits)
        new = _starts(t, key, lo, hi)
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(u)])
        cell = np.cumsum(new) - 1
        pairs = []
        small = np.flatnonzero(size[cell] <= SMALL)
        for gap in range(1, SMALL):  # rows of small cells, all cells at once
            i = small[:-gap][cell[small[gap:]] == cell[small[:-gap]]] if gap < len(small) else small[:0]
            if not len(i):
                break
            pairs.append((i, i + gap, np.einsum("ij,ij->i", u[i], u[i + gap]) >= threshold))
        for c in np.flatnonzero(size > SMALL):
            at = slice(first[c], first[c] + size[c])
            i, j = np.nonzero(np.triu(u[at] @ u[at].T >= threshold, 1))
            pairs.append((i + first[c], j + first[c], np.ones(len(i), bool)))
        i, j = (np.concatenate([p[k][p[2]] for p in pairs] or [np.empty(0, np.int64)]) for k in (0, 1))
        # two blocks: pairs across only; and a pair counts in the first table that holds both
        good = (lo[i] == hi[i]) | (mine[i] != mine[j])
        good &= ~((keys[i] == keys[j]) & (np.arange(keys.shape[1]) < t[i][:, None])).any(axis=1)
        i, j = i[good], j[good]
        total = np.bincount(i, n[j], len(u)) + np.bincount(j, n[i], len(u))
        some, group = np.flatnonzero(total), np.arange(len(u))
        while len(i):  # smallest row of each group of linked rows
            low, before = np.minimum(group[i], group[j]), group.copy()
            np.minimum.at(group, i, low)
            np.minimum.at(group, j, low)
            group = group[group]
            if (group == before).all():
                break
        leaf = np.flatnonzero(group != np.arange(len(u)))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.r_[np.zeros(len(some), np.int32), np.ones(len(leaf), np.int32)]),
             pa.array(np.r_[cls[some], cls[leaf]]),
             pa.array(np.r_[total[some].astype(np.int64), cls[group[leaf]]])], ["kind", "a", "b"])

    for rows in _by_cell(batches):
        lengths = rows["v"].combine_chunks().value_lengths().to_numpy()  # one cell has one length
        cut = np.flatnonzero(_starts(lengths))
        for a, b in zip(cut, np.r_[cut[1:], len(rows)]):
            yield done(rows.slice(a, b - a))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                    sample: int = SAMPLE) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` and ``kept``."""
    rows = vectors.select(F.col(id_col).alias("id"), vector)
    key = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")]  # 128 bits
    grouped = written(vector_classes(rows, vector).groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
                      .select("*", F.size("v").alias("d"), *key, F.monotonically_increasing_id().alias("cls")), "itq-classes")
    lengths = grouped.groupBy("d").count()
    most = lengths.orderBy(F.desc("count"), "d").limit(1)
    # at most n / RARE lengths; the most frequent one whatever its count
    known = [r["d"] for r in lengths.filter(F.col("count") > RARE).union(most).select("d").distinct().collect()]
    parts = [find_links(grouped.filter(F.col("d") == d), d, threshold, sample) for d in known]
    parts.append(exact_links(grouped.filter(~F.col("d").isin(known)) if known else grouped, threshold))
    links = reduce(DataFrame.union, parts)
    counts = links.filter("kind = 0").groupBy(F.col("a").alias("cls")).agg(F.sum("b").alias("linked"))
    found = components(links.filter("kind = 1"), "a", "b", "itq-components").withColumnRenamed("node", "cls")
    classes = (grouped.select("cls", "h1", "h2", "least", "n").join(counts, "cls", "left").join(found, "cls", "left")
               .withColumn("root", F.coalesce("component", "cls")))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = classes.join(least, "root").select(
        "h1", "h2", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    keyed = rows.withColumn("v", _one_zero(F.col(vector))).select("id", *key)
    return keyed.join(facts, ["h1", "h2"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce("id", F.lit(-1)).eqNullSafe(F.coalesce("component_id", "id")).alias("kept"))
