"""SimHash near-duplicates found through pivot distance tables.

Every text gets a 64-bit fingerprint; equal fingerprints form one class.  The
Hamming distances of each distinct fingerprint to a fixed set of reference
fingerprints (pivots) are its coordinates.  Two fingerprints within r bits
differ by at most r in every coordinate, which serves twice:

* The first 17 pivots (all zeros, and one nibble of ones each) give the number
  of ones per nibble.  Two bits move these 16 counts by at most 2 in total, so
  two such fingerprints meet in a *cell*: every fingerprint is put into the
  cell of its counts and into the (up to 32) cells one step away.
* Pairs that meet in a cell are discarded by their maximum coordinate
  difference over all pivots; the survivors are verified bit by bit.

Cells with more than ``CROWD`` members (many variants of one text) are not
compared pair by pair.  Their members go on to a finer table, whose pivots are
the single bits: there the coordinates are the bits themselves, a cell one
step wide holds at most 65 members, and sharing a cell means a distance of at
most two bits, so one star of links per cell loses no link.

Defined results: null text, empty text and text without words have fingerprint
zero and are linked like any other; null ids are ignored when the component's
smallest id is taken (all null: null); repeated rows keep their own row each;
an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, kept_apart, text_key, unused, written

SEED = 42
MAX_DISTANCE = 2
CROWD = 64
NIBBLES = 16


def pivots() -> np.ndarray:
    """The reference fingerprints: zero, a nibble of ones each, and 47 others
    spread by an odd multiplier."""
    nibble = [0xF << (4 * s) for s in range(NIBBLES)]
    spread = [(k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF for k in range(1, 48)]
    return np.array([0, *nibble, *spread], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text: a bit is one if it is set in over half of the
    XXH64 hashes of its word shingles."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = (map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle
                else [b" ".join(words)])
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        block = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """Adds ``fp`` (the fingerprint's 64 bits as a signed long); a column of that
    name goes on with an underscore before it."""
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return kept_apart(docs.withColumn(out := unused(docs, "fp_"), simhash(F.col(text))), "fp").withColumnRenamed(out, "fp")


def distances(fps: np.ndarray) -> np.ndarray:
    """Pivot distance table: one row per fingerprint, one column per pivot."""
    return np.bitwise_count(fps.view(np.uint64)[:, None] ^ pivots()[None, :]).astype(np.int8)


def _to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct fingerprints to (cell, fp) rows: own cell and one step away."""
    step = 5 ** np.arange(NIBBLES, dtype=np.int64)
    for b in batches:
        fps = b["fp"].to_numpy(np.int64)
        d = distances(fps)
        counts = ((d[:, :1].astype(np.int64) - d[:, 1:1 + NIBBLES] + 4) // 2)
        cell = counts @ step
        cells = np.concatenate([cell[:, None], cell[:, None] + step, cell[:, None] - step], axis=1)
        inside = np.concatenate([np.ones((len(fps), 1), bool), counts < 4, counts > 0], axis=1)
        row, col = np.nonzero(inside)
        yield pd.DataFrame({"cell": cells[row, col], "fp": fps[row]})


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by cell to verified links (a, b), and members of crowded
    cells as (a, null)."""
    cell, fp = np.empty(0, np.int64), np.empty(0, np.int64)

    def links(cell, fp):
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, int)
        size = np.diff(np.r_[start, len(cell)])
        many = np.repeat(size > CROWD, size)
        out = [(fp[many], np.zeros(many.sum(), np.int64), np.ones(many.sum(), bool))]
        keep = ~many & np.repeat(size > 1, size)
        c, f = cell[keep], fp[keep]
        d = distances(f)
        for gap in range(1, min(CROWD, len(c))):
            i = np.flatnonzero(c[gap:] == c[:-gap])
            if not len(i):
                break
            i = i[np.abs(d[i] - d[i + gap]).max(axis=1) <= MAX_DISTANCE]
            i = i[np.bitwise_count(f[i].view(np.uint64) ^ f[i + gap].view(np.uint64)) <= MAX_DISTANCE]
            out.append((f[i], f[i + gap], np.zeros(len(i), bool)))
        a, b, crowded = (np.concatenate(x) for x in zip(*out))
        return pd.DataFrame({"a": a, "b": pd.array(b, dtype="Int64").copy()}).assign(
            b=lambda x: x["b"].mask(crowded)).drop_duplicates()

    for batch in batches:
        cell = np.r_[cell, batch["cell"].to_numpy(np.int64)]
        fp = np.r_[fp, batch["fp"].to_numpy(np.int64)]
        last = np.searchsorted(cell, cell[-1]) if len(cell) else 0
        if last:
            yield links(cell[:last], fp[:last])
            cell, fp = cell[last:], fp[last:]
        if len(cell) > CROWD + 1:  # already known to be crowded: all but what shows it can go
            yield pd.DataFrame({"a": fp[CROWD + 1:], "b": pd.array([None] * (len(fp) - CROWD - 1), dtype="Int64")})
            cell, fp = cell[:CROWD + 1], fp[:CROWD + 1]
    yield links(cell, fp)


def fingerprint_links(classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that connect every
    pair within two bits (directly, or in a star through a third one that is
    within two bits of both)."""
    cells = classes.select("fp").mapInPandas(_to_cells, "cell long, fp long")
    met = written(cells.repartition("cell").sortWithinPartitions("cell")
                  .mapInPandas(_compare, "a long, b long"), "simhash-met")
    crowded = met.filter("b is null").select(F.col("a").alias("fp")).distinct()
    bits = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    ball = (crowded.select("fp", F.explode(F.transform(bits, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
            .groupBy("point").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1))
    stars = ball.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).filter("a != b")
    return met.filter("b is not null").union(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """One row per document: the id, ``fp``, ``text_key``, ``class_fp`` (the
    component's smallest fingerprint, as a signed long) and ``component_id``
    (smallest id reachable by links of at most two bits, its own included)."""
    rows = written(with_fingerprint(docs.select(id_col, text), text, shingle)
                   .select(id_col, "fp", text_key(text).alias("text_key")), "simhash-fp")
    classes = written(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-class")
    found = components(fingerprint_links(classes), "a", "b", "simhash-links")
    joined = (classes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("class_fp", F.coalesce("component", "fp")))
    least = joined.groupBy("class_fp").agg(F.min("least").alias("component_id"))
    return rows.join(joined.select("fp", "class_fp").join(least, "class_fp"), "fp")


def hex16(c) -> F.Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One document of each component stays: the one with the smallest
    (doc_id, text key), nulls first; of repeated rows one."""
    rows = near_duplicates(docs, shingle=shingle)
    one, two, key = (unused(docs, c) for c in ("kept_id", "kept_key", "text_key"))
    kept = rows.groupBy("class_fp").agg(F.min(F.struct("doc_id", "text_key")).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias(one), F.col("k.text_key").alias(two))
    keyed = docs.withColumn(key, text_key())
    return (keyed.join(kept, F.col("doc_id").eqNullSafe(F.col(one)) & (F.col(key) == F.col(two)))
            .drop(one, two).dropDuplicates(["doc_id", key]).select(*docs.columns))
