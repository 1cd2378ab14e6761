"""Reproducible shuffle into shards: a Feistel permutation over global row
numbers, with DataFrame operations only.

Rows are numbered 0..n-1 by the given order.  The permutation works on pairs
(left, right) with left < a, right < b and a*b just over n; values at or over
n are permuted again (cycle walking) until they are under n.  Position p of
the shuffle lies in shard ``p mod shards`` at slot ``p div shards``, so shard
sizes differ by one row at most and slots have no gaps.

Defined results: a null text has no bytes and CRC 0; null order values come
first; equal rows each get a place of their own; an empty table gives no
rows; other columns are kept, those called position, shard or slot with an
underscore before their name.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, kept_apart, numbered, unused

ROUNDS = 8
MAX_WALK = 64
PRIME = 2147483647


def round_keys(seed: int) -> list[int]:
    """One key under 2^31 per round, from a linear congruence."""
    keys, x = [], (seed * 2654435761 + 12345) % PRIME
    for _ in range(ROUNDS):
        x = (x * 48271 + 11) % PRIME
        keys.append(x)
    return keys


def domain(n: int) -> tuple[int, int]:
    """(a, b) with a*b >= n and a*b - n < a."""
    a = max(1, math.isqrt(n))
    return a, max(1, -(-n // a))


def _mix(v: Column, key: Column) -> Column:
    """Pseudo-random value under 2^31; every product stays under 2^62."""
    x = (v + key) % F.lit(PRIME) * F.lit(1103515245) % F.lit(PRIME)
    x = x.bitwiseXOR(F.shiftright(x, 15))
    x = (x * F.lit(1812433253) + key) % F.lit(PRIME)
    return x.bitwiseXOR(F.shiftright(x, 13))


def feistel(x: Column, n: int, seed: int) -> Column:
    """One pass of the permutation of 0..a*b-1."""
    a, b = domain(n)
    low = (x % F.lit(a)).cast("long")
    start = F.struct(low.alias("l"), ((x - low) / F.lit(a)).cast("long").alias("r"))  # exact under 2^53 rows
    keys = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(i % 2 == 0).alias("left"))
                     for i, k in enumerate(round_keys(seed))])
    out = F.aggregate(keys, start, lambda s, k: F.struct(
        F.when(k["left"], (s["l"] + _mix(s["r"], k["k"])) % F.lit(a)).otherwise(s["l"]).cast("long").alias("l"),
        F.when(k["left"], s["r"]).otherwise((s["r"] + _mix(s["l"], k["k"])) % F.lit(b)).cast("long").alias("r")))
    return F.transform(F.array(out), lambda s: s["r"] * F.lit(a) + s["l"])[0]


def permute(x: Column, n: int, seed: int) -> Column:
    """Place of row ``x`` of ``n`` in the shuffle.

    Under one value in sqrt(n) needs another pass; MAX_WALK passes are enough
    for every n up to MAX_WALK squared, and beyond that a longer walk is out of
    reach; should one occur the query fails rather than give a wrong place.
    """
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(MAX_WALK)), feistel(x, n, seed),
                         lambda v, _: F.when(v < n, v).otherwise(feistel(v, n, seed)))
    return F.transform(F.array(walked), lambda v: F.when(v < n, v).otherwise(
        F.raise_error(F.lit("cycle walk too long")).cast("long")))[0]


def assign_shards(rows: DataFrame, order: list[str], shards: int, seed: int = 42) -> DataFrame:
    """Adds ``position, shard, slot`` to every row."""
    rows = kept_apart(rows, "position", "shard", "slot")
    number = unused(rows, "row_number")
    t, n = numbered(rows, order, "shard-rows", out=number)
    if n >= 1 << 53:
        raise ValueError("more than 2^53 rows")
    place = permute(F.col(number), n, seed) if n else F.lit(None).cast("long")
    return (t.withColumn("position", place)
             .withColumn("shard", (F.col("position") % shards).cast("int"))
             .withColumn("slot", F.floor(F.col("position") / shards).cast("long")).drop(number))


def document_shards(docs: DataFrame, shards: int, seed: int = 42) -> DataFrame:
    """Shard and slot of each document, law ``rows``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return (assign_shards(rows, ["doc_id", "text_crc32", "size"], shards, seed)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def write_shards(placed: DataFrame, path: str | None = None, files_per_shard: int = 1) -> str:
    """Writes one folder per shard with rows in slot order: slots are dealt to
    ``files_per_shard`` consecutive ranges per shard, one task each."""
    path = path or fresh_path(placed.sparkSession, "shards")
    (placed.repartitionByRange(placed.select("shard").distinct().count() * files_per_shard or 1, "shard", "slot")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
    return path
