"""Sequence packing by cutting-stock column generation.

Each document's ids are cut into pieces of ``capacity`` and one remainder.
Pieces are counted by length class (``STEP`` ids wide; a class is as long as
its longest piece), which gives a histogram of at most capacity/STEP numbers,
whatever the input.  On it a linear program over patterns (how many pieces of
each class share a sequence) is solved by column generation: a dense simplex
on the histogram's rows, with an unbounded-knapsack dynamic program that
prices new patterns.  Pattern counts are rounded down and the few pieces left
(bounded by the histogram, not the input) are packed best-fit.

Pieces are ranked within their class by per-partition counts and offsets (a
row per input task and class, joined as the planner sees fit), and rank ranges
map to pattern instances, a look-up in a table bounded by the histogram.

``pack_and_read`` moves ids in two bytes each where the vocabulary allows, and
writes padded token rows with a piece table per row; pieces are cut out of the
written rows again.

Defined results: a null or empty text is the end id alone; repeated rows and
ids are packed each on their own; ties in length are ranked by input
partition and position; an empty table gives no rows; other columns are
ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import written
from .encode import encoder, vocabulary_size

CAPACITY = 1024
STEP = 8
MAX_PIVOTS = 20_000
_EPS = 1e-9

_PIECE = ("doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, class int, part int, "
          "nth long{}")


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, step: int = STEP, end_id: int = 0,
               width: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens``, its
    length ``class``, the task ``part`` and ``nth`` piece of that class there
    (and ``ids``, little-endian with ``width`` bytes each, if that is 2 or 4)."""
    kind = docs.schema["doc_id"].dataType
    schema = T._parse_datatype_string(_PIECE.format(kind.simpleString(), ", ids binary" if width else ""))
    tail = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = encoder(vocabulary), TaskContext.get().partitionId()
        seen = [0] * (-(-capacity // step) + 1)
        for batch in batches:
            out = {f.name: [] for f in schema if f.name != "doc_id"}
            src = []
            for row, text in enumerate(batch.column("text")):
                ids = memoryview(code.ids(text.as_py()) + tail)
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start:4 * (start + capacity)]
                    c = -(-len(piece) // (4 * step))
                    src.append(row)
                    for k, v in (("start", start), ("length", len(piece) // 4), ("ids_crc32", zlib.crc32(piece)),
                                 ("doc_tokens", total), ("class", c), ("part", part), ("nth", seen[c])):
                        out[k].append(v)
                    if width:
                        out["ids"].append(bytes(piece) if width == 4 else np.frombuffer(piece, "<u4").astype("<u2").tobytes())
                    seen[c] += 1
            ids_of = batch.column("doc_id").take(pa.array(src, pa.int64()))
            types = {"class": pa.int32(), "part": pa.int32(), "ids": pa.binary()}
            yield pa.RecordBatch.from_arrays(
                [ids_of, *[pa.array(v, types.get(k, pa.int64())) for k, v in out.items()]], ["doc_id", *out])
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def best_pattern(value: np.ndarray, size: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the counts of greatest total value within ``room``."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        best[r] = best[r - 1]
        fits = np.flatnonzero(size <= r)
        if len(fits):
            gain = best[r - size[fits]] + value[fits]
            k = int(gain.argmax())
            if gain[k] > best[r] + _EPS:
                best[r], pick[r] = gain[k], fits[k]
    counts, r = np.zeros(len(size), np.int64), room
    while r > 0:
        if pick[r] < 0:
            r -= 1
        else:
            counts[pick[r]] += 1
            r -= size[pick[r]]
    return float(best[room]), counts


def plan_patterns(demand: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ``({class: pieces}, times)`` that place every piece.  Classes
    are in units of STEP, ``room`` is the capacity in those units."""
    size = np.array(sorted(c for c, n in demand.items() if n > 0), dtype=np.int64)
    if not len(size):
        return []
    need = np.array([demand[int(c)] for c in size], dtype=np.float64)
    patterns = np.diag(room // size)  # columns: each class on its own
    inverse = np.diag(1.0 / (room // size))
    amount = inverse @ need
    for _ in range(MAX_PIVOTS):
        price = inverse.sum(axis=0)
        worth, column = best_pattern(price, size, room)
        if worth <= 1 + 1e-7:
            break
        way = inverse @ column
        ratio = np.where(way > 1e-10, amount / np.where(way > 1e-10, way, 1), np.inf)
        out = int(ratio.argmin())
        amount = amount - ratio[out] * way
        amount[out] = ratio[out]
        patterns[:, out] = column
        row = inverse[out] / way[out]
        inverse = inverse - np.outer(way, row)
        inverse[out] = row
    else:
        raise RuntimeError("the simplex did not end")  # a plan would still be whole, but not the least
    left = need.astype(np.int64)
    result: list[tuple[dict[int, int], int]] = []
    for k in np.argsort(-amount):
        used = patterns[:, k] > 0
        times = min(int(amount[k] + 1e-6), int((left[used] // patterns[used, k]).min()))
        if times > 0:
            left = left - times * patterns[:, k]
            result.append(({int(c): int(a) for c, a in zip(size[used], patterns[used, k])}, times))
    while left.any():  # the largest pieces first, each bin filled with the largest that fit
        space, bin_ = room, {}
        for i in reversed(range(len(size))):
            take = min(int(left[i]), space // int(size[i]))
            if take:
                bin_[int(size[i])] = take
                space -= take * int(size[i])
        times = min(int(left[i]) // bin_[int(c)] for i, c in enumerate(size) if int(c) in bin_)
        left = left - times * np.array([bin_.get(int(c), 0) for c in size])
        result.append((bin_, times))
    return result


def rank_ranges(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Look-up rows ``(class, low, high, per, first_sequence, slot)``: ranks
    low..high-1 of a class go ``per`` to a sequence, from ``first_sequence``."""
    rows, taken, sequence = [], {}, 0
    for counts, times in patterns:
        slot = 0
        for c in sorted(counts, reverse=True):
            low = taken.get(c, 0)
            taken[c] = low + counts[c] * times
            rows.append((c, low, taken[c], counts[c], sequence, slot))
            slot += counts[c]
        sequence += times
    return rows


def _placed(docs: DataFrame, vocabulary: str, capacity: int, step: int, end_id: int, width: int) -> DataFrame:
    """Pieces with their sequence and their ``slot``, the place among its pieces."""
    if capacity % step:
        raise ValueError("capacity must be a multiple of step")
    spark = docs.sparkSession
    pieces = written(cut_pieces(docs, vocabulary, capacity, step, end_id, width), "pack-pieces",
                     compression="zstd" if width else None)
    counts = pieces.groupBy("class", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("class").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # written, so that the planner knows its size: small, it is broadcast and the ids stay where they are
    offsets = written(counts.select("class", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                      "pack-offsets")
    demand = {r[0]: r[1] for r in offsets.groupBy("class").agg(F.sum("n")).collect()}  # at most capacity/step rows
    places = spark.createDataFrame(
        rank_ranges(plan_patterns(demand, capacity // step)),
        "class int, low long, high long, per long, first_sequence long, slot long")
    at = F.col("rank") - F.col("low")
    ranked = pieces.join(offsets.drop("n"), ["class", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    return (ranked.join(F.broadcast(places), ["class"]).filter("rank >= low and rank < high")
            .withColumn("sequence_id", F.col("first_sequence") + F.floor(at / F.col("per")))
            .withColumn("slot", F.col("slot") + at % F.col("per"))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot",
                    *(["ids"] if width else [])))


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY, step: int = STEP,
         end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Every piece with its place: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset`` (and ``ids``, little-endian unsigned 32-bit)."""
    in_sequence = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    return _placed(docs, vocabulary, capacity, step, end_id, 4 if with_ids else 0).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(in_sequence), F.lit(0)).alias("offset"), *(["ids"] if with_ids else []))


def _row_ids(ids: Column, n_tokens: Column, capacity: int, pad_id: int, width: int) -> Column:
    """All ids of a sequence, padded to the capacity unless their number is a power of two."""
    joined = F.reduce(ids, F.lit(b""), lambda a, b: F.concat(a, b))
    power = n_tokens.bitwiseAND(n_tokens - 1) == 0
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(width, "little").hex()), (F.lit(capacity) - n_tokens).cast("int")))
    return F.when(power, joined).otherwise(F.concat(joined, pad))


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The token rows of ``pack(..., with_ids=True)``: ``sequence_id,
    n_tokens, ids`` (binary), padded to the capacity unless the length is a
    power of two."""
    rows = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return rows.select("sequence_id", "n_tokens", _row_ids(F.col("p.ids"), F.col("n_tokens"), capacity, pad_id, 4).alias("ids"))


def token_rows(placed: DataFrame, capacity: int, pad_id: int, width: int) -> DataFrame:
    """Token rows ``sequence_id, n_tokens, ids`` with ``pieces``, the documents'
    pieces in the order of their places."""
    piece = ["doc_id", "start", "length", "doc_tokens"]
    rows = placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("slot", F.struct(*piece).alias("piece"), "ids")))
        .alias("p"))
    return rows.select("sequence_id", "n_tokens", _row_ids(F.col("p.ids"), F.col("n_tokens"), capacity, pad_id, width).alias("ids"),
                       F.col("p.piece").alias("pieces"))


def read_pieces(rows: DataFrame, width: int, with_ids: bool = False) -> DataFrame:
    """The pieces cut out of written ``token_rows``, with the CRC-32 of the ids
    found there: the columns of ``pack``."""
    kind = rows.schema["pieces"].dataType.elementType["doc_id"].dataType
    schema = T._parse_datatype_string("doc_id " + kind.simpleString() + ", start long, length long, ids_crc32 long,"
                                      " doc_tokens long, sequence_id long, offset long" + (", ids binary" if with_ids else ""))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            counts, pieces = lists.value_lengths().to_numpy(), lists.flatten()
            doc_id, start, length, total = (pieces.field(k) for k in range(4))
            sizes = length.to_numpy()
            offset = np.cumsum(sizes) - sizes
            offset -= np.repeat(offset[np.minimum(np.cumsum(counts) - counts, max(0, len(sizes) - 1))], counts) if len(sizes) else 0
            found, at = [], 0
            for row, n in enumerate(counts):
                ids = np.frombuffer(batch.column("ids")[row].as_buffer(), f"<u{width}").astype("<u4")
                for k in range(at, at + n):
                    found.append(ids[offset[k]:offset[k] + sizes[k]])
                at += n
            out = [doc_id, start, length, pa.array([zlib.crc32(x) for x in found], pa.int64()), total,
                   pa.array(np.repeat(batch.column("sequence_id").to_numpy(), counts)), pa.array(offset)]
            if with_ids:
                out.append(pa.array([x.tobytes() for x in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, schema.names)
    return rows.select("sequence_id", "ids", "pieces").mapInArrow(cut, schema)


def pack_and_read(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY, end_id: int = 0,
                  with_ids: bool = False) -> DataFrame:
    """Packs, writes the padded token rows to the shared folder, and returns
    the pieces as read from them (with ``ids`` as unsigned 32-bit, if asked for)."""
    width = 2 if max(end_id, vocabulary_size(vocabulary) - 1) < 1 << 16 else 4
    placed = _placed(docs, vocabulary, capacity, STEP, end_id, width)
    rows = written(token_rows(placed, capacity, end_id, width), "pack-sequences", compression="zstd")
    return read_pieces(rows, width, with_ids)
