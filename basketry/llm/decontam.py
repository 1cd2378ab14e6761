"""Benchmark decontamination, with DataFrame operations only.

Benchmark items become windows of ``WINDOW`` consecutive words (an item of
fewer words is one window).  What is broadcast is a filter of their hashes, a
mask of 64 bits in ``BLOCK`` slots at most and about 20 bytes a window before
that; each document's word windows are hashed in place and looked up there, so
one narrow row per document and per window that passes is all that is written
and shuffled.  These windows are joined with those of the benchmark and verified
word by word before they count, so a crowded filter costs rows, not hits.

Words are runs of characters other than ASCII non-letters and non-digits;
only A-Z is lower-cased.  Hashes are taken of fully lower-cased words, which
can only add candidates; the verification uses the exact rule.

Defined results: a null or empty text has no words, no hits and is clean;
items without words have no window; repeated items with one id count once, a
null item id is left out of the item list; repeated documents keep their own
row each; empty tables give no rows or no hits; other columns are ignored.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_key, unused, written

WINDOW = 10
BLOCK = 1 << 22         # slots of the broadcast filter at most
FEW = 50_000            # benchmark windows, with their words, that are broadcast at most
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def plain(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, UPPER, LOWER))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def window_hashes(hashes: Column, length: int) -> Column:
    """Hash of each window of ``length`` words, by its position."""
    n = F.size(hashes) - F.lit(length)
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.xxhash64(
        F.lit(length), *[F.get(hashes, i + F.lit(j)) for j in range(length)]))
    ).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: ``h, len, gram`` (the words) and ``items``."""
    parts = int(benchmark.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = (benchmark.select("item_id", "text").repartition(parts, "item_id", "text")
             .select("item_id", words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
             .withColumn("len", F.least(F.size("w"), F.lit(window))).withColumn("hw", word_hashes(F.col("w"))))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + F.lit(1)))
    grams = items.select("item_id", "len", "w", "hw", starts.alias("at")).select(
        "item_id", "len", plain(F.slice("w", F.col("at"), F.col("len"))).alias("gram"))
    by_len = reduce(lambda c, n: c.when(F.col("len") == n, window_hashes(word_hashes(F.col("gram")), n)[0]),
                    range(2, window + 1), F.when(F.col("len") == 1, window_hashes(word_hashes(F.col("gram")), 1)[0]))
    return (grams.groupBy("len", "gram").agg(F.collect_set("item_id").alias("items"))
            .select(by_len.alias("h"), "len", "gram", "items"))


def _bits(h: Column) -> Column:
    """A mask with three bits (or fewer, if they are the same) chosen by a hash."""
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63).cast("long")).cast("int"))
            for at in (58, 52, 46)]
    return reduce(Column.bitwiseOR, bits)


def window_filter(grams: DataFrame, slots: int) -> DataFrame:
    """``slot, mask``: the bits of all windows whose hash falls into the slot.
    Slot 0 is always there."""
    first = grams.sparkSession.range(1).select(F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("mask"))
    rows = grams.select(F.pmod("h", F.lit(slots).cast("long")).alias("slot"), _bits(F.col("h")).alias("mask"))
    return rows.unionByName(first).groupBy("slot").agg(F.bit_or("mask").alias("mask"))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
              block: int = BLOCK) -> DataFrame:
    """One row per distinct (id, text): ``id, text_key, copies, n_words`` and
    ``hits``, an array of verified (pos, len, items)."""
    grams = written(benchmark_windows(benchmark, window), "bench-windows")
    facts = grams.agg(F.count("*"), F.collect_set("len")).first()
    lengths = sorted(facts[1])
    slots = max(1, min(block, facts[0] // 2))
    hashed = (docs.select(F.col(id_col).alias("id"), text_key().alias("text_key"),
                          words_of(F.col("text")).alias("w"))
              .withColumn("hw", word_hashes(F.col("w"))))
    # the zero in front passes for every document: it carries the word count
    hashed = hashed.select("id", "text_key", "w", F.concat(
        F.array(F.lit(0).cast("long")), *[window_hashes(F.col("hw"), n) for n in lengths]).alias("v"))
    at, head = F.col("at"), F.col("at") == 0
    length, base, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1)
    for n in lengths:  # windows of each length follow one another in v
        end = before + F.greatest(F.size("w") - F.lit(n - 1), F.lit(0))
        here = (at >= before) & (at < end)
        length, base, before = F.when(here, F.lit(n)).otherwise(length), F.when(here, before).otherwise(base), end
    bits = _bits(F.col("h"))
    # outer: v is never empty, and no filter on its size is then derived and pushed down
    passed = (hashed.select("id", "text_key", "w", F.posexplode_outer("v").alias("at", "h"))
              .join(F.broadcast(window_filter(grams, slots)),
                    (F.pmod("h", F.lit(slots).cast("long")) == F.col("slot")) &
                    (head | (F.col("mask").bitwiseAND(bits) == bits)))
              .select("id", "text_key", F.when(head, F.size("w")).alias("n_words"), F.when(~head, at - base).alias("pos"),
                      length.alias("len"), F.when(~head, F.slice("w", at - base + F.lit(1), length)).alias("words"), "h"))
    passed = written(passed, "passed-windows")
    found = passed.filter(F.col("n_words").isNull()).select("id", "text_key", "pos", "len", "h", plain(F.col("words")).alias("gram"))
    hits = found.join(F.broadcast(grams) if facts[0] <= FEW else grams, ["h", "len", "gram"]).select(
        "id", "text_key", F.struct("pos", "len", "items").alias("hit"))
    heads = passed.filter(F.col("n_words").isNotNull()).select("id", "text_key", "n_words")
    return heads.unionByName(hits, allowMissingColumns=True).groupBy("id", "text_key").agg(
        F.count("n_words").alias("copies"), F.max("n_words").alias("n_words"), F.collect_set("hit").alias("hits"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Contract columns of ``op6``, one row per document."""
    rows = find_hits(docs, benchmark, window)
    hit_words = F.size(F.array_distinct(F.flatten(F.transform(
        "hits", lambda h: F.sequence(h["pos"], h["pos"] + h["len"] - F.lit(1)))))).cast("long")
    items = F.array_sort(F.transform(F.array_distinct(F.flatten(F.col("hits.items"))), lambda i: i.cast("string")))
    return (rows.withColumn("items", items).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(F.col("id").alias("doc_id"), F.col("n_words").cast("long"), hit_words.alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    (hit_words > 0).alias("contaminated")))


def _joined(docs: DataFrame, hits: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with hit rows ``(id, text_key, ...)`` of the same documents."""
    one, two, key = (unused(docs, c) for c in ("hit_id", "hit_key", "text_key"))
    hits = hits.withColumnsRenamed({"id": one, "text_key": two})
    return docs.withColumn(key, text_key()).join(
        hits, F.col("doc_id").eqNullSafe(F.col(one)) & (F.col(key) == F.col(two)), how)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, as they were."""
    bad = find_hits(docs, benchmark, window).filter(F.size("hits") > 0).select("id", "text_key")
    return _joined(docs, bad, "left_anti").select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, mark: str = " ") -> DataFrame:
    """The documents with every hit word cut out: each run of hit words is
    replaced by ``mark``; clean documents stay as they were."""
    at = unused(docs, "hit_at")
    hits = find_hits(docs, benchmark, window).filter(F.size("hits") > 0).select(
        "id", "text_key", F.array_sort(F.array_distinct(F.flatten(F.transform(
            "hits", lambda h: F.sequence(h["pos"], h["pos"] + h["len"] - F.lit(1)))))).alias(at))
    joined = _joined(docs, hits, "left")
    # gaps[i] stands before word i; a dropped word goes with the gap after it
    gaps, words = F.split(F.col("text"), WORD), words_of(F.col("text"))
    kept = F.aggregate(
        F.arrays_zip(words.alias("w"), F.slice(gaps, 2, F.size(words)).alias("g")),
        F.struct(gaps[0].alias("out"), F.lit(0).alias("i"), F.lit(False).alias("cut")),
        lambda s, x: F.struct(
            F.when(F.array_contains(at, s["i"]), F.when(s["cut"], s["out"]).otherwise(F.concat(s["out"], F.lit(mark))))
            .otherwise(F.concat(s["out"], x["w"], x["g"])).alias("out"),
            (s["i"] + F.lit(1)).alias("i"), F.array_contains(at, s["i"]).alias("cut")), lambda s: s["out"])
    return joined.withColumn("text", F.when(F.col(at).isNull(), F.col("text")).otherwise(kept)).select(*docs.columns)
