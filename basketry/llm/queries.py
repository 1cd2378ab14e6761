"""Registered queries ``opN_<name>`` and their DuckDB SQL.

Each query applies its operator to the whole of its table with production
parameters and derives the contract's columns from the operator's output.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontam, embeddings, langid, packing, prefixtrie, rtree, sharding, simhash, tokencount, tokenfile,
               toxicity, warc)
from .common import fresh_path, written
from .oracle import ORACLE  # noqa: F401 - registered with the queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PROBE_TEXT = r"\### Assistant: </turn> ok"


@query
def op1_chat_format(spark, sf_dir):
    """All conversations, and conversation -7 whose texts hold control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    return chat.format_digest(chat.format_trees(chat.threads(rows.unionByName(probe))))


@query
def op2_feistel_shards(spark, sf_dir):
    """All documents into 24 shards."""
    return sharding.document_shards(table(spark, sf_dir, "documents"), 24)


@query
def op3_simhash_pivots(spark, sf_dir):
    """Near-duplicate components of all documents: three-word shingles, two bits."""
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3)
    return rows.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op6_decontaminate(spark, sf_dir):
    """Benchmark hits of all documents."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def revision(text):
    """Three edits of a text, placed by its hash: an insertion, a deletion and a
    replacement."""
    size = F.coalesce(F.length(text), F.lit(0)) + F.lit(1)

    def edit(k, length, new):
        return F.struct(F.pmod(F.xxhash64(text, F.lit(k)), size).cast("int").alias("start"),
                        F.lit(length).alias("length"), F.lit(new).alias("new"))
    return F.array(edit(1, 0, " [edited]"), edit(2, 12, ""), edit(3, 5, " 2024-01-01,\n"))


@query
def op7_edit_counts(spark, sf_dir):
    """Token counts of all documents, and again after a revision of each."""
    first = written(tokencount.build_state(table(spark, sf_dir, "documents")), "count-state")
    state = first.withColumnRenamed("n_tokens", "before").withColumnRenamed("n_encoded", "all_pretokens")
    after = tokencount.apply_own_edits(state.withColumn("edits", revision(F.col("text"))),
                                       keep=["before", "all_pretokens"])
    return after.select("doc_id", F.col("before").alias("n_tokens_before"), F.col("n_tokens").alias("n_tokens_after"),
                        "n_edits", F.col("all_pretokens").alias("n_pretokens"), F.col("n_encoded").alias("n_reencoded"),
                        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


@query
def op8_pack_sequences(spark, sf_dir):
    """All documents packed into written sequences of 1024 ids, and read from them."""
    return packing.pack_and_read(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", capacity=1024, end_id=0)


@query
def op9_token_planes(spark, sf_dir):
    """All documents written as token-id files and read back."""
    folder = fresh_path(spark, "token-files")
    manifest = tokenfile.write_files(table(spark, sf_dir, "documents"), "word_bpe_49k.json", end_id=1, folder=folder)
    return tokenfile.read_files(manifest, folder)


@query
def op4_warc_zstd(spark, sf_dir):
    """All pages written as WARC archives and read back."""
    folder = fresh_path(spark, "warc")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(manifest, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_language_crf(spark, sf_dir):
    """Languages of all documents, learned from those not held out."""
    return langid.predict_languages(table(spark, sf_dir, "documents"))


@query
def op10_itq_near_duplicates(spark, sf_dir):
    """Embeddings linked at a cosine of 0.95 or more."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query
def op11_rtree_hard_negatives(spark, sf_dir):
    """Hard negatives of every anchor among all embeddings."""
    return rtree.hard_negatives(table(spark, sf_dir, "embeddings"))


@query
def op12_toxicity_mil(spark, sf_dir):
    """Toxicity of all documents, learned from those not held out."""
    return toxicity.document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_prefix_trie(spark, sf_dir):
    """Nodes of the prefix trie of all conversations, rebuilt with shared heads."""
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))
