"""Corpus pipeline: ``documents`` through language ID, near-dedup,
decontamination and packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each stage's rows as Parquet to the session's shared folder and reads
them back as the next stage's documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontam, langid, packing, simhash
from basketry.llm.common import unused, written

#: A document is rejected as of no language if its words' best labels are less
#: certain than this on average (0 is chance), however many languages share it.
LEAST_CERTAINTY = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; text without letters goes."""
    model = langid.train(docs.filter(~langid.held_out()).select("lang", "text"))
    out = unused(docs, "language")
    seen = langid.identify(docs, model, out=out)
    return seen.filter((F.col(f"{out}.lang_pred") != langid.UNKNOWN) & (F.col(f"{out}.certainty") >= LEAST_CERTAINTY)) \
        .select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.drop_near_duplicates(docs, shingle=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, read from written sequences of 1024 ids."""
    return packing.pack_and_read(docs, "byte_bpe_50k.json", capacity=1024, end_id=0, with_ids=True)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("pack", pack)]

#: The stages learn models, hash and tokenize: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return docs
