"""File sources and sinks.

Raw files are read with an explicit schema (no inference pass over the data)
and in PERMISSIVE mode, so malformed records become nulls that the quality
checks count instead of failing the load.
"""
from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import as_of_literal
from ..session import ensure_checkpoint_dir
from .shared import read_if_there

WORKERS = 4  # independent tables that are written side by side


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder inside the session's shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/basketry-io/{name}-{uuid.uuid4().hex[:12]}"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with an explicit schema."""
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
                 .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def ingest_with_lineage(df: DataFrame, ingested_at=None) -> DataFrame:
    """Add ``_ingestion_timestamp`` (a fixed time, default now) and
    ``_source_file`` (base name of the file each row came from)."""
    ts = as_of_literal(ingested_at or _dt.datetime.now().replace(microsecond=0))
    return df.select("*", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("_ingestion_timestamp"),
                     F.col("_metadata.file_name").alias("_source_file"))


def scan_json_payload(spark: SparkSession, path: str, schema: T.StructType, source: str,
                      ingested_at=None, multi_line: bool = True) -> DataFrame:
    """S3: an API payload saved as JSON — a list of objects gives one row per
    object, a single object one row — plus ``_ingestion_timestamp`` and
    ``_source_api``."""
    df = (spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
               .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").json(path))
    ts = as_of_literal(ingested_at or _dt.datetime.now().replace(microsecond=0))
    return df.select("*", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("_ingestion_timestamp"),
                     F.lit(source).alias("_source_api"))


def write_counted(df: DataFrame, path: str, *more: Column, **options: str) -> dict:
    """Writes a table (replacing what is there) and returns what was counted on
    the way: ``rows`` and the aggregates ``more``.  Nothing is read again."""
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows"), *more).write.mode("overwrite").options(**options).parquet(path))
    return seen.get


LOADS = "load_ts string, records long, committed_at timestamp_ntz"


def land_timestamped(df: DataFrame, base: str, name: str, loaded_at=None) -> str:
    """Land a load under ``{base}/{name}/load_ts=YYYYmmdd_HHMMSS``; returns
    the load id.

    A load is committed by its row under ``{base}/loads/{name}``, written after
    the data.  A load that was stopped before can be repeated: what it left is
    replaced.  A committed load is never written again, so repeating it changes
    nothing, and other loads are not touched."""
    load = (loaded_at or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    spark, done = df.sparkSession, f"{base}/loads/{name}/id={load}"
    committed = read_if_there(spark, done, LOADS)
    if committed is None or not committed.head(1):
        records = write_counted(df, f"{base}/{name}/load_ts={load}")["rows"]
        row = spark.createDataFrame([(load, records, _dt.datetime.now().replace(microsecond=0))], LOADS)
        row.coalesce(1).write.mode("overwrite").parquet(done)
    return load


def read_landed(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Rows of all committed loads with their ``load_ts``."""
    loads = spark.read.parquet(f"{base}/loads/{name}").select("load_ts")  # one row per load
    rows = spark.read.parquet(f"{base}/{name}").withColumn("load_ts", F.col("load_ts").cast("string"))
    return rows.join(loads, "load_ts", "left_semi")


def sink_json(df: DataFrame, path: str) -> None:
    """Keep the raw payload as JSON lines beside the table."""
    df.write.mode("overwrite").json(path)


def sink_table(df: DataFrame, path: str) -> None:
    """Write a cleaned / feature table as Parquet."""
    df.write.mode("overwrite").parquet(path)


def sink_tables(tables: dict[str, DataFrame], base: str) -> DataFrame:
    """S7 + S8: write independent tables, some at a time, and return record
    count and column list of each, counted while they were written."""
    def one(item):
        name, df = item
        return (name, write_counted(df, f"{base}/{name}")["rows"], len(df.columns), ",".join(df.columns))
    with ThreadPoolExecutor(WORKERS) as pool:
        rows = list(pool.map(one, tables.items()))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table string, record_count long, n_columns int, columns string")


INGESTION_REPORT = ("source string, records long, status string, source_type string, error string,"
                    " started_at timestamp, ended_at timestamp")


def ingestion_report(spark: SparkSession, loaders: dict, base: str, source_types: dict | None = None,
                     clock=None) -> DataFrame:
    """Loads each source into ``{base}/{name}``; one row per source with
    records, status, source type, error, start and end time.

    ``loaders`` maps a source name to a zero-argument callable returning a
    DataFrame.  Each source is written in a job of its own and counted on the
    way, so a failure while planning or while reading is recorded with its whole
    text and does not stop the others; only the outcome rows pass through the
    driver.
    """
    clock = clock or _dt.datetime.now

    def one(item):
        (name, load), started, records, error = item, clock(), None, None
        try:
            records = write_counted(load(), f"{base}/{name}")["rows"]
        except Exception as e:  # noqa: BLE001 - isolate per-source failures
            error = str(e)
        return (name, records, "failed" if error is not None else "success",
                (source_types or {}).get(name, "parquet"), error, started, clock())
    with ThreadPoolExecutor(WORKERS) as pool:
        return spark.createDataFrame(list(pool.map(one, loaders.items())), INGESTION_REPORT)
