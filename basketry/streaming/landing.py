"""Incremental landing of raw source files (S2 + S4 as a stream).

New CSV files dropped into a source folder are picked up exactly once by a
Structured Streaming file source, tagged with lineage columns and appended
to a Parquet landing table partitioned by load date.  The stream's
checkpoint records which files were consumed, so a restarted or retried job
neither skips nor duplicates a file.  ``trigger(availableNow=True)`` turns
the same code into a batch catch-up job.
"""
from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def land_csv_stream(spark: SparkSession, source_dir: str, schema: T.StructType, dest: str,
                    checkpoint: str, name: str, available_now: bool = True,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = (spark.readStream.schema(schema).option("header", True).option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir)
    tagged = raw.select(
        "*",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("_ingestion_timestamp"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.lit(name).alias("_source"),
        F.to_date(F.current_timestamp()).alias("load_date"),
    )
    writer = (tagged.writeStream.format("parquet").option("checkpointLocation", checkpoint)
                    .partitionBy("load_date").outputMode("append").queryName(f"land_{name}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(dest)
