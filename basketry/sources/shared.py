"""Tables cut from their lineage: written to the session's shared folder and
read back, so a lost executor costs no recomputation."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def session_folder(spark: SparkSession) -> str:
    """This session's own folder under that of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/basketry-cut/{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder in the session's own not used before."""
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def discard_intermediates(spark: SparkSession) -> None:
    """Deletes what this session has written in between.  To be called when the
    results that read it (lazily) are written or no longer wanted."""
    at = spark._jvm.org.apache.hadoop.fs.Path(session_folder(spark))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table under the folder of ``spark.checkpoint.dir``."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The Parquet table at ``path``; None if there is none.  With a schema, a
    folder that a stopped write left without files is an empty table."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
