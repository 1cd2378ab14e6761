"""Helpers shared by the operators: written cuts of the lineage, gapless row
numbers, connected components, and files in the session's shared folder."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.shared import fresh_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder (``spark.checkpoint.dir``) not used before."""
    return fresh_folder(spark, f"llm-{name}")


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: later
    steps read the files, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name`` with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def kept_apart(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with its columns of the given names renamed by underscores before
    them, so that an operator can add columns of these names."""
    for name in names:
        clash = next((c for c in df.columns if c.lower() == name.lower()), None)
        if clash:
            df = df.withColumnRenamed(clash, unused(df, "_" + clash))
    return df


def text_key(text: str = "text"):
    """64-bit key of a text; null and empty differ."""
    return F.xxhash64(F.col(text), F.length(text))


def numbered(df: DataFrame, order: list[str], name: str, out: str = "row_number") -> tuple[DataFrame, int]:
    """Adds a column ``out`` (not one of the table's) with 0..n-1 in the order of
    the given columns (nulls first) and returns the table with n.

    Rows are range-partitioned and sorted, and each row's partition and local
    position are *written*, so counts and rows come from the same files.  A
    seeded random column breaks ties, so that equal rows spread over
    partitions; equal rows get consecutive numbers in any order.
    """
    tie, part, local, n, first = (unused(df, c) for c in ("_tie", "_part", "_local", "_n", "_before"))
    by = [*[F.col(c).asc_nulls_first() for c in order], F.col(tie)]
    ranged = (df.withColumn(tie, F.rand(7)).repartitionByRange(*by).sortWithinPartitions(*by).drop(tie)
              .withColumn(part, F.spark_partition_id())
              .withColumn(local, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    t = written(ranged, name)
    counts = t.groupBy(part).agg(F.count("*").alias(n))
    # one row per partition, so the unpartitioned window is small
    before = F.coalesce(F.sum(n).over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(part, before.alias(first))
    total = counts.agg(F.sum(n)).first()[0] or 0
    return t.join(offsets, part).withColumn(out, F.col(first) + F.col(local)).drop(part, local, first), int(total)


def hash_sample(df: DataFrame, key, rows: int) -> DataFrame:
    """About ``rows`` rows, never more: those whose key's hash lies in the
    matching share of its range.  For samples that are sent to the driver."""
    n = df.count()
    share = min(1.0, rows / max(1, n))
    low = F.pmod(F.xxhash64(key), F.lit(1 << 53)) < F.lit(int(share * (1 << 53)) + 1)
    return df.filter(low).limit(rows)


def components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Connected components of an undirected edge list: ``node, component``
    (the smallest node reachable) for every node that has an edge.

    Alternating large-star and small-star rounds (min per node by partial
    aggregation, then a join), each written to the shared folder, until a
    round changes nothing.
    """
    e = written(edges.filter(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), name)
    seen = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())
        large = written(large, name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = written(small, name)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
             .union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def open_fs(uri: str):
    """(filesystem, path) of a shared-folder URI, for use inside tasks."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)
