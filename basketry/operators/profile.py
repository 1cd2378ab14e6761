"""Profiling aggregates behind the exploratory report.

Only the data behind each chart is produced; drawing is left to the caller.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max] with every bin present.

    Bin i (1-based) holds min + (i-1)·w <= x < min + i·w, the last bin is
    closed; a constant column falls in the middle bin of [v-0.5, v+0.5].
    Bounds are scalar subqueries; counting is one partial/final aggregate.
    """
    x = F.col(c).cast("double")
    st = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).select(F.struct(
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"),
        F.col("mn").alias("mn")).alias("s"))
    # bounds: one scalar subquery, materialised once per side and read by field
    lo, hi = F.col("_h.lo"), F.col("_h.hi")
    b = F.least(F.floor((x - lo) * (F.lit(float(bins)) / (hi - lo))) + 1, F.lit(bins)).cast("int")
    counts = (df.where(x.isNotNull()).withColumn("_h", st.select("s").scalar())
                .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    width = (hi - lo) / F.lit(float(bins))
    frame = (st.where(F.col("s.mn").isNotNull())
               .select(F.col("s").alias("_h"), F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")))
    return (frame.join(counts, "bin", "left")
                 .select("bin", (lo + (F.col("bin") - 1) * width).alias("bin_lo"),
                         (lo + F.col("bin") * width).alias("bin_hi"),
                         F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def rating_histogram(txn: DataFrame, bins: int = 5) -> DataFrame:
    """Rating distribution in 5 equal-width bins."""
    return histogram(txn, "rating", bins)


def txn_per_user(txn: DataFrame) -> DataFrame:
    """Transactions per user (null users excluded, like value_counts)."""
    return (txn.where(F.col("user_id").isNotNull()).groupBy("user_id")
               .agg(F.count(F.lit(1)).alias("txn_count")))


def txn_per_user_histogram(txn: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram (30 bins) of the number of transactions per user."""
    return histogram(txn_per_user(txn), "txn_count", bins)


def top_k(df: DataFrame, key: str, k: int, count_name: str = "count") -> DataFrame:
    """The k most frequent values (count desc, value asc).  ``limit``
    after ``orderBy`` is a per-partition top-k merged on one task."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
              .orderBy(F.col(count_name).desc(), F.col(key).asc()).limit(k))


def top_products(txn: DataFrame, k: int = 20) -> DataFrame:
    """20 most purchased products."""
    return top_k(txn, "product_id", k, "txn_count")


def category_share(products: DataFrame) -> DataFrame:
    """Products per category and percentage of all products."""
    total = products.select(F.count(F.lit(1))).scalar()
    return (products.where(F.col("category").isNotNull()).groupBy("category")
                    .agg(F.count(F.lit(1)).alias("count"))
                    .withColumn("pct", F.col("count").cast("double") / total.cast("double") * F.lit(100.0)))


def interaction_pivot_long(txn: DataFrame, k: int = 50) -> DataFrame:
    """E5 (long form): mean rating per (user, product) for rows whose user is
    among the top-k users and whose product is among the top-k products.
    The two top-k sets have k rows each, so the semi joins broadcast."""
    users = top_k(txn, "user_id", k).select("user_id")
    prods = top_k(txn, "product_id", k).select("product_id")
    return (txn.join(F.broadcast(users), "user_id", "left_semi")
               .join(F.broadcast(prods), "product_id", "left_semi")
               .groupBy("user_id", "product_id").agg(F.avg("rating").alias("avg_rating")))


def interaction_pivot(txn: DataFrame, k: int = 50) -> DataFrame:
    """E5: user × product matrix of mean ratings (at most k × k cells); column
    ``p<i>`` is the i-th most purchased product, so the columns are known
    without looking at the data."""
    order = Window.orderBy(F.col("count").desc(), "product_id")
    place = top_k(txn, "product_id", k).select("product_id", F.row_number().over(order).alias("place"))  # k rows
    long = interaction_pivot_long(txn, k).join(F.broadcast(place), "product_id")
    wide = long.groupBy("user_id").pivot("place", list(range(1, k + 1))).agg(F.first("avg_rating"))
    return wide.toDF("user_id", *[f"p{i}" for i in range(1, k + 1)])


def txn_by_hour(txn: DataFrame) -> DataFrame:
    """Transactions per hour of day."""
    return txn.groupBy("hour").agg(F.count(F.lit(1)).alias("count")).orderBy("hour")


def txn_by_weekday(txn: DataFrame) -> DataFrame:
    """Transactions per weekday (0 = Monday)."""
    return txn.groupBy("day_of_week").agg(F.count(F.lit(1)).alias("count")).orderBy("day_of_week")


def interaction_sparsity(txn: DataFrame) -> DataFrame:
    """1 - rows / (distinct users × distinct products)."""
    return txn.agg(F.count(F.lit(1)).alias("n_interactions"),
                   F.count_distinct("user_id").alias("n_users"),
                   F.count_distinct("product_id").alias("n_items")).withColumn(
        "sparsity", F.lit(1.0) - F.col("n_interactions").cast("double")
        / (F.col("n_users") * F.col("n_items")).cast("double"))


def data_summary(txn: DataFrame, products: DataFrame, users: DataFrame, clicks: DataFrame) -> DataFrame:
    """One row per table with its headline figures (rounded like the report)."""
    null_l, null_d, null_t = F.lit(None).cast("long"), F.lit(None).cast("double"), F.lit(None).cast("timestamp_ntz")

    def row(table, records, uu=null_l, up=null_l, ar=null_d, cats=null_l, ap=null_d, aa=null_d, et=null_l,
            t0=null_t, t1=null_t):
        return [F.lit(table).alias("table"), records.alias("records"), uu.alias("unique_users"),
                up.alias("unique_products"), ar.alias("avg_rating"), cats.alias("categories"),
                ap.alias("avg_price"), aa.alias("avg_age"), et.alias("event_types"),
                t0.alias("min_timestamp"), t1.alias("max_timestamp")]

    n = F.count(F.lit(1))
    parts = [
        txn.agg(*row("transactions", n, F.count_distinct("user_id"), F.count_distinct("product_id"),
                     F.bround(F.avg("rating"), 2), t0=F.min("timestamp"), t1=F.max("timestamp"))),
        products.agg(*row("products", n, cats=F.count_distinct("category"), ap=F.bround(F.avg("price"), 2))),
        users.agg(*row("users", n, aa=F.bround(F.avg("age"), 1))),
        clicks.agg(*row("clickstream", n, et=F.count_distinct("event_type"))),
    ]
    return reduce(DataFrame.unionByName, parts)
