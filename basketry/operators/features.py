"""Aggregations, joins and feature jobs.

Shape of every job: aggregate each side by its key first (partial/final hash
aggregate, so hot keys are combined map-side), then join the one-row-per-key
results.  Both sides of those joins come out of aggregates already hash
partitioned on the key, so the join adds no further exchange; dimension
tables are joined last and broadcast by the planner when their measured size
allows.  Sums, means and deviations of doubles are taken in exact units, so a
feature has the same bits whatever the partitioning.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.exprs import (as_of_literal, exact_mean, exact_parts, exact_sum, mean_of_parts, mean_of_row,
                               std_of_parts, whole_days_between)
from ..sources.roles import DEFAULT_AS_OF
from ..sources.shared import materialised
from .quantiles import exact_median


def _count_eq(c: str, value: str):
    return F.count_if(F.col(c) == F.lit(value)).cast("long")


def _flag_any(c: str, value: str):
    return F.max((F.col(c) == F.lit(value)).cast("int"))


# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------

def pair_sums(txn: DataFrame) -> DataFrame:
    """Purchase figures per (user, product), a null key being one like any
    other, that A1, A3 and A5 add up: the rows are combined once for all three."""
    n, units, squares = exact_parts("rating")
    return txn.groupBy("user_id", "product_id").agg(
        F.count("transaction_id").alias("n"), F.sum("quantity").alias("quantity"), F.count("quantity").alias("n_quantity"),
        n.alias("n_rating"), units.alias("units"), squares.alias("squares"),
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


def _purchases(sums: DataFrame, key: str, other: str, n: str, n_other: str, rating: str, total: str, mean: str, *more):
    # a row of ``sums`` is one distinct value of ``other`` for its key
    return (sums.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum("n").alias(n), F.count(other).alias(n_other),
        mean_of_parts("n_rating", "units").alias(f"avg_rating_{rating}"),
        F.coalesce(std_of_parts("n_rating", "units", "squares"), F.lit(0.0)).alias(f"std_rating_{rating}"),
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("long").alias(total),
        F.try_divide(F.sum("quantity").cast("double"), F.sum("n_quantity").cast("double")).alias(mean), *more))


def user_txn_agg(txn: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """A1: per user purchase statistics (``sums``: ``pair_sums`` of ``txn``, if at hand)."""
    return _purchases(pair_sums(txn) if sums is None else sums, "user_id", "product_id", "total_transactions",
                      "unique_products_bought", "given", "total_quantity", "avg_quantity_per_txn",
                      F.min("first").alias("first_purchase"), F.max("last").alias("last_purchase")).select(
        "user_id", "total_transactions", "total_quantity", "avg_rating_given", "std_rating_given",
        "unique_products_bought", "avg_quantity_per_txn", "first_purchase", "last_purchase")


def user_click_agg(clicks: DataFrame) -> DataFrame:
    """A2: per user clickstream statistics."""
    return (clicks.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count("event_id").alias("total_events"),
        F.count_distinct("session_id").alias("total_sessions"),
        exact_mean("page_duration_sec").alias("avg_page_duration"),
        F.count_distinct("product_id").alias("unique_products_viewed"),
        _count_eq("event_type", "add_to_cart").alias("cart_adds"),
        _count_eq("event_type", "search").alias("searches"),
    ))


def item_txn_agg(txn: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """A3: per product purchase statistics (``sums`` as in A1)."""
    return _purchases(pair_sums(txn) if sums is None else sums, "product_id", "user_id", "total_purchases",
                      "unique_buyers", "received", "total_quantity_sold", "avg_quantity_per_purchase").select(
        "product_id", "total_purchases", "unique_buyers", "avg_rating_received", "std_rating_received",
        "total_quantity_sold", "avg_quantity_per_purchase")


def item_click_agg(clicks: DataFrame) -> DataFrame:
    """A4: per product clickstream statistics."""
    return (clicks.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.count("event_id").alias("total_views"),
        F.count_distinct("user_id").alias("unique_viewers"),
        exact_mean("page_duration_sec").alias("avg_view_duration"),
        _count_eq("event_type", "add_to_cart").alias("cart_add_count"),
        _count_eq("event_type", "wishlist_add").alias("wishlist_count"),
    ))


def pair_txn_agg(txn: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """A5: per (user, product) purchase statistics (``sums`` as in A1)."""
    if sums is not None:
        return sums.where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull()).select(
            "user_id", "product_id", mean_of_row("n_rating", "units").alias("avg_rating"),
            F.col("n_rating").alias("num_interactions"),
            F.coalesce("quantity", F.lit(0)).cast("long").alias("total_quantity"), F.col("last").alias("last_interaction"))
    return (txn.where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
               .groupBy("user_id", "product_id").agg(
        exact_mean("rating").alias("avg_rating"),
        F.count("rating").alias("num_interactions"),
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("long").alias("total_quantity"),
        F.max("timestamp").alias("last_interaction"),
    ))


def pair_click_agg(clicks: DataFrame) -> DataFrame:
    """Per (user, product) clickstream statistics with 0/1 flags."""
    return (clicks.where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
                  .groupBy("user_id", "product_id").agg(
        F.count("event_id").alias("view_count"),
        F.coalesce(exact_sum("page_duration_sec"), F.lit(0.0)).alias("total_view_duration"),
        _flag_any("event_type", "add_to_cart").alias("added_to_cart"),
        _flag_any("event_type", "wishlist_add").alias("added_to_wishlist"),
    ))


def brand_agg(items: DataFrame) -> DataFrame:
    """Total purchases per brand (null brand dropped, like a pandas group-by)."""
    return (items.where(F.col("brand").isNotNull()).groupBy("brand")
                 .agg(F.sum("total_purchases").cast("long").alias("brand_total_purchases")))


def global_agg(df: DataFrame, c: str) -> DataFrame:
    """Table-level statistics of one column."""
    return df.agg(F.count(c).alias("count"), F.min(c).alias("min"), F.max(c).alias("max"),
                  F.avg(c).alias("mean"), exact_median(df, c).alias("median"),
                  F.count_distinct(c).alias("nunique"))


def masked_global_mean(df: DataFrame, c: str) -> DataFrame:
    """Mean over cells > 0."""
    return df.where(F.col(c) > 0).agg(F.avg(c).alias("global_mean"))


# ---------------------------------------------------------------------------
# Feature jobs
# ---------------------------------------------------------------------------

def recency(df: DataFrame, c: str = "last_purchase", out: str = "days_since_last_purchase",
            as_of=DEFAULT_AS_OF) -> DataFrame:
    """whole days from the last purchase to ``as_of``."""
    return df.withColumn(out, whole_days_between(F.col(c), as_of_literal(as_of)))


def purchase_frequency(df: DataFrame) -> DataFrame:
    """transactions per 30-day month of tenure (tenure = whole days + 1)."""
    tenure = whole_days_between(F.col("first_purchase"), F.col("last_purchase")) + 1
    return df.withColumn("purchase_frequency",
                         F.try_divide(F.col("total_transactions").cast("double"),
                                      tenure.cast("double") / F.lit(float(S.FREQUENCY_DAYS))))


def engagement_score(df: DataFrame) -> DataFrame:
    """weighted sum of engagement counts."""
    w = S.ENGAGEMENT_WEIGHTS
    expr = sum((F.col(c) * F.lit(wt) for c, wt in w.items()), F.lit(0.0))
    return df.withColumn("engagement_score", expr)


def conversion_rate(df: DataFrame) -> DataFrame:
    """min(1, bought / max(1, viewed)); null when the user has no clicks."""
    viewed = F.col("unique_products_viewed")
    ratio = F.col("unique_products_bought").cast("double") / F.greatest(viewed, F.lit(1)).cast("double")
    return df.withColumn("conversion_rate",
                         F.when(viewed.isNull(), F.lit(None).cast("double"))
                          .otherwise(F.least(ratio, F.lit(1.0))))


def user_features(txn: DataFrame, clicks: DataFrame, users: DataFrame,
                  as_of=DEFAULT_AS_OF, sums: DataFrame | None = None) -> DataFrame:
    """one row per user with at least one purchase (25 columns)."""
    u = purchase_frequency(recency(user_txn_agg(txn, sums), as_of=as_of))
    c = engagement_score(user_click_agg(clicks))
    demo = users.select("user_id", "age", "gender_encoded", "location_encoded", "is_premium",
                        "age_normalized", "days_since_signup")
    out = u.join(c, "user_id", "left").join(demo, "user_id", "left")
    return conversion_rate(out).select(*S.USER_FEATURE_COLUMNS)


def purchase_popularity(df: DataFrame) -> DataFrame:
    """total_purchases / max(total_purchases) via a scalar subquery."""
    mx = df.select(F.max("total_purchases")).scalar()
    return df.withColumn("purchase_popularity",
                         F.try_divide(F.col("total_purchases").cast("double"), mx.cast("double")))


def view_to_purchase_ratio(df: DataFrame) -> DataFrame:
    """cart adds / max(1, events)."""
    return df.withColumn("view_to_purchase_ratio",
                         F.col("cart_add_count").cast("double")
                         / F.greatest(F.col("total_views"), F.lit(1)).cast("double"))


def brand_total_purchases(items: DataFrame) -> DataFrame:
    """Brand totals joined back.  The brand table is one row per brand;
    aggregating first (instead of a window over brand) keeps a dominant brand
    from landing in a single task."""
    return items.join(brand_agg(items), "brand", "left")


def item_features(txn: DataFrame, clicks: DataFrame, products: DataFrame,
                  external: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """one row per purchased product (26 columns)."""
    it = purchase_popularity(item_txn_agg(txn, sums))
    ic = view_to_purchase_ratio(item_click_agg(clicks))
    prod = products.select("product_id", "category", "price", "brand", "price_normalized",
                           "category_encoded", "num_reviews", "in_stock")
    ext = external.select("product_id", "sentiment_score", "popularity_score", "trending_rank",
                          "social_mentions")
    out = it.join(ic, "product_id", "left").join(prod, "product_id", "left").join(ext, "product_id", "left")
    return brand_total_purchases(out).select(*S.ITEM_FEATURE_COLUMNS)


def full_outer_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer join on (user_id, product_id), keys coalesced."""
    return a.join(b, ["user_id", "product_id"], "full")


def null_to_zero(df: DataFrame) -> DataFrame:
    """numeric nulls -> 0 (timestamps keep their nulls)."""
    return df.na.fill(0)


def interaction_score(df: DataFrame) -> DataFrame:
    """weighted sum over pair features."""
    w = S.INTERACTION_WEIGHTS
    expr = sum((F.col(c).cast("double") * F.lit(wt) for c, wt in w.items()), F.lit(0.0))
    return df.withColumn("interaction_score", expr)


def interaction_features(txn: DataFrame, clicks: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """purchase pairs ⟗ click pairs, zero-filled, scored (11 columns)."""
    out = null_to_zero(full_outer_pairs(pair_txn_agg(txn, sums), pair_click_agg(clicks)))
    return interaction_score(out).select(*S.INTERACTION_FEATURE_COLUMNS)


def dense_index(ids: DataFrame, c: str, out: str = "idx", partitions: int | None = None) -> DataFrame:
    """sorted distinct ids -> 0..n-1 without funnelling all ids into one task.

    Distinct ids are range partitioned and sorted, and written with each row's
    partition and local number; partition sizes are counted from the same
    files, so rows and offsets agree whatever the optimizer does with either
    branch.
    """
    d = ids.select(c).where(F.col(c).isNotNull()).distinct()
    d = (d.repartitionByRange(partitions, c) if partitions else d.repartitionByRange(c)).sortWithinPartitions(c)
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    d = materialised(d.withColumn("_pid", F.spark_partition_id()).withColumn("_local", local), "dense-index")
    # one row per partition, so the unpartitioned window is small
    sizes = (d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_off", F.coalesce(F.sum("_n").over(
                   Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    return (d.join(F.broadcast(sizes.select("_pid", "_off")), "_pid")
             .select(c, (F.col("_off") + F.col("_local")).cast("long").alias(out)))


def user_item_matrix(pairs: DataFrame, value: str = "avg_rating") -> DataFrame:
    """COO (row, col, value) with dense indices over the pair table."""
    ui = dense_index(pairs, "user_id", "row")
    ii = dense_index(pairs, "product_id", "col")
    return (pairs.select("user_id", "product_id", F.col(value).cast("double").alias("value"))
                 .join(ui, "user_id").join(ii, "product_id")
                 .select("row", "col", "user_id", "product_id", "value"))


def matrix_sparsity(pairs: DataFrame) -> DataFrame:
    """1 - stored cells / (users × items); zero-valued pairs are stored cells."""
    return pairs.agg(
        F.count(F.lit(1)).alias("nnz"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("product_id").alias("n_items"),
    ).withColumn("sparsity", F.lit(1.0) - F.col("nnz").cast("double")
                 / (F.col("n_users") * F.col("n_items")).cast("double"))


def transform_summary(user_f: DataFrame, item_f: DataFrame, pairs: DataFrame) -> DataFrame:
    """F16: row counts of the three feature tables, matrix shape and sparsity.
    The two other tables' counts are scalar subqueries on the one-row result."""
    return matrix_sparsity(pairs).select(
        user_f.select(F.count(F.lit(1))).scalar().alias("user_feature_rows"),
        item_f.select(F.count(F.lit(1))).scalar().alias("item_feature_rows"),
        F.col("nnz").alias("interaction_feature_rows"), "n_users", "n_items", "sparsity")


def build_features(clean: dict[str, DataFrame], as_of=DEFAULT_AS_OF) -> dict[str, DataFrame]:
    """The three feature tables; the purchases' figures per pair are written once for all."""
    txn, clicks = clean["transactions"], clean["clickstream"]
    sums = materialised(pair_sums(txn), "pair-sums")
    return {
        "user_features": user_features(txn, clicks, clean["users"], as_of, sums),
        "item_features": item_features(txn, clicks, clean["products"], clean["external_scores"], sums),
        "interaction_features": interaction_features(txn, clicks, sums),
    }
