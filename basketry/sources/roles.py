"""Role builders: the five raw retail sources derived from the driver tables.

transactions  <- lineitem ⋈ orders      (planted duplicates, nulls and bad values)
products      <- part
users         <- customer ⋈ nation ⟕ first order date per customer
clickstream   <- events
external      <- part

Every builder is a lazy projection/join over the parquet scans, so column
pruning and filters reach the scan.  The exact same derivations are written
in SQL in ``basketry.plans.oracle`` for the DuckDB cross-check.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.exprs import as_of_literal

# Fixed 'now' for the driver tables (orders end in 2001).
DEFAULT_AS_OF = _dt.datetime(2002, 1, 1)

# Fixed values of the role mapping.
EVENT_TYPE_MAP = {"view": "product_view", "click": "add_to_cart", "signup": "wishlist_add",
                  "purchase": "purchase", "error": "search"}
DEVICES = ["mobile", "desktop", "tablet", "kiosk"]          # 'kiosk' is not an allowed value
SEGMENT_GENDER = {"AUTOMOBILE": "M", "BUILDING": "F", "FURNITURE": "Other", "HOUSEHOLD": "M"}
# Planted defects: rows whose part key is a multiple of DUP_MOD appear twice;
# user / product / quantity are nulled on order keys that are multiples of these.
DUP_MOD, NULL_USER_MOD, NULL_PRODUCT_MOD, NULL_QTY_MOD = 97, 101, 103, 107
# Order keys (transactions) or event ids (clickstream) that are multiples of these
# have an unparseable timestamp, a rating or quantity over its range, a duration over its clip.
BAD_TIME_MOD, HIGH_RATING_MOD, HIGH_QTY_MOD, BAD_CLICK_TIME_MOD, LONG_VIEW_MOD = 109, 113, 127, 131, 137
BAD_TIME, HIGH_RATING, HIGH_QTY, LONG_VIEW_SEC = "unknown", 9.0, 500, 3000.0
# Product and customer keys that are multiples of these come twice with other values
# (price or age one higher); product keys that are multiples of the last have a negative price.
DUP_PRODUCT_MOD, DUP_USER_MOD, NEGATIVE_PRICE_MOD = 89, 83, 149


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _copies(twice):
    """``_copy`` 0, and a second row with 1 where ``twice`` holds."""
    return F.explode(F.sequence(F.lit(0), F.when(twice, 1).otherwise(0))).alias("_copy")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = l.join(o, l.l_orderkey == o.o_orderkey, "inner")
    d = F.round(F.col("l_discount") * 100).cast("int")
    k = F.col("l_orderkey")
    out = j.select(
        F.concat_ws("-", k.cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.when(k % NULL_USER_MOD == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("user_id"),
        F.when(k % NULL_PRODUCT_MOD == 0, F.lit(None)).otherwise(F.col("l_partkey")).alias("product_id"),
        F.when(k % NULL_QTY_MOD == 0, F.lit(None)).when(k % HIGH_QTY_MOD == 0, F.lit(HIGH_QTY))
         .otherwise(F.col("l_quantity").cast("long")).alias("quantity"),
        F.when(d == 10, F.lit(None)).when(k % HIGH_RATING_MOD == 0, F.lit(HIGH_RATING))
         .otherwise((F.lit(1) + d % 5).cast("double")).alias("rating"),
        # order dates have no time of day: the order key gives the hour
        F.when(k % BAD_TIME_MOD == 0, F.lit(BAD_TIME)).otherwise(F.date_format(
            F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (k % 24).cast("int")), S.TIMESTAMP_FORMAT)).alias("timestamp"),
        F.col("l_returnflag").alias("payment_method"),
        # one extra copy of the planted-duplicate rows, generated in the same pass
        F.explode(F.sequence(F.lit(1), F.when(F.col("l_partkey") % DUP_MOD == 0, 2).otherwise(1))).alias("_copy"),
    )
    return _conform(out, S.TRANSACTIONS)


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    etype = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in EVENT_TYPE_MAP.items() for x in kv]),
                                        F.col("event_type")), F.col("event_type"))
    out = e.select(
        F.col("event_id"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        etype.alias("event_type"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.when(F.col("event_id") % BAD_CLICK_TIME_MOD == 0, F.lit(BAD_TIME))
         .otherwise(F.date_format("ts", S.TIMESTAMP_FORMAT)).alias("timestamp"),
        F.element_at(F.array(*[F.lit(x) for x in DEVICES]),
                     (F.col("event_id") % len(DEVICES) + 1).cast("int")).alias("device"),
        (F.col("value") + F.when(F.col("event_id") % LONG_VIEW_MOD == 0, F.lit(LONG_VIEW_SEC)).otherwise(F.lit(0.0)))
        .alias("page_duration_sec"),
    )
    return _conform(out, S.CLICKSTREAM)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    out = p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_partkey") % NEGATIVE_PRICE_MOD == 0, -F.col("p_retailprice"))
         .otherwise(F.col("p_retailprice")).alias("price"),
        F.col("p_brand").alias("brand"),
        (F.lit(1) + F.col("p_size") % 5).cast("double").alias("avg_rating"),
        F.col("p_size").cast("long").alias("num_reviews"),
        (F.col("p_size") % 7 != 0).alias("in_stock"),
        _copies(F.col("p_partkey") % DUP_PRODUCT_MOD == 0),
    )
    return _conform(out.withColumn("price", F.col("price") + F.col("_copy")), S.PRODUCTS)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    first_order = (read_table(spark, sf_dir, "orders")
                   .groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order")))
    gender = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in SEGMENT_GENDER.items() for x in kv]),
                         F.col("c_mktsegment")),
        F.col("c_mktsegment"))
    j = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
          .join(first_order, c.c_custkey == first_order.o_custkey, "left"))
    out = j.select(
        F.col("c_custkey").alias("user_id"),
        (F.lit(18) + F.col("c_custkey") % 47).cast("long").alias("age"),
        gender.alias("gender"),
        F.col("n_name").alias("location"),
        F.to_date("first_order").alias("signup_date"),
        (F.col("c_acctbal") > 5000).alias("is_premium"),
        _copies(F.col("c_custkey") % DUP_USER_MOD == 0),
    )
    return _conform(out.withColumn("age", F.col("age") + F.col("_copy")), S.USERS)


def external_scores(spark: SparkSession, sf_dir: str, as_of=DEFAULT_AS_OF) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    out = p.select(
        F.col("p_partkey").alias("product_id"),
        ((F.col("p_size") - 25).cast("double") / F.lit(25.0)).alias("sentiment_score"),
        (F.col("p_size").cast("double") * F.lit(2.0)).alias("popularity_score"),
        (F.col("p_partkey") % 499 + 1).alias("trending_rank"),
        (F.col("p_partkey") % 5000).alias("social_mentions"),
        (F.lit(0.8) + (F.col("p_partkey") % 41).cast("double") / F.lit(100.0)).alias("competitor_price_ratio"),
        as_of_literal(as_of).alias("fetch_timestamp"),
    )
    return _conform(out, S.EXTERNAL_SCORES)


BUILDERS = {
    "transactions": transactions,
    "products": products,
    "clickstream": clickstream,
    "external_scores": external_scores,
    "users": users,
}


def load_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw source bundle (lazy; nothing is read until an action)."""
    return {name: fn(spark, sf_dir) for name, fn in BUILDERS.items()}
