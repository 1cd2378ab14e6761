"""Cleaning operators (C1–C18) and the four composed cleaners.

Global statistics (median, min, max) are attached with Spark scalar
subqueries (``DataFrame.scalar()``): computed once by a partial + final
aggregate and inlined, with no join and no driver round trip.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.exprs import (as_of_literal, clip as clip_expr, minmax_scale, parse_timestamp,
                               weekday_mon0, whole_days_between)
from ..sources.roles import DEFAULT_AS_OF
from ..sources.shared import materialised
from .quantiles import exact_median


def dedup_exact(df: DataFrame) -> DataFrame:
    """Full-row distinct (null equals null).  Hash aggregate with map-side
    combine, so a row repeated millions of times collapses before the shuffle."""
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key; among rows sharing a key keep the smallest by the
    remaining columns (ascending, nulls first) so the choice is deterministic.

    Written as ``min(struct(...))`` per key: a partial aggregate runs before the
    shuffle, so a hot key does not gather all its rows into one task.
    """
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    # a null key forms a group like any other, as one row is kept for it
    return (df.groupBy(key).agg(F.min(F.struct(*others)).alias("_r"))
              .select(*[F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns]))


def drop_null_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is null."""
    return df.na.drop(subset=cols)


def impute_median(df: DataFrame, c: str) -> DataFrame:
    """C4: fill nulls with the exact median of the non-null values."""
    med = exact_median(df, c)
    return df.withColumn(c, F.coalesce(F.col(c), med.cast(df.schema[c].dataType)))


def impute_constant(df: DataFrame, values: dict) -> DataFrame:
    """Constant fill."""
    return df.na.fill(values)


def clip(df: DataFrame, c: str, lo, hi) -> DataFrame:
    """Clamp to [lo, hi], null stays null."""
    return df.withColumn(c, clip_expr(c, lo, hi).cast(df.schema[c].dataType))


def parse_timestamp_coerce(df: DataFrame, c: str, fmt: str = S.TIMESTAMP_FORMAT) -> DataFrame:
    """Parse, unparseable -> null -> row dropped."""
    return df.withColumn(c, parse_timestamp(c, fmt)).where(F.col(c).isNotNull())


def date_parts(df: DataFrame, c: str = "timestamp", parts=("date", "hour", "day_of_week", "month")) -> DataFrame:
    """Date, hour, day_of_week (Mon = 0), month."""
    exprs = {"date": F.to_date(c), "hour": F.hour(c), "day_of_week": weekday_mon0(c),
             "month": F.month(c)}
    return df.select("*", *[exprs[p].alias(p) for p in parts])


def min_max_scale(df: DataFrame, c: str, out: str) -> DataFrame:
    """(x - min) / (max - min) over the whole table; constant column -> null."""
    stats = df.agg(F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias("s"))
    withs = df.withColumn("_mm", stats.select("s").scalar())
    return (withs.withColumn(out, minmax_scale(F.col(c).cast("double"), F.col("_mm.lo"), F.col("_mm.hi")))
                 .drop("_mm"))


def category_codes(df: DataFrame, c: str, out: str) -> DataFrame:
    """0-based code of each distinct value in lexical order; null -> -1.

    Codes come from the range-partitioned dense numbering of the distinct
    values (no single-task window, whatever the cardinality); the join back is
    left to the planner, which broadcasts the dictionary when its measured
    size is under the broadcast threshold and shuffles otherwise.
    """
    from .features import dense_index
    codes = dense_index(df.select(c), c, "_code").select(c, F.col("_code").cast("int").alias(out))
    return (df.join(codes, on=c, how="left")
              .withColumn(out, F.coalesce(F.col(out), F.lit(-1)).cast("int"))
              .select(*df.columns, out))


def map_encode(df: DataFrame, c: str, mapping: dict, out: str) -> DataFrame:
    """C11: dictionary lookup, unknown or null -> null."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(out, F.when(F.col(c).isNull(), F.lit(None))
                               .otherwise(F.try_element_at(m, F.col(c))).cast("int"))


def days_since(df: DataFrame, c: str, out: str, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Whole days from ``c`` to ``as_of``."""
    return df.withColumn(out, whole_days_between(F.col(c), as_of_literal(as_of)))


def project_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """C17: explicit projection."""
    return df.select(*cols)


def filter_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Boolean mask."""
    return df.where(cond)


# ---------------------------------------------------------------------------
# Composed cleaners
# ---------------------------------------------------------------------------

def clean_transactions(raw: DataFrame) -> DataFrame:
    """C1 -> C3 -> C4(rating) -> C5(quantity=1) -> C6(rating 1..5) -> C7 -> C8.
    The deduplicated rows are written once, their timestamps parsed; the median
    (of rows without a valid timestamp too) and the cleaning read them."""
    df = drop_null_keys(dedup_exact(raw), S.TXN_KEY_COLUMNS)
    df = materialised(df.withColumn("timestamp", parse_timestamp("timestamp", S.TIMESTAMP_FORMAT)), "transactions")
    df = impute_median(df, "rating")
    df = impute_constant(df, {"quantity": S.QUANTITY_FILL})
    df = clip(df, "rating", *S.RATING_CLIP)
    df = df.where(F.col("timestamp").isNotNull())
    return date_parts(df, "timestamp", ("date", "hour", "day_of_week", "month"))


def clean_clickstream(raw: DataFrame) -> DataFrame:
    """C14: C1 -> C7 -> C6(duration 0..1800) -> C8(date, hour).  The rows are
    written once, as several features read them."""
    df = materialised(parse_timestamp_coerce(dedup_exact(raw), "timestamp"), "clickstream")
    df = clip(df, "page_duration_sec", *S.DURATION_CLIP)
    return date_parts(df, "timestamp", ("date", "hour"))


def clean_products(raw: DataFrame) -> DataFrame:
    """C2(product_id) -> C4(avg_rating) -> C5(num_reviews=0) -> C9(price) -> C10(category)."""
    df = materialised(dedup_by_key(raw, "product_id"), "products")
    df = impute_median(df, "avg_rating")
    df = impute_constant(df, {"num_reviews": S.NUM_REVIEWS_FILL})
    df = min_max_scale(df, "price", "price_normalized")
    return category_codes(df, "category", "category_encoded")


def clean_users(raw: DataFrame, as_of=DEFAULT_AS_OF) -> DataFrame:
    """C2(user_id) -> C11(gender) -> C10(location) -> C9(age) -> C12(signup)."""
    df = dedup_by_key(raw, "user_id")
    df = map_encode(df, "gender", S.GENDER_CODES, "gender_encoded")
    df = category_codes(df, "location", "location_encoded")
    df = min_max_scale(df, "age", "age_normalized")
    return days_since(df, "signup_date", "days_since_signup", as_of)


def clean_external(raw: DataFrame) -> DataFrame:
    """External scores pass through unchanged."""
    return raw


def clean_all(sources: dict[str, DataFrame], as_of=DEFAULT_AS_OF) -> dict[str, DataFrame]:
    return {
        "transactions": clean_transactions(sources["transactions"]),
        "clickstream": clean_clickstream(sources["clickstream"]),
        "products": clean_products(sources["products"]),
        "users": clean_users(sources["users"], as_of),
        "external_scores": clean_external(sources["external_scores"]),
    }
