"""Table schemas and the fixed data-quality rule set.

The rule values below must equal the behaviour being rebuilt (required
columns, ranges, allowed values, score weights, encodings, report wording);
they are stated once here, as plain data, and read by every operator.
"""
from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (rule set, encodings, weights, report formats).
# ---------------------------------------------------------------------------
REQUIRED_COLUMNS = {
    "transactions": ["transaction_id", "user_id", "product_id", "quantity", "rating", "timestamp"],
    "products": ["product_id", "product_name", "category", "price", "brand"],
    "clickstream": ["event_id", "user_id", "product_id", "event_type", "timestamp"],
    "external_scores": ["product_id", "sentiment_score", "popularity_score"],
}

RANGES = {
    "transactions": {"rating": (1, 5), "quantity": (1, 100)},
    "products": {"price": (0.01, 100000), "avg_rating": (1, 5)},
    "external_scores": {"sentiment_score": (-1, 1), "popularity_score": (0, 100)},
}

ALLOWED_VALUES = {
    "clickstream": {
        "event_type": ["page_view", "product_view", "add_to_cart", "remove_from_cart",
                       "wishlist_add", "search", "purchase"],
        "device": ["mobile", "desktop", "tablet"],
    },
}

# First of these present in a table is its primary key for the PK-duplicate count.
PK_CANDIDATES = ["transaction_id", "event_id", "product_id"]

# Missing-value severity: pct (rounded to 2) below this is a warning, else critical.
MISSING_CRITICAL_PCT = 5
# Quality score: 100 - min(2*avg_missing_pct, 30) - min(dup_pct, 20)
#                    - sum_col min(violation_pct, 10) - 15*critical_issues, floor 0, round 1.
SCORE_MISSING_WEIGHT = 2
SCORE_MISSING_CAP = 30
SCORE_DUP_CAP = 20
SCORE_RANGE_CAP = 10
SCORE_CRITICAL_PENALTY = 15

# Wording of the schema issue.
ISSUE_SCHEMA = "Missing columns: {cols}"

# Gender encoding; unknown -> null.
GENDER_CODES = {"M": 0, "F": 1, "Other": 2}

# Cleaning constants.
TXN_KEY_COLUMNS = ["transaction_id", "user_id", "product_id"]
RATING_CLIP = (1, 5)
DURATION_CLIP = (0, 1800)
QUANTITY_FILL = 1
NUM_REVIEWS_FILL = 0
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Feature weights.
ENGAGEMENT_WEIGHTS = {"total_events": 0.3, "avg_page_duration": 0.3,
                      "cart_adds": 0.2, "unique_products_viewed": 0.2}
INTERACTION_WEIGHTS = {"avg_rating": 0.4, "num_interactions": 0.2, "view_count": 0.1,
                       "added_to_cart": 0.15, "added_to_wishlist": 0.15}
FREQUENCY_DAYS = 30

# Model parameters.
RANDOM_STATE = 42
TEST_SIZE = 0.2
TOP_K = 10
N_FACTORS = 50
EVAL_SAMPLE_USERS = 100

# Feature catalogue definitions: name, description, source, transformation, dtype, entity.
FEATURE_DEFINITIONS = [
    ("total_transactions", "Total number of purchases by user", "transactions", "count", "int", "user"),
    ("avg_rating_given", "Average rating given by user", "transactions", "mean(rating)", "float", "user"),
    ("unique_products_bought", "Number of unique products purchased", "transactions", "nunique(product_id)", "int", "user"),
    ("purchase_frequency", "Purchases per month", "transactions", "count/months", "float", "user"),
    ("engagement_score", "Composite engagement metric", "clickstream", "weighted_sum", "float", "user"),
    ("conversion_rate", "Purchase/view ratio", "transactions+clickstream", "ratio", "float", "user"),
    ("days_since_last_purchase", "Recency of last purchase", "transactions", "days_diff", "int", "user"),
    ("total_purchases", "Total purchases of product", "transactions", "count", "int", "item"),
    ("avg_rating_received", "Average rating received", "transactions", "mean(rating)", "float", "item"),
    ("purchase_popularity", "Normalized purchase count", "transactions", "normalize", "float", "item"),
    ("view_to_purchase_ratio", "Cart adds / views", "clickstream", "ratio", "float", "item"),
    ("sentiment_score", "External sentiment analysis score", "external_api", "api_fetch", "float", "item"),
    ("popularity_score", "External popularity metric", "external_api", "api_fetch", "float", "item"),
    ("price_normalized", "Min-max normalized price", "products", "min_max_scale", "float", "item"),
    ("avg_rating", "Average rating for user-item pair", "transactions", "mean", "float", "interaction"),
    ("num_interactions", "Number of interactions", "transactions", "count", "int", "interaction"),
    ("interaction_score", "Composite interaction metric", "multi-source", "weighted_sum", "float", "interaction"),
    ("view_count", "Number of views for user-item pair", "clickstream", "count", "int", "interaction"),
]

# ---------------------------------------------------------------------------
# Raw source schemas (role tables).
# ---------------------------------------------------------------------------
TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("payment_method", T.StringType()),
])

CLICKSTREAM = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("page_duration_sec", T.DoubleType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("brand", T.StringType()),
    T.StructField("avg_rating", T.DoubleType()),
    T.StructField("num_reviews", T.LongType()),
    T.StructField("in_stock", T.BooleanType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("age", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("is_premium", T.BooleanType()),
])

EXTERNAL_SCORES = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("popularity_score", T.DoubleType()),
    T.StructField("trending_rank", T.LongType()),
    T.StructField("social_mentions", T.LongType()),
    T.StructField("competitor_price_ratio", T.DoubleType()),
    T.StructField("fetch_timestamp", T.TimestampNTZType()),
])

SOURCE_SCHEMAS = {
    "transactions": TRANSACTIONS,
    "products": PRODUCTS,
    "clickstream": CLICKSTREAM,
    "external_scores": EXTERNAL_SCORES,
    "users": USERS,
}

# Order in which sources are validated / reported.
SOURCES = ["transactions", "products", "clickstream", "external_scores", "users"]

USER_FEATURE_COLUMNS = [
    "user_id", "total_transactions", "total_quantity", "avg_rating_given", "std_rating_given",
    "unique_products_bought", "avg_quantity_per_txn", "first_purchase", "last_purchase",
    "days_since_last_purchase", "purchase_frequency", "total_events", "total_sessions",
    "avg_page_duration", "unique_products_viewed", "cart_adds", "searches", "engagement_score",
    "age", "gender_encoded", "location_encoded", "is_premium", "age_normalized",
    "days_since_signup", "conversion_rate",
]
ITEM_FEATURE_COLUMNS = [
    "product_id", "total_purchases", "unique_buyers", "avg_rating_received", "std_rating_received",
    "total_quantity_sold", "avg_quantity_per_purchase", "purchase_popularity", "total_views",
    "unique_viewers", "avg_view_duration", "cart_add_count", "wishlist_count",
    "view_to_purchase_ratio", "category", "price", "brand", "price_normalized",
    "category_encoded", "num_reviews", "in_stock", "sentiment_score", "popularity_score",
    "trending_rank", "social_mentions", "brand_total_purchases",
]
INTERACTION_FEATURE_COLUMNS = [
    "user_id", "product_id", "avg_rating", "num_interactions", "total_quantity",
    "last_interaction", "view_count", "total_view_duration", "added_to_cart",
    "added_to_wishlist", "interaction_score",
]


def numeric_columns(schema: T.StructType) -> list[str]:
    """Numeric, non-boolean columns in schema order."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]


# Column types of the feature tables; columns not named are whole numbers.
_INTS = {"gender_encoded", "location_encoded", "category_encoded", "added_to_cart", "added_to_wishlist"}
_DOUBLES = {"avg_rating_given", "std_rating_given", "avg_quantity_per_txn", "purchase_frequency", "avg_page_duration",
            "engagement_score", "age_normalized", "conversion_rate", "avg_rating_received", "std_rating_received",
            "avg_quantity_per_purchase", "purchase_popularity", "avg_view_duration", "view_to_purchase_ratio", "price",
            "price_normalized", "sentiment_score", "popularity_score", "avg_rating", "total_view_duration",
            "interaction_score"}
_TIMES, _BOOLS, _TEXTS = {"first_purchase", "last_purchase", "last_interaction"}, {"is_premium", "in_stock"}, {"category", "brand"}


def _feature_type(c: str) -> T.DataType:
    for names, kind in ((_INTS, T.IntegerType()), (_DOUBLES, T.DoubleType()), (_TIMES, T.TimestampNTZType()),
                        (_BOOLS, T.BooleanType()), (_TEXTS, T.StringType())):
        if c in names:
            return kind
    return T.LongType()


FEATURE_SCHEMAS = {name: T.StructType([T.StructField(c, _feature_type(c)) for c in cols])
                   for name, cols in (("user_features", USER_FEATURE_COLUMNS), ("item_features", ITEM_FEATURE_COLUMNS),
                                      ("interaction_features", INTERACTION_FEATURE_COLUMNS))}
