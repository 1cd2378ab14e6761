"""Registry of runnable queries (one per operator ID of the inventory) and
their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)``, reads the whole driver tables through
the role builders and returns a lazy DataFrame.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import cleaning as C
from ..operators import features as FE
from . import oracle as O
from ..sources.shared import materialised
from .context import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return fn
    return deco


def _all(table: str) -> str:
    return f"SELECT * FROM {table}"


# ---------------------------------------------------------------------------
# Sources (S9 role tables)
# ---------------------------------------------------------------------------
for _name in S.SOURCES:
    def _mk(n):
        return lambda spark, d: Tables(spark, d).raw[n]
    register(f"s9_source_{_name}", O.sql(_all(_name), _name))(_mk(_name))


# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------
@register("c1_dedup_exact", O.sql("SELECT DISTINCT * FROM transactions", "transactions"))
def _c1(spark, d):
    return C.dedup_exact(Tables(spark, d).raw["transactions"])


_TXN_OTHERS = [f.name for f in S.TRANSACTIONS.fields if f.name != "transaction_id"]


@register("c2_dedup_by_key", O.sql(O._first_per_key("transactions", "transaction_id", _TXN_OTHERS),
                                   "transactions"))
def _c2(spark, d):
    return C.dedup_by_key(Tables(spark, d).raw["transactions"], "transaction_id")


@register("c3_drop_null_keys", O.sql(_all("_t_keys"), "_t_keys"))
def _c3(spark, d):
    return C.drop_null_keys(C.dedup_exact(Tables(spark, d).raw["transactions"]), S.TXN_KEY_COLUMNS)


@register("c4_impute_median", O.sql(
    "SELECT * REPLACE (COALESCE(rating, (SELECT median(rating) FROM _t_keys)) AS rating) FROM _t_keys", "_t_keys"))
def _c4(spark, d):
    df = C.drop_null_keys(C.dedup_exact(Tables(spark, d).raw["transactions"]), S.TXN_KEY_COLUMNS)
    return C.impute_median(df, "rating")


@register("c5_impute_constant", O.sql(
    "SELECT * REPLACE (COALESCE(quantity, 1) AS quantity) FROM transactions", "transactions"))
def _c5(spark, d):
    return C.impute_constant(Tables(spark, d).raw["transactions"], {"quantity": S.QUANTITY_FILL})


@register("c6_clip", O.sql(
    f"SELECT * REPLACE ({O._clip('page_duration_sec', 0.0, 1800.0)} AS page_duration_sec) FROM clickstream",
    "clickstream"))
def _c6(spark, d):
    return C.clip(Tables(spark, d).raw["clickstream"], "page_duration_sec", *S.DURATION_CLIP)


@register("c7_parse_timestamp_coerce", O.sql(
    f"SELECT * FROM (SELECT * REPLACE (try_strptime(timestamp, {O.TS_FMT}) AS timestamp) FROM clickstream)"
    " WHERE timestamp IS NOT NULL", "clickstream"))
def _c7(spark, d):
    return C.parse_timestamp_coerce(Tables(spark, d).raw["clickstream"], "timestamp")


@register("c8_date_parts", O.sql(
    "SELECT transaction_id, user_id, product_id, date, hour, day_of_week, month FROM transactions_clean",
    "transactions_clean"))
def _c8(spark, d):
    return Tables(spark, d).transactions.select(
        "transaction_id", "user_id", "product_id", "date", "hour", "day_of_week", "month")


@register("c9_min_max_scale", O.sql("SELECT product_id, price, price_normalized FROM products_clean",
                                    "products_clean"))
def _c9(spark, d):
    return C.min_max_scale(C.dedup_by_key(Tables(spark, d).raw["products"], "product_id"), "price", "price_normalized").select(
        "product_id", "price", "price_normalized")


@register("c10_category_codes", O.sql("SELECT user_id, location, location_encoded FROM users_clean",
                                      "users_clean"))
def _c10(spark, d):
    return C.category_codes(C.dedup_by_key(Tables(spark, d).raw["users"], "user_id"), "location", "location_encoded").select(
        "user_id", "location", "location_encoded")


@register("c11_map_encode", O.sql("SELECT user_id, gender, gender_encoded FROM users_clean", "users_clean"))
def _c11(spark, d):
    return C.map_encode(C.dedup_by_key(Tables(spark, d).raw["users"], "user_id"), "gender", S.GENDER_CODES, "gender_encoded").select(
        "user_id", "gender", "gender_encoded")


@register("c12_days_since", O.sql("SELECT user_id, signup_date, days_since_signup FROM users_clean",
                                  "users_clean"))
def _c12(spark, d):
    t = Tables(spark, d)
    return C.days_since(C.dedup_by_key(t.raw["users"], "user_id"), "signup_date", "days_since_signup", t.as_of).select(
        "user_id", "signup_date", "days_since_signup")


@register("c13_clean_transactions", O.sql(_all("transactions_clean"), "transactions_clean"))
def _c13(spark, d):
    return Tables(spark, d).transactions


@register("c14_clean_clickstream", O.sql(_all("clickstream_clean"), "clickstream_clean"))
def _c14(spark, d):
    return Tables(spark, d).clickstream


@register("c15_clean_products", O.sql(_all("products_clean"), "products_clean"))
def _c15(spark, d):
    return Tables(spark, d).products


@register("c16_clean_users", O.sql(_all("users_clean"), "users_clean"))
def _c16(spark, d):
    return Tables(spark, d).users


@register("c17_project_columns", O.sql("SELECT user_id, product_id, rating FROM transactions_clean",
                                       "transactions_clean"))
def _c17(spark, d):
    return C.project_columns(Tables(spark, d).transactions, ["user_id", "product_id", "rating"])


@register("c18_filter_rows", O.sql(
    "SELECT * FROM clickstream_clean WHERE event_type IN ('add_to_cart', 'wishlist_add') AND product_id IS NOT NULL",
    "clickstream_clean"))
def _c18(spark, d):
    c = Tables(spark, d).clickstream
    return C.filter_rows(c, F.col("event_type").isin("add_to_cart", "wishlist_add") & F.col("product_id").isNotNull())


# ---------------------------------------------------------------------------
# Aggregations / joins / features
# ---------------------------------------------------------------------------
@register("a1_user_txn_agg", O.sql(
    "SELECT * EXCLUDE (days_since_last_purchase, purchase_frequency) FROM user_txn", "user_txn"))
def _a1(spark, d):
    return FE.user_txn_agg(Tables(spark, d).transactions)


@register("a2_user_click_agg", O.sql("SELECT * EXCLUDE (engagement_score) FROM user_clicks", "user_clicks"))
def _a2(spark, d):
    return FE.user_click_agg(Tables(spark, d).clickstream)


@register("a3_item_txn_agg", O.sql("SELECT * EXCLUDE (purchase_popularity) FROM item_txn", "item_txn"))
def _a3(spark, d):
    return FE.item_txn_agg(Tables(spark, d).transactions)


@register("a4_item_click_agg", O.sql("SELECT * EXCLUDE (view_to_purchase_ratio) FROM item_clicks", "item_clicks"))
def _a4(spark, d):
    return FE.item_click_agg(Tables(spark, d).clickstream)


@register("a5_pair_txn_agg", O.sql(_all("pair_txn"), "pair_txn"))
def _a5(spark, d):
    return FE.pair_txn_agg(Tables(spark, d).transactions)


@register("a6_pair_click_agg", O.sql(_all("pair_clicks"), "pair_clicks"))
def _a6(spark, d):
    return FE.pair_click_agg(Tables(spark, d).clickstream)


@register("a7_brand_agg", O.sql(
    "SELECT brand, CAST(sum(total_purchases) AS BIGINT) AS brand_total_purchases FROM _item_joined"
    " WHERE brand IS NOT NULL GROUP BY brand", "_item_joined"))
def _a7(spark, d):
    t = Tables(spark, d)
    it = FE.item_txn_agg(t.transactions).join(t.products.select("product_id", "brand"), "product_id", "left")
    return FE.brand_agg(it)


@register("a8_global_agg", O.sql(
    "SELECT count(price) AS count, min(price) AS min, max(price) AS max, avg(price) AS mean,"
    " median(price) AS median, count(DISTINCT price) AS nunique FROM products_clean", "products_clean"))
def _a8(spark, d):
    return FE.global_agg(Tables(spark, d).products, "price")


@register("a9_masked_global_mean", O.sql(
    "SELECT avg(avg_rating) AS global_mean FROM interaction_features WHERE avg_rating > 0", "interaction_features"))
def _a9(spark, d):
    return FE.masked_global_mean(Tables(spark, d).interactions, "avg_rating")


@register("j1_left_join_features", O.sql(
    "SELECT t.user_id, t.total_transactions, c.total_events, u.location_encoded FROM user_txn t"
    " LEFT JOIN user_clicks c ON t.user_id = c.user_id LEFT JOIN users_clean u ON t.user_id = u.user_id",
    "user_txn", "user_clicks", "users_clean"))
def _j1(spark, d):
    t = Tables(spark, d)
    return (FE.user_txn_agg(t.transactions).select("user_id", "total_transactions")
            .join(FE.user_click_agg(t.clickstream).select("user_id", "total_events"), "user_id", "left")
            .join(t.users.select("user_id", "location_encoded"), "user_id", "left"))


@register("j2_full_outer_pairs", O.sql(
    "SELECT COALESCE(t.user_id, c.user_id) AS user_id, COALESCE(t.product_id, c.product_id) AS product_id,"
    " t.num_interactions, c.view_count FROM pair_txn t FULL OUTER JOIN pair_clicks c"
    " ON t.user_id = c.user_id AND t.product_id = c.product_id", "pair_txn", "pair_clicks"))
def _j2(spark, d):
    t = Tables(spark, d)
    return FE.full_outer_pairs(FE.pair_txn_agg(t.transactions).select("user_id", "product_id", "num_interactions"),
                               FE.pair_click_agg(t.clickstream).select("user_id", "product_id", "view_count"))


@register("j3_agg_join_back", O.sql(
    "SELECT product_id, brand, brand_total_purchases FROM item_features", "item_features"))
def _j3(spark, d):
    return Tables(spark, d).item_features.select("product_id", "brand", "brand_total_purchases")


@register("f1_recency", O.sql("SELECT user_id, last_purchase, days_since_last_purchase FROM user_txn", "user_txn"))
def _f1(spark, d):
    t = Tables(spark, d)
    return FE.recency(FE.user_txn_agg(t.transactions), as_of=t.as_of).select(
        "user_id", "last_purchase", "days_since_last_purchase")


@register("f2_purchase_frequency", O.sql("SELECT user_id, purchase_frequency FROM user_txn", "user_txn"))
def _f2(spark, d):
    return FE.purchase_frequency(FE.user_txn_agg(Tables(spark, d).transactions)).select(
        "user_id", "purchase_frequency")


@register("f3_engagement_score", O.sql("SELECT user_id, engagement_score FROM user_clicks", "user_clicks"))
def _f3(spark, d):
    return FE.engagement_score(FE.user_click_agg(Tables(spark, d).clickstream)).select("user_id", "engagement_score")


@register("f4_conversion_rate", O.sql("SELECT user_id, conversion_rate FROM user_features", "user_features"))
def _f4(spark, d):
    return Tables(spark, d).user_features.select("user_id", "conversion_rate")


@register("f5_user_features", O.sql(_all("user_features"), "user_features"))
def _f5(spark, d):
    return Tables(spark, d).user_features


@register("f6_purchase_popularity", O.sql("SELECT product_id, purchase_popularity FROM item_txn", "item_txn"))
def _f6(spark, d):
    return FE.purchase_popularity(FE.item_txn_agg(Tables(spark, d).transactions)).select(
        "product_id", "purchase_popularity")


@register("f7_view_to_purchase_ratio", O.sql("SELECT product_id, view_to_purchase_ratio FROM item_clicks",
                                             "item_clicks"))
def _f7(spark, d):
    return FE.view_to_purchase_ratio(FE.item_click_agg(Tables(spark, d).clickstream)).select(
        "product_id", "view_to_purchase_ratio")


@register("f8_brand_total_purchases", O.sql(
    "SELECT product_id, brand_total_purchases FROM item_features", "item_features"))
def _f8(spark, d):
    return Tables(spark, d).item_features.select("product_id", "brand_total_purchases")


@register("f9_item_features", O.sql(_all("item_features"), "item_features"))
def _f9(spark, d):
    return Tables(spark, d).item_features


@register("f10_null_to_zero", O.sql(
    "SELECT user_id, product_id, avg_rating, num_interactions, view_count, last_interaction"
    " FROM interaction_features", "interaction_features"))
def _f10(spark, d):
    return Tables(spark, d).interactions.select(
        "user_id", "product_id", "avg_rating", "num_interactions", "view_count", "last_interaction")


@register("f11_interaction_score", O.sql(
    "SELECT user_id, product_id, interaction_score FROM interaction_features", "interaction_features"))
def _f11(spark, d):
    return Tables(spark, d).interactions.select("user_id", "product_id", "interaction_score")


@register("f12_interaction_features", O.sql(_all("interaction_features"), "interaction_features"))
def _f12(spark, d):
    return Tables(spark, d).interactions


O.cte("user_index", "SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS row"
      " FROM (SELECT DISTINCT user_id FROM interaction_features)", "interaction_features")
O.cte("item_index", "SELECT product_id, CAST(row_number() OVER (ORDER BY product_id) - 1 AS BIGINT) AS col"
      " FROM (SELECT DISTINCT product_id FROM interaction_features)", "interaction_features")


@register("f13_dense_index", O.sql(_all("user_index"), "user_index"))
def _f13(spark, d):
    return FE.dense_index(Tables(spark, d).interactions, "user_id", "row")


@register("f14_user_item_matrix", O.sql(
    "SELECT u.row, i.col, p.user_id, p.product_id, CAST(p.avg_rating AS DOUBLE) AS value"
    " FROM interaction_features p JOIN user_index u ON p.user_id = u.user_id"
    " JOIN item_index i ON p.product_id = i.product_id", "user_index", "item_index"))
def _f14(spark, d):
    return FE.user_item_matrix(Tables(spark, d).interactions)


_SPARSITY = ("SELECT count(*) AS nnz, count(DISTINCT user_id) AS n_users, count(DISTINCT product_id) AS n_items,"
             " 1.0 - CAST(count(*) AS DOUBLE) / CAST(count(DISTINCT user_id) * count(DISTINCT product_id) AS DOUBLE)"
             " AS sparsity FROM interaction_features")


@register("f15_matrix_sparsity", O.sql(_SPARSITY, "interaction_features"))
def _f15(spark, d):
    return FE.matrix_sparsity(Tables(spark, d).interactions)


@register("f16_transform_summary", O.sql(
    "SELECT (SELECT count(*) FROM user_features) AS user_feature_rows,"
    " (SELECT count(*) FROM item_features) AS item_feature_rows,"
    " nnz AS interaction_feature_rows, n_users, n_items, sparsity FROM (" + _SPARSITY + ")",
    "interaction_features", "user_features", "item_features"))
def _f16(spark, d):
    t = Tables(spark, d)
    return FE.transform_summary(t.user_features, t.item_features, t.interactions)


# ---------------------------------------------------------------------------
# Data quality (V1–V12) over all five raw sources
# ---------------------------------------------------------------------------
from ..operators import quality as Q  # noqa: E402
from . import oracle_quality as OQ  # noqa: E402


def _sub(sql_text: str, cols: str) -> str:
    return f"SELECT {cols} FROM ({sql_text})"


@register("v1_dq_required_columns", OQ.v1())
def _v1(spark, d):
    return Q.for_all(Q.required_columns, Tables(spark, d).raw)


@register("v2_dq_missing_values", OQ.v2())
def _v2(spark, d):
    return Q.for_all(Q.missing_values, Tables(spark, d).raw)


@register("v3_dq_duplicate_rows", _sub(OQ.v3v4(), "source, total_rows, total_duplicates"))
def _v3(spark, d):
    return Q.for_all(Q.duplicates, Tables(spark, d).raw).select("source", "total_rows", "total_duplicates")


@register("v4_dq_pk_duplicates", _sub(OQ.v3v4(), "source, pk_column, primary_key_duplicates"))
def _v4(spark, d):
    return Q.for_all(Q.duplicates, Tables(spark, d).raw).select("source", "pk_column", "primary_key_duplicates")


@register("v5_dq_ranges", OQ.v5())
def _v5(spark, d):
    return Q.for_all(Q.ranges, Tables(spark, d).raw)


@register("v6_dq_allowed_values", OQ.v6())
def _v6(spark, d):
    return Q.for_all(Q.allowed_values, Tables(spark, d).raw)


@register("v7_dq_shape_and_types", OQ.v7())
def _v7(spark, d):
    return Q.for_all(Q.shape_and_types, Tables(spark, d).raw)


@register("v8_dq_numeric_summary", OQ.v8())
def _v8(spark, d):
    return Q.for_all(Q.numeric_summary, Tables(spark, d).raw)


@register("v9_dq_issues", OQ.v9())
def _v9(spark, d):
    return Q.issues_all(Tables(spark, d).raw)


@register("v10_dq_issue_counts", OQ.v10())
def _v10(spark, d):
    return Q.for_all(Q.issue_counts, Tables(spark, d).raw)


@register("v11_dq_quality_score", OQ.v11())
def _v11(spark, d):
    return Q.for_all(Q.quality_score, Tables(spark, d).raw)


@register("v12_dq_report_all", OQ.v12())
def _v12(spark, d):
    return Q.report_all(Tables(spark, d).raw)


# ---------------------------------------------------------------------------
# Profiling
# ---------------------------------------------------------------------------
from ..operators import profile as P  # noqa: E402


def _hist_sql(table: str, c: str, bins: int) -> str:
    x = f"CAST({c} AS DOUBLE)"
    st = (f"SELECT CASE WHEN min({x}) = max({x}) THEN min({x}) - 0.5 ELSE min({x}) END AS lo,"
          f" CASE WHEN min({x}) = max({x}) THEN max({x}) + 0.5 ELSE max({x}) END AS hi,"
          f" min({x}) AS mn FROM {table}")
    b = (f"CAST(least(floor(({x} - st.lo) * (CAST({bins} AS DOUBLE) / (st.hi - st.lo))) + 1, {bins}) AS INTEGER)")
    counts = f"SELECT {b} AS bin, count(*) AS cnt FROM {table}, st WHERE {x} IS NOT NULL GROUP BY 1"
    w = f"((st.hi - st.lo) / CAST({bins} AS DOUBLE))"
    return (f"SELECT g.bin, st.lo + CAST(g.bin - 1 AS DOUBLE) * {w} AS bin_lo,"
            f" st.lo + CAST(g.bin AS DOUBLE) * {w} AS bin_hi, CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count"
            f" FROM st CROSS JOIN (SELECT CAST(generate_series AS INTEGER) AS bin FROM generate_series(1, {bins})) g"
            f" LEFT JOIN ({counts}) c ON g.bin = c.bin WHERE st.mn IS NOT NULL").replace(
        "FROM st CROSS", "FROM (" + st + ") st CROSS").replace(
        f"FROM {table}, st WHERE", f"FROM {table}, ({st}) st WHERE")


@register("e1_rating_histogram", O.sql(_hist_sql("transactions_clean", "rating", 5), "transactions_clean"))
def _e1(spark, d):
    return P.rating_histogram(Tables(spark, d).transactions)


O.cte("_txn_per_user", "SELECT user_id, count(*) AS txn_count FROM transactions_clean WHERE user_id IS NOT NULL"
      " GROUP BY user_id", "transactions_clean")


@register("e2_txn_per_user_histogram", O.sql(_hist_sql("_txn_per_user", "txn_count", 30), "_txn_per_user"))
def _e2(spark, d):
    return P.txn_per_user_histogram(Tables(spark, d).transactions)


def _topk_sql(key: str, k: int, name: str = "count") -> str:
    return (f"SELECT {key}, count(*) AS {name} FROM transactions_clean WHERE {key} IS NOT NULL GROUP BY {key}"
            f" ORDER BY {name} DESC, {key} ASC LIMIT {k}")


@register("e3_top_products", O.sql(_topk_sql("product_id", 20, "txn_count"), "transactions_clean"))
def _e3(spark, d):
    return P.top_products(Tables(spark, d).transactions)


@register("e4_category_share", O.sql(
    "SELECT category, count(*) AS count, CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM products_clean)"
    " AS DOUBLE) * CAST(100.0 AS DOUBLE) AS pct FROM products_clean WHERE category IS NOT NULL GROUP BY category",
    "products_clean"))
def _e4(spark, d):
    return P.category_share(Tables(spark, d).products)


@register("e5_interaction_pivot", O.sql(
    "SELECT user_id, product_id, avg(rating) AS avg_rating FROM transactions_clean"
    f" WHERE user_id IN (SELECT user_id FROM ({_topk_sql('user_id', 50)}))"
    f" AND product_id IN (SELECT product_id FROM ({_topk_sql('product_id', 50)}))"
    " GROUP BY user_id, product_id", "transactions_clean"))
def _e5(spark, d):
    return P.interaction_pivot_long(Tables(spark, d).transactions)


@register("e6_txn_by_hour", O.sql("SELECT hour, count(*) AS count FROM transactions_clean GROUP BY hour ORDER BY hour",
                                  "transactions_clean"))
def _e6(spark, d):
    return P.txn_by_hour(Tables(spark, d).transactions)


@register("e7_txn_by_weekday", O.sql(
    "SELECT day_of_week, count(*) AS count FROM transactions_clean GROUP BY day_of_week ORDER BY day_of_week",
    "transactions_clean"))
def _e7(spark, d):
    return P.txn_by_weekday(Tables(spark, d).transactions)


@register("e8_interaction_sparsity", O.sql(
    "SELECT count(*) AS n_interactions, count(DISTINCT user_id) AS n_users, count(DISTINCT product_id) AS n_items,"
    " 1.0 - CAST(count(*) AS DOUBLE) / CAST(count(DISTINCT user_id) * count(DISTINCT product_id) AS DOUBLE)"
    " AS sparsity FROM transactions_clean", "transactions_clean"))
def _e8(spark, d):
    return P.interaction_sparsity(Tables(spark, d).transactions)


_NL, _ND, _NT = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS TIMESTAMP)"


@register("e9_data_summary", O.sql(
    "SELECT 'transactions' AS \"table\", count(*) AS records, count(DISTINCT user_id) AS unique_users,"
    " count(DISTINCT product_id) AS unique_products, round_even(avg(rating), 2) AS avg_rating,"
    f" {_NL} AS categories, {_ND} AS avg_price, {_ND} AS avg_age, {_NL} AS event_types,"
    " min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp FROM transactions_clean"
    f" UNION ALL SELECT 'products', count(*), {_NL}, {_NL}, {_ND}, count(DISTINCT category),"
    f" round_even(avg(price), 2), {_ND}, {_NL}, {_NT}, {_NT} FROM products_clean"
    f" UNION ALL SELECT 'users', count(*), {_NL}, {_NL}, {_ND}, {_NL}, {_ND}, round_even(avg(age), 1), {_NL},"
    f" {_NT}, {_NT} FROM users_clean"
    f" UNION ALL SELECT 'clickstream', count(*), {_NL}, {_NL}, {_ND}, {_NL}, {_ND}, {_ND},"
    f" count(DISTINCT event_type), {_NT}, {_NT} FROM clickstream_clean",
    "transactions_clean", "products_clean", "users_clean", "clickstream_clean"))
def _e9(spark, d):
    t = Tables(spark, d)
    return P.data_summary(t.transactions, t.products, t.users, t.clickstream)


# ---------------------------------------------------------------------------
# Joins J4–J6
# ---------------------------------------------------------------------------
from ..operators import metrics as M  # noqa: E402
from ..operators import recommend as R  # noqa: E402


@register("j4_semi_join_topk", O.sql(
    "SELECT * FROM transactions_clean WHERE user_id IN (SELECT user_id FROM ("
    + _topk_sql("user_id", 50) + "))", "transactions_clean"))
def _j4(spark, d):
    t = Tables(spark, d).transactions
    return t.join(F.broadcast(P.top_k(t, "user_id", 50).select("user_id")), "user_id", "left_semi")


@register("j5_anti_join_holdout", O.sql(_all("train_pairs").replace("*", "user_id, product_id"), "train_pairs"))
def _j5(spark, d):
    pairs = Tables(spark, d).interactions
    _, test = R.split_train_test(pairs)
    return R.holdout_history(pairs, test)


@register("j6_dictionary_join", O.sql(
    "SELECT p.user_id, u.row AS user_idx, p.product_id FROM interaction_features p JOIN user_index u"
    " ON p.user_id = u.user_id", "user_index"))
def _j6(spark, d):
    pairs = Tables(spark, d).interactions
    return (pairs.select("user_id", "product_id")
                 .join(FE.dense_index(pairs, "user_id", "user_idx"), "user_id"))


# ---------------------------------------------------------------------------
# Recommenders M1–M22
# ---------------------------------------------------------------------------
def _split(spark, d):
    return R.split_train_test(Tables(spark, d).interactions)


def _unit(spark, d):
    return R.unit_vectors(R.cb_vectorise(Tables(spark, d).item_features))


def _pairs_and_unit(spark, d, columns: tuple[str, ...] = ("*",)):
    """(interactions, written with ``columns``; unit vectors of the items) from one set of cleaned tables."""
    t = Tables(spark, d)
    sums = materialised(FE.pair_sums(t.transactions), "pair-sums")
    pairs = materialised(FE.interaction_features(t.transactions, t.clickstream, sums).select(*columns), "pairs")
    items = FE.item_features(t.transactions, t.clickstream, t.products, t.external, sums)
    return pairs, R.unit_vectors(R.cb_vectorise(items))


def _long(vecs: DataFrame, names: list[str]) -> DataFrame:
    names_arr = F.array(*[F.lit(n) for n in names])
    return (vecs.select("product_id", F.posexplode("vec").alias("pos", "value"))
                .select("product_id", F.element_at(names_arr, F.col("pos") + 1).alias("feature"), "value"))


@register("m1_split_train_test", O.sql("SELECT user_id, product_id, is_test FROM _split", "_split"))
def _m1(spark, d):
    return R.split_flag(Tables(spark, d).interactions).select("user_id", "product_id", "is_test")


@register("m2_rating_matrix", O.sql(
    "SELECT user_id, product_id, CAST(avg_rating AS DOUBLE) AS value FROM train_pairs WHERE avg_rating > 0",
    "train_pairs"))
def _m2(spark, d):
    return R.rating_matrix(_split(spark, d)[0])


O.cte("_cells_once", "SELECT * FROM _cells", "_cells", materialized=True)
O.cte("_cells_mean", f"SELECT {O.exact_mean('value')} AS m FROM _cells_once", "_cells_once", materialized=True)


@register("m3_mean_center", O.sql(
    "SELECT user_id, product_id, value - m AS value FROM _cells_once CROSS JOIN _cells_mean", "_cells_once", "_cells_mean"))
def _m3(spark, d):
    return R.mean_center(R.rating_matrix(_split(spark, d)[0]))


@register("m4_svd_fit", "SELECT CAST(i AS INTEGER) AS factor, CAST(1.0 AS DOUBLE) AS norm, TRUE AS within_tolerance,"
          " TRUE AS in_order FROM range(1, 51) t(i)")
def _m4(spark, d):
    """What makes the pairs a truncated SVD: unit vectors v with |AᵀA v − σ² v|
    ≤ tolerance·σ², recomputed from the ratings, and falling σ."""
    from ..operators import linalg
    train, _ = _split(spark, d)
    train = materialised(train, "m4-train")
    model = R.svd_fit(train)
    cells = R.mean_center(R.rating_matrix(train)).where("value <> 0")
    back = linalg.sum_vectors(cells.join(model.user_factors, "user_id").select(
        "product_id", F.transform("vec", lambda x: x * F.col("value")).alias("vec")), "product_id")  # Aᵀ(A v)
    both = model.item_factors.join(back.withColumnRenamed("vec", "back"), "product_id", "left")
    sigma = F.array(*[F.lit(x) for x in model.sigma])
    v = (both.select(F.posexplode(F.arrays_zip("vec", F.coalesce("back", F.transform("vec", lambda x: x * 0.0)).alias("back"),
                                               sigma.alias("sigma"))))
             .select((F.col("pos") + 1).alias("factor"), "col.vec", "col.back", "col.sigma"))
    off = F.col("back") - F.col("sigma") * F.col("sigma") * F.col("vec")
    per = v.groupBy("factor", "sigma").agg(F.round(F.sqrt(F.sum(F.col("vec") * F.col("vec"))), 6).alias("norm"),
                                           F.sqrt(F.sum(off * off)).alias("off"))
    falling = all(a >= b for a, b in zip(model.sigma, model.sigma[1:]))
    # twice the tolerance leaves room for the rounding of the fit's own estimate
    return per.select("factor", "norm", (F.col("off") <= 2 * linalg.TOLERANCE * F.col("sigma") * F.col("sigma"))
                      .alias("within_tolerance"), F.lit(falling).alias("in_order"))


def _deviation_model(spark, d):
    """(model, train, test): predictions and rankings take any factor tables;
    the registered queries check them on factors that SQL can compute.  All pairs
    are written once, with the columns read here and their side of the split."""
    pairs = Tables(spark, d).interactions.select("user_id", "product_id", "avg_rating")
    flagged = materialised(R.split_flag(pairs), "pairs")
    train, test = (flagged.where(side).drop("is_test") for side in ("NOT is_test", "is_test"))
    return R.mean_deviation_model(train), train, test


@register("m5_predict_pairs", O.sql(O.dev_predictions("test_pairs"), *O.DEV_CTES))
def _m5(spark, d):
    model, _, test = _deviation_model(spark, d)
    return R.predict_pairs(model, test)


@register("m6_recommend_cf", O.sql(O.dev_recs(), *O.DEV_CTES))
def _m6(spark, d):
    model, _, _ = _deviation_model(spark, d)
    return R.recommend_cf(model, model.user_factors)


@register("m7_cb_feature_select", O.sql(
    " UNION ALL ".join(f"SELECT '{c}' AS feature, min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max"
                       f" FROM item_features" for c in O.CB_FEATURES), "item_features"))
def _m7(spark, d):
    items = Tables(spark, d).item_features
    cols = R.cb_feature_select(items)
    recs = [F.struct(F.lit(c).alias("feature"), F.min(F.col(c).cast("double")).alias("min"),
                     F.max(F.col(c).cast("double")).alias("max")) for c in cols]
    return items.agg(F.array(*recs).alias("a")).select(F.inline("a"))


@register("m8_cb_vectorise", O.sql(O.long_vectors("cb_vectors"), "cb_vectors"))
def _m8(spark, d):
    items = Tables(spark, d).item_features
    return _long(R.cb_vectorise(items), R.cb_feature_select(items))


SIMILAR = 0.98


@register("m9_cosine_similarity", O.sql(
    "SELECT a.product_id, b.product_id AS other_id, least(list_dot_product(a.vec, b.vec), 1.0) AS similarity"
    " FROM cb_unit a JOIN cb_unit b ON a.product_id < b.product_id"
    f" WHERE list_dot_product(a.vec, b.vec) >= {SIMILAR}", "cb_unit"))
def _m9(spark, d):
    """All pairs of items with a cosine of at least SIMILAR."""
    from ..operators import similarity
    return similarity.similar_pairs(R.cb_vectorise(Tables(spark, d).item_features), SIMILAR)


@register("m9_unit_vectors", O.sql(O.long_vectors("cb_unit"), "cb_unit"))
def _m9_unit(spark, d):
    items = Tables(spark, d).item_features
    return _long(R.unit_vectors(R.cb_vectorise(items)), R.cb_feature_select(items))


@register("m10_similar_items", O.sql(
    "SELECT product_id, CAST(rank AS INTEGER) AS rank, similar_product_id, similarity FROM ("
    "SELECT a.product_id, b.product_id AS similar_product_id, list_dot_product(a.vec, b.vec) AS similarity,"
    " row_number() OVER (PARTITION BY a.product_id ORDER BY list_dot_product(a.vec, b.vec) DESC, b.product_id ASC)"
    " AS rank FROM cb_unit a JOIN cb_unit b ON a.product_id <> b.product_id) WHERE rank <= 10", "cb_unit"))
def _m10(spark, d):
    return R.similar_items(_unit(spark, d))


@register("m11_recommend_cb", O.sql(O.cb_recs("interaction_features"), "interaction_features", "cb_unit"))
def _m11(spark, d):
    pairs, unit = _pairs_and_unit(spark, d, ("user_id", "product_id"))
    return R.recommend_cb(pairs, unit, dim=len(O.CB_FEATURES))


def _cb_eval_recs(spark, d, users: DataFrame | None = None):
    pairs, unit = _pairs_and_unit(spark, d, ("user_id", "product_id"))
    _, test = R.split_train_test(pairs)
    users = users if users is not None else test.select("user_id").distinct()
    hist = R.holdout_history(pairs, test, users)
    recs = R.recommend_cb(hist, unit, dim=len(O.CB_FEATURES))
    return recs, test, users


_TEST_USERS = "SELECT DISTINCT user_id FROM test_pairs"
_CB_PER_USER = O.sql(O.per_user_metrics(O.cb_recs("train_pairs", _TEST_USERS), _TEST_USERS),
                     "train_pairs", "test_pairs", "cb_unit")


@register("m12_precision_at_k", _sub(_CB_PER_USER, "user_id, precision_at_k"))
def _m12(spark, d):
    recs, test, users = _cb_eval_recs(spark, d)
    return M.precision_at_k(recs, test, users)


@register("m13_recall_at_k", _sub(_CB_PER_USER, "user_id, recall_at_k"))
def _m13(spark, d):
    recs, test, users = _cb_eval_recs(spark, d)
    return M.recall_at_k(recs, test, users)


@register("m14_ndcg_at_k", _sub(_CB_PER_USER, "user_id, ndcg_at_k"))
def _m14(spark, d):
    recs, test, users = _cb_eval_recs(spark, d)
    return M.ndcg_at_k(recs, test, users)


_DEV_RMSE = ("SELECT COALESCE(sqrt(avg(pow(t.avg_rating - p.prediction, 2))), 0.0) AS {name} FROM ("
             + O.dev_predictions("test_pairs") + ") p JOIN test_pairs t ON p.user_id = t.user_id"
             " AND p.product_id = t.product_id{where}")


def _cf_test_predictions(spark, d):
    model, _, test = _deviation_model(spark, d)
    tp = test.select("user_id", "product_id", "avg_rating")
    return R.predict_pairs(model, tp).join(tp, ["user_id", "product_id"])


@register("m15_rmse_masked", O.sql(_DEV_RMSE.format(name="rmse_masked", where=" WHERE t.avg_rating > 0"), *O.DEV_CTES))
def _m15(spark, d):
    return M.rmse(_cf_test_predictions(spark, d), masked=True)


@register("m16_rmse_all", O.sql(_DEV_RMSE.format(name="rmse", where=""), *O.DEV_CTES))
def _m16(spark, d):
    return M.rmse(_cf_test_predictions(spark, d))


@register("m17_sample_users", O.sql(O.SAMPLE_USERS, "test_pairs"))
def _m17(spark, d):
    return M.sample_users(_split(spark, d)[1])


_CF_SAMPLE = O.per_user_metrics(O.dev_recs(O.SAMPLE_USERS), O.SAMPLE_USERS)
_CF_SAMPLE_PAIRS = f"(SELECT * FROM test_pairs WHERE user_id IN ({O.SAMPLE_USERS}))"
_CF_RMSE = ("(SELECT round_even(COALESCE(sqrt(avg(pow(t.avg_rating - p.prediction, 2))), 0.0), 4) FROM ("
            + O.dev_predictions(_CF_SAMPLE_PAIRS) + ") p JOIN test_pairs t ON p.user_id = t.user_id"
            " AND p.product_id = t.product_id{where})")
_MEANS = ("COALESCE(round_even(avg(precision_at_k), 4), 0.0) AS precision_at_k,"
          " COALESCE(round_even(avg(recall_at_k), 4), 0.0) AS recall_at_k,"
          " COALESCE(round_even(avg(ndcg_at_k), 4), 0.0) AS ndcg_at_k,")
_CF_EVAL = (f"SELECT 'collaborative_filtering' AS model, {_MEANS} {_CF_RMSE.format(where='')} AS rmse,"
            f" {_CF_RMSE.format(where=' WHERE t.avg_rating > 0')} AS rmse_masked, 10 AS k,"
            f" (SELECT count(*) FROM ({O.SAMPLE_USERS})) AS num_test_users FROM ({_CF_SAMPLE})")


@register("m18_evaluate_cf", O.sql(_CF_EVAL, *O.DEV_CTES))
def _m18(spark, d):
    model, _, test = _deviation_model(spark, d)
    return M.evaluate_cf(model, test)


_CB_SAMPLE = O.per_user_metrics(O.cb_recs("train_pairs", O.SAMPLE_USERS), O.SAMPLE_USERS)


_CB_EVAL = (f"SELECT 'content_based' AS model, {_MEANS} CAST(NULL AS DOUBLE) AS rmse,"
            " CAST(NULL AS DOUBLE) AS rmse_masked, 10 AS k, (SELECT count(*) FROM (" + O.SAMPLE_USERS + "))"
            " AS num_test_users FROM (" + _CB_SAMPLE + ")")
_CB_EVAL_CTES = ("train_pairs", "test_pairs", "cb_unit")


@register("m19_evaluate_cb", O.sql(_CB_EVAL, *_CB_EVAL_CTES))
def _m19(spark, d):
    pairs, unit = _pairs_and_unit(spark, d)
    _, test = R.split_train_test(pairs)
    return M.evaluate_cb(unit, pairs, test, dim=len(O.CB_FEATURES))


@register("m20_evaluate_models", O.sql(_CF_EVAL + " UNION ALL " + _CB_EVAL, *O.DEV_CTES, "cb_unit"))
def _m20(spark, d):
    pairs, unit = _pairs_and_unit(spark, d)
    train, test = R.split_train_test(pairs)
    return M.evaluate_models(R.mean_deviation_model(train), unit, pairs, test, dim=len(O.CB_FEATURES))


# ---------------------------------------------------------------------------
# Feature snapshots K1–K6 (written under the session's checkpoint folder)
# ---------------------------------------------------------------------------
from ..operators import snapshots as K  # noqa: E402
from ..sources import files as SF  # noqa: E402

_FEATURE_TABLES = ("user_features", "item_features", "interaction_features")


def _feature_tables(spark, d) -> dict[str, DataFrame]:
    return Tables(spark, d).all_features


def _written_snapshot(spark, d):
    base = SF.scratch_dir(spark, "snapshots")
    m = K.snapshot_write(_feature_tables(spark, d), base, "v1", created_at=Tables(spark, d).as_of)
    return base, m


@register("k1_snapshot_write", O.sql(
    "SELECT 'v1' AS version_id, 'interaction_features,item_features,user_features' AS features,"
    f" 'Feature snapshot' AS description, 32 AS hash_length, {O.AS_OF} AS created_at,"
    + ", ".join(f" (SELECT count(*) FROM {t}) AS {t}_rows" for t in _FEATURE_TABLES), *_FEATURE_TABLES))
def _k1(spark, d):
    m = _written_snapshot(spark, d)[1]
    return m.select("version_id", F.array_join("features", ",").alias("features"), "description",
                    F.length("data_hash").alias("hash_length"), "created_at",
                    *[F.col("row_counts")[t].alias(f"{t}_rows") for t in _FEATURE_TABLES])


@register("k2_snapshot_read", O.sql(_all("user_features"), "user_features"))
def _k2(spark, d):
    base, _ = _written_snapshot(spark, d)
    return K.snapshot_read(spark, base)["user_features"]


def _double_text(c: str) -> str:
    places, x = "CAST(4503599627370496.0 AS DOUBLE)", f"abs({c})"
    first = f"(({x} - floor({x})) * {places})"
    second = f"(({first} - floor({first})) * {places})"
    digits = " || ':' || ".join(f"CAST(CAST(floor({p}) AS BIGINT) AS VARCHAR)" for p in (x, first, second))
    return f"CASE WHEN {c} < 0 THEN '-' ELSE '' END || {digits}"


def _fingerprint_sql(table: str, schema) -> str:
    parts = []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        x = {"double": _double_text(f.name), "boolean": f"CAST({f.name} AS INTEGER)",
             "timestamp_ntz": f"strftime({f.name}, {O.TS_FMT})"}.get(kind, f.name)
        parts.append(f"COALESCE('=' || {x if kind == 'double' else f'CAST({x} AS VARCHAR)'}, '-')")
    text = f"concat_ws(chr(31), {', '.join(parts)})"
    return (f"SELECT '{table}' AS \"table\", count(*) AS rows,"
            f" CAST(sum(CAST(('0x' || substr(md5({text}), 1, 15))::BIGINT AS HUGEINT)) AS VARCHAR) AS hash_sum FROM {table}")


@register("k3_snapshot_fingerprint", O.sql(" UNION ALL ".join(
    _fingerprint_sql(t, S.FEATURE_SCHEMAS[t]) for t in _FEATURE_TABLES), *_FEATURE_TABLES))
def _k3(spark, d):
    ft = _feature_tables(spark, d)
    return reduce(DataFrame.unionByName,
                  [K.fingerprint(df).select(F.lit(n).alias("table"), "rows", F.col("hash_sum").cast("string").alias("hash_sum"))
                   for n, df in ft.items()])


@register("k4_entity_lookup", O.sql(
    "SELECT * FROM user_features WHERE user_id IN (SELECT user_id FROM clickstream_clean)",
    "user_features", "clickstream_clean"))
def _k4(spark, d):
    """Features of every user in the clickstream, looked up in a snapshot."""
    base, _ = _written_snapshot(spark, d)
    return K.snapshot_lookup(spark, base, "user_features", Tables(spark, d).clickstream.select("user_id"))


def _catalogue_sql() -> str:
    table_of = {"user": "user_features", "item": "item_features", "interaction": "interaction_features"}
    parts = []
    for name, desc, src, tr, dtype, ent in S.FEATURE_DEFINITIONS:
        tb = table_of[ent]
        x = f"CAST({name} AS DOUBLE)"
        parts.append(f"SELECT '{name}' AS name, '{desc}' AS description, '{src}' AS source,"
                     f" '{tr}' AS transformation, '{dtype}' AS dtype, '{ent}' AS entity, '{tb}' AS \"table\","
                     f" count({name}) AS n, CAST(count_if({name} IS NULL) AS BIGINT) AS nulls, min({x}) AS min,"
                     f" max({x}) AS max, avg({x}) AS mean FROM {tb}")
    return O.sql(" UNION ALL ".join(parts), *_FEATURE_TABLES)


@register("k5_feature_catalogue", _catalogue_sql())
def _k5(spark, d):
    return K.feature_catalogue(_feature_tables(spark, d))


@register("k6_store_summary", O.sql(
    f"SELECT {len(S.FEATURE_DEFINITIONS)} AS registered_features, 1 AS versions, 'v1' AS latest_version,"
    " (SELECT count(*) FROM interaction_features) AS interaction_features_count,"
    " (SELECT count(*) FROM item_features) AS item_features_count,"
    " (SELECT count(*) FROM user_features) AS user_features_count", *_FEATURE_TABLES))
def _k6(spark, d):
    base, _ = _written_snapshot(spark, d)
    return K.store_summary(spark, base, K.snapshot_read(spark, base))


# ---------------------------------------------------------------------------
# File sources and sinks S1–S8 (round trips through the checkpoint folder)
# ---------------------------------------------------------------------------
_AS_OF_STR = "'2002-01-01 00:00:00'"


@register("s1_scan_csv", O.sql(_all("transactions"), "transactions"))
def _s1(spark, d):
    path = SF.scratch_dir(spark, "csv")
    Tables(spark, d).raw["transactions"].write.option("header", True).csv(path)
    return SF.scan_csv(spark, path, S.TRANSACTIONS)


@register("s2_ingest_with_lineage", O.sql(
    f"SELECT *, {_AS_OF_STR} AS _ingestion_timestamp, TRUE AS from_written_file FROM clickstream", "clickstream"))
def _s2(spark, d):
    path = SF.scratch_dir(spark, "csv")
    Tables(spark, d).raw["clickstream"].write.option("header", True).csv(path)
    df = SF.ingest_with_lineage(SF.scan_csv(spark, path, S.CLICKSTREAM), Tables(spark, d).as_of)
    # part-file names differ from run to run: only their form can be compared
    return df.withColumn("from_written_file", F.col("_source_file").rlike(r"^part-[0-9]+-.*\.csv$")).drop("_source_file")


@register("s3_scan_json_payload", O.sql(
    f"SELECT *, {_AS_OF_STR} AS _ingestion_timestamp, 'external_api' AS _source_api FROM external_scores",
    "external_scores"))
def _s3(spark, d):
    """Payload files of both shapes: a single object, and arrays of objects."""
    path = SF.scratch_dir(spark, "json")
    rows = Tables(spark, d).raw["external_scores"]
    whole = F.struct(*rows.columns)
    how = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    alone = F.col("product_id") % 500 == 0
    single = rows.where(alone).select(F.to_json(whole, how).alias("value"))
    lists = (rows.where(~alone).groupBy((F.col("product_id") / 200).cast("long").alias("part"))
                 .agg(F.collect_list(whole).alias("x")).select(F.to_json("x", how).alias("value")))
    single.union(lists).write.option("maxRecordsPerFile", 1).text(path)
    return SF.scan_json_payload(spark, path, S.EXTERNAL_SCORES, "external_api", Tables(spark, d).as_of)


@register("s4_land_timestamped", O.sql(
    "SELECT *, '20020101_000000' AS load_ts FROM products", "products"))
def _s4(spark, d):
    base = SF.scratch_dir(spark, "landing")
    for _ in range(2):  # the second is a repetition of the first and changes nothing
        SF.land_timestamped(Tables(spark, d).raw["products"], base, "products", Tables(spark, d).as_of)
    return SF.read_landed(spark, base, "products")


@register("s5_sink_json", O.sql(_all("clickstream"), "clickstream"))
def _s5(spark, d):
    path = SF.scratch_dir(spark, "json")
    SF.sink_json(Tables(spark, d).raw["clickstream"], path)
    return spark.read.schema(S.CLICKSTREAM).json(path)


@register("s6_ingestion_report", O.sql(" UNION ALL ".join(
    f"SELECT '{s}' AS source, count(*) AS records, 'success' AS status, 'parquet' AS source_type,"
    f" CAST(NULL AS VARCHAR) AS error, TRUE AS timed FROM {s}" for s in S.SOURCES), *S.SOURCES))
def _s6(spark, d):
    t = Tables(spark, d)
    report = SF.ingestion_report(spark, {s: (lambda s=s: t.raw[s]) for s in S.SOURCES}, SF.scratch_dir(spark, "ingest"))
    return report.withColumn("timed", F.col("ended_at") >= F.col("started_at")).drop("started_at", "ended_at")


@register("s7_sink_table", O.sql(_all("transactions_clean"), "transactions_clean"))
def _s7(spark, d):
    path = SF.scratch_dir(spark, "parquet")
    SF.sink_table(Tables(spark, d).transactions, path)
    return spark.read.parquet(path)


@register("s8_table_metadata", O.sql(" UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS record_count, {len(cols)} AS n_columns, '{','.join(cols)}' AS columns"
    f" FROM {n}" for n, cols in (("user_features", S.USER_FEATURE_COLUMNS), ("item_features", S.ITEM_FEATURE_COLUMNS),
                                 ("interaction_features", S.INTERACTION_FEATURE_COLUMNS))), *_FEATURE_TABLES))
def _s8(spark, d):
    return SF.sink_tables(_feature_tables(spark, d), SF.scratch_dir(spark, "tables"))


_CF_SIZES = ("SELECT 'collaborative_filtering' AS model, 'SVD (Truncated)' AS algorithm, 1 AS n_factors,"
             " (SELECT count(*) FROM _dev_user) AS n_users, (SELECT count(*) FROM _dev_item) AS n_items,"
             " (SELECT m FROM _dev_mean) AS global_mean,")
_CB_SIZES = ("SELECT 'content_based' AS model, 'Cosine Similarity' AS algorithm, CAST(NULL AS INTEGER) AS n_factors,"
             " CAST(NULL AS BIGINT) AS n_users, (SELECT count(*) FROM item_features) AS n_items,"
             " CAST(NULL AS DOUBLE) AS global_mean,")
_RUN = f" CAST(0.2 AS DOUBLE) AS test_size, 42 AS random_state, 10 AS top_k, 'run_1' AS run_id, {O.AS_OF} AS trained_at,"
_FIGURES = " precision_at_k, recall_at_k, ndcg_at_k, rmse FROM ({evaluation})"


@register("m21_model_tables", O.sql(
    _CF_SIZES + _RUN + _FIGURES.format(evaluation=_CF_EVAL) + " UNION ALL " + _CB_SIZES + _RUN
    + _FIGURES.format(evaluation=_CB_EVAL), *O.DEV_CTES, "cb_unit", "item_features"))
def _m21(spark, d):
    """All model tables written, and the metadata read back."""
    pairs, unit = _pairs_and_unit(spark, d)
    train, test = R.split_train_test(pairs)
    model, unit = R.mean_deviation_model(train), materialised(unit, "unit")
    metrics = M.evaluate_models(model, unit, pairs, test, dim=len(O.CB_FEATURES))
    out = SF.scratch_dir(spark, "model")
    for name, df in R.model_tables(model, unit, metrics, "run_1", Tables(spark, d).as_of).items():
        SF.sink_table(df, f"{out}/{name}")
    return spark.read.parquet(f"{out}/model_metadata")


@register("m22_train_job", O.sql(
    "SELECT model, precision_at_k, recall_at_k, ndcg_at_k, k, num_test_users,"
    " (SELECT count(DISTINCT user_id) FROM train_pairs) AS user_vectors,"
    " (SELECT count(DISTINCT product_id) FROM train_pairs) AS item_vectors,"
    " (SELECT count(*) FROM item_features) AS content_vectors, 50 AS singular_values FROM (" + _CB_EVAL + ")",
    *_CB_EVAL_CTES, "item_features"))
def _m22(spark, d):
    """The whole training job; its content-model metrics and the rows it wrote."""
    from . import jobs
    out = SF.scratch_dir(spark, "train-job")
    t = Tables(spark, d)
    for name, df in _feature_tables(spark, d).items():
        SF.sink_table(df, f"{out}/features/{name}")
    jobs.feature_store(spark, out, "v1", created_at=t.as_of)
    metrics = jobs.train(spark, out, "v1").where("model = 'content_based'")
    rows = lambda name: spark.read.parquet(f"{out}/model/{name}").select(F.count(F.lit(1))).scalar()
    return metrics.select("model", "precision_at_k", "recall_at_k", "ndcg_at_k", "k", "num_test_users",
                          rows("cf_user_factors").alias("user_vectors"), rows("cf_item_factors").alias("item_vectors"),
                          rows("cb_item_vectors").alias("content_vectors"), rows("cf_sigma").cast("int").alias("singular_values"))


# ---------------------------------------------------------------------------
# Sort / top-k idioms (T1–T3); T4–T9 are exercised by C2, F6/F8, M10/M11, M12, J5
# ---------------------------------------------------------------------------
@register("t1_sort", O.sql("SELECT user_id, product_id, last_interaction FROM interaction_features"
                           " ORDER BY last_interaction NULLS FIRST, user_id, product_id", "interaction_features"))
def _t1(spark, d):
    return (Tables(spark, d).interactions.select("user_id", "product_id", "last_interaction")
            .orderBy(F.col("last_interaction").asc_nulls_first(), "user_id", "product_id"))


@register("t2_top_k_global", O.sql(_topk_sql("user_id", 50, "txn_count"), "transactions_clean"))
def _t2(spark, d):
    return P.top_k(Tables(spark, d).transactions, "user_id", 50, "txn_count")


@register("t3_top_k_per_key", O.sql(
    "SELECT user_id, product_id, interaction_score, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER"
    " (PARTITION BY user_id ORDER BY interaction_score DESC, product_id ASC) AS rn FROM interaction_features)"
    " WHERE rn <= 3", "interaction_features"))
def _t3(spark, d):
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy(F.col("interaction_score").desc(), F.col("product_id").asc())
    return (Tables(spark, d).interactions.select("user_id", "product_id", "interaction_score")
            .withColumn("rn", F.row_number().over(w).cast("int")).where(F.col("rn") <= 3))


@register("j7_cross_join_score", O.sql(O.dev_recs(n=5, drop_seen=True), *O.DEV_CTES))
def _j7(spark, d):
    """Every known user scored against every known item, without the user's own."""
    model, train, _ = _deviation_model(spark, d)
    return R.recommend_cf(model, model.user_factors, n=5, exclude_known=True, train=train)


@register("t9_list_slice", O.sql(
    "SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rank) AS top FROM ("
    + O.dev_recs() + ") WHERE rank <= 3 GROUP BY user_id", *O.DEV_CTES))
def _t9(spark, d):
    """The first three entries of each user's ranked list."""
    model, _, _ = _deviation_model(spark, d)
    ranked = R.recommend_cf(model, model.user_factors).groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "product_id"))).alias("r"))  # ten entries per user
    return ranked.select("user_id", F.array_join(F.transform(F.slice("r", 1, 3), lambda x: x["product_id"].cast("string")),
                                                 ",").alias("top"))


@register("e5_interaction_pivot_wide", O.sql(
    "SELECT user_id, " + ", ".join(f"max(CASE WHEN place = {i} THEN avg_rating END) AS p{i}" for i in range(1, 51))
    + " FROM (SELECT t.user_id, p.place, avg(t.rating) AS avg_rating FROM transactions_clean t JOIN ("
    + _topk_sql("user_id", 50) + ") u ON t.user_id = u.user_id JOIN (SELECT product_id, row_number() OVER"
    " (ORDER BY count DESC, product_id ASC) AS place FROM (" + _topk_sql("product_id", 50) + ")) p"
    " ON t.product_id = p.product_id GROUP BY t.user_id, p.place) GROUP BY user_id", "transactions_clean"))
def _e5_wide(spark, d):
    """E5 as a matrix: columns p1..p50 are the most purchased products in order."""
    return P.interaction_pivot(Tables(spark, d).transactions)


@register("k5_feature_by_name", O.sql(
    "SELECT 'user' AS entity, 'total_transactions' AS name, count(total_transactions) AS n,"
    " max(CAST(total_transactions AS DOUBLE)) AS max FROM user_features", "user_features"))
def _k5_name(spark, d):
    return K.feature_catalogue(_feature_tables(spark, d), name="total_transactions").select("entity", "name", "n", "max")


@register("t4_keep_first_per_key", O.sql(_all("_u_dedup"), "_u_dedup"))
def _t4(spark, d):
    return C.dedup_by_key(Tables(spark, d).raw["users"], "user_id")


@register("t5_partition_aggregate_broadcast_back", O.sql(
    "SELECT product_id, purchase_popularity, brand_total_purchases FROM item_features", "item_features"))
def _t5(spark, d):
    return Tables(spark, d).item_features.select("product_id", "purchase_popularity", "brand_total_purchases")


@register("t6_rank_position", O.sql(
    "SELECT product_id, txn_count, CAST(row_number() OVER (ORDER BY txn_count DESC, product_id ASC) AS INTEGER)"
    " AS position FROM (" + _topk_sql("product_id", 20, "txn_count") + ")", "transactions_clean"))
def _t6(spark, d):
    top = P.top_products(Tables(spark, d).transactions)
    # top is at most 20 rows: numbering it in one window is bounded
    from pyspark.sql import Window
    return top.withColumn("position", F.row_number().over(
        Window.orderBy(F.col("txn_count").desc(), F.col("product_id").asc())).cast("int"))


@register("t7_set_intersection", O.sql(
    "SELECT user_id FROM transactions_clean INTERSECT SELECT user_id FROM clickstream_clean",
    "transactions_clean", "clickstream_clean"))
def _t7(spark, d):
    t = Tables(spark, d)
    return t.transactions.select("user_id").intersect(t.clickstream.select("user_id"))


@register("t8_set_difference", O.sql(
    "SELECT user_id FROM transactions_clean EXCEPT SELECT user_id FROM clickstream_clean",
    "transactions_clean", "clickstream_clean"))
def _t8(spark, d):
    t = Tables(spark, d)
    return t.transactions.select("user_id").subtract(t.clickstream.select("user_id"))
