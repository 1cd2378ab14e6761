"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Named CTEs declare their dependencies; ``sql(body, *ctes)`` emits the
transitive closure in dependency order followed by the final SELECT.  The
driver tables (lineitem, orders, ...) are views in the DuckDB session.
"""
from __future__ import annotations

from .. import schemas as S

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"
TS_FMT = "'%Y-%m-%d %H:%M:%S'"

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}
_ONCE: set[str] = set()


def cte(name: str, body: str, *deps: str, materialized: bool = False) -> None:
    _CTES[name] = (body, deps)
    if materialized:
        _ONCE.add(name)


def sql(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = [f"{n} AS {'MATERIALIZED ' if n in _ONCE else ''}(\n{_CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _days_between(start: str, end: str) -> str:
    return (f"CAST(floor((epoch_us(CAST({end} AS TIMESTAMP)) - epoch_us(CAST({start} AS TIMESTAMP)))"
            f" / 86400000000.0) AS BIGINT)")


def _units(c: str) -> str:
    return f"CAST(round({c} * CAST(1000000.0 AS DOUBLE)) AS HUGEINT)"


def exact_sum(c: str) -> str:
    return f"CAST(sum({_units(c)}) AS DOUBLE) / CAST(1000000.0 AS DOUBLE)"


def exact_mean(c: str) -> str:
    return f"CAST(sum({_units(c)}) AS DOUBLE) / (CAST(count({c}) AS DOUBLE) * CAST(1000000.0 AS DOUBLE))"


def exact_std(c: str) -> str:
    u = _units(c)
    spread = f"(CAST(count({c}) AS HUGEINT) * CAST(sum({u} * {u}) AS HUGEINT) - CAST(sum({u}) AS HUGEINT) * CAST(sum({u}) AS HUGEINT))"
    return (f"CASE WHEN count({c}) > 1 THEN sqrt(CAST({spread} AS DOUBLE) / CAST(count({c}) * (count({c}) - 1) AS DOUBLE))"
            f" / CAST(1000000.0 AS DOUBLE) END")


def _clip(c: str, lo, hi) -> str:
    return f"CASE WHEN {c} < {lo} THEN {lo} WHEN {c} > {hi} THEN {hi} ELSE {c} END"


# ---------------------------------------------------------------------------
# Role tables
# ---------------------------------------------------------------------------
cte("_txn_base", """
SELECT concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR)) AS transaction_id,
       CASE WHEN l.l_orderkey % 101 = 0 THEN NULL ELSE o.o_custkey END AS user_id,
       CASE WHEN l.l_orderkey % 103 = 0 THEN NULL ELSE l.l_partkey END AS product_id,
       CASE WHEN l.l_orderkey % 107 = 0 THEN NULL WHEN l.l_orderkey % 127 = 0 THEN 500
            ELSE CAST(trunc(l.l_quantity) AS BIGINT) END AS quantity,
       CASE WHEN CAST(round(l.l_discount * 100) AS INTEGER) = 10 THEN NULL
            WHEN l.l_orderkey % 113 = 0 THEN CAST(9.0 AS DOUBLE)
            ELSE CAST(1 + CAST(round(l.l_discount * 100) AS INTEGER) % 5 AS DOUBLE) END AS rating,
       CASE WHEN l.l_orderkey % 109 = 0 THEN 'unknown'
            ELSE strftime(o.o_orderdate + to_hours(l.l_orderkey % 24), '%Y-%m-%d %H:%M:%S') END AS timestamp,
       l.l_returnflag AS payment_method,
       l.l_partkey AS _partkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
cte("transactions", """
SELECT * EXCLUDE (_partkey) FROM _txn_base
UNION ALL
SELECT * EXCLUDE (_partkey) FROM _txn_base WHERE _partkey % 97 = 0""", "_txn_base")
cte("clickstream", """
SELECT event_id, user_id,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
       CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
            WHEN 'signup' THEN 'wishlist_add' WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'search'
            ELSE event_type END AS event_type,
       concat_ws('-', CAST(user_id AS VARCHAR), strftime(ts, '%Y%m%d')) AS session_id,
       CASE WHEN event_id % 131 = 0 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp,
       ['mobile', 'desktop', 'tablet', 'kiosk'][CAST(event_id % 4 + 1 AS INTEGER)] AS device,
       value + CASE WHEN event_id % 137 = 0 THEN CAST(3000.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS page_duration_sec
FROM events""")
cte("products", """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CASE WHEN p_partkey % 149 = 0 THEN -p_retailprice ELSE p_retailprice END + _copy AS price,
       p_brand AS brand, CAST(1 + p_size % 5 AS DOUBLE) AS avg_rating, CAST(p_size AS BIGINT) AS num_reviews,
       p_size % 7 <> 0 AS in_stock
FROM part JOIN (SELECT unnest([0, 1]) AS _copy) ON _copy = 0 OR p_partkey % 89 = 0""")
cte("users", """
SELECT c.c_custkey AS user_id, CAST(18 + c.c_custkey % 47 + _copy AS BIGINT) AS age,
       CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'M' WHEN 'BUILDING' THEN 'F' WHEN 'FURNITURE' THEN 'Other'
            WHEN 'HOUSEHOLD' THEN 'M' ELSE c.c_mktsegment END AS gender,
       n.n_name AS location, CAST(f.first_order AS DATE) AS signup_date, c.c_acctbal > 5000 AS is_premium
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
       ON c.c_custkey = f.o_custkey
JOIN (SELECT unnest([0, 1]) AS _copy) ON _copy = 0 OR c.c_custkey % 83 = 0""")
cte("external_scores", f"""
SELECT p_partkey AS product_id,
       CAST(p_size - 25 AS DOUBLE) / CAST(25.0 AS DOUBLE) AS sentiment_score,
       CAST(p_size AS DOUBLE) * CAST(2.0 AS DOUBLE) AS popularity_score,
       CAST(p_partkey % 499 + 1 AS BIGINT) AS trending_rank,
       CAST(p_partkey % 5000 AS BIGINT) AS social_mentions,
       CAST(0.8 AS DOUBLE) + CAST(p_partkey % 41 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS competitor_price_ratio,
       {AS_OF} AS fetch_timestamp
FROM part""")

# ---------------------------------------------------------------------------
# Cleaned tables
# ---------------------------------------------------------------------------
cte("_t_keys", """
SELECT * FROM (SELECT DISTINCT * FROM transactions)
WHERE transaction_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL""", "transactions")
cte("transactions_clean", f"""
SELECT transaction_id, user_id, product_id, COALESCE(quantity, 1) AS quantity,
       {_clip('r', 1.0, 5.0)} AS rating, ts AS timestamp, payment_method,
       CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month
FROM (SELECT *, COALESCE(rating, (SELECT median(rating) FROM _t_keys)) AS r,
             try_strptime(timestamp, {TS_FMT}) AS ts FROM _t_keys)
WHERE ts IS NOT NULL""", "_t_keys")
cte("clickstream_clean", f"""
SELECT event_id, user_id, product_id, event_type, session_id, ts AS timestamp, device,
       {_clip('page_duration_sec', 0.0, 1800.0)} AS page_duration_sec,
       CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour
FROM (SELECT *, try_strptime(timestamp, {TS_FMT}) AS ts FROM (SELECT DISTINCT * FROM clickstream))
WHERE ts IS NOT NULL""", "clickstream")


def _first_per_key(table: str, key: str, others: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in others)
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rn"
            f" FROM {table}) WHERE _rn = 1")


def _codes(table: str, c: str) -> str:
    return (f"SELECT {c} AS _v, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS _code"
            f" FROM (SELECT DISTINCT {c} FROM {table} WHERE {c} IS NOT NULL)")


cte("_p_dedup", _first_per_key("products", "product_id",
                               [f.name for f in S.PRODUCTS.fields if f.name != "product_id"]), "products")
cte("_p_imp", """
SELECT * REPLACE (COALESCE(avg_rating, (SELECT median(avg_rating) FROM _p_dedup)) AS avg_rating,
                  COALESCE(num_reviews, 0) AS num_reviews)
FROM _p_dedup""", "_p_dedup")
cte("products_clean", f"""
SELECT p.*,
       (p.price - (SELECT min(price) FROM _p_imp))
         / NULLIF((SELECT max(price) FROM _p_imp) - (SELECT min(price) FROM _p_imp), 0) AS price_normalized,
       COALESCE(cc._code, -1) AS category_encoded
FROM _p_imp p LEFT JOIN ({_codes('_p_imp', 'category')}) cc ON p.category = cc._v""", "_p_imp")
cte("_u_dedup", _first_per_key("users", "user_id",
                               [f.name for f in S.USERS.fields if f.name != "user_id"]), "users")
cte("users_clean", f"""
SELECT u.*,
       CAST(CASE u.gender WHEN 'M' THEN 0 WHEN 'F' THEN 1 WHEN 'Other' THEN 2 END AS INTEGER) AS gender_encoded,
       COALESCE(lc._code, -1) AS location_encoded,
       (CAST(u.age AS DOUBLE) - (SELECT min(age) FROM _u_dedup))
         / NULLIF(CAST((SELECT max(age) FROM _u_dedup) - (SELECT min(age) FROM _u_dedup) AS DOUBLE), 0) AS age_normalized,
       {_days_between('u.signup_date', AS_OF)} AS days_since_signup
FROM _u_dedup u LEFT JOIN ({_codes('_u_dedup', 'location')}) lc ON u.location = lc._v""", "_u_dedup")

# ---------------------------------------------------------------------------
# Aggregates and feature tables
# ---------------------------------------------------------------------------
cte("user_txn", f"""
SELECT *, {_days_between('last_purchase', AS_OF)} AS days_since_last_purchase,
       CAST(total_transactions AS DOUBLE)
         / (CAST({_days_between('first_purchase', 'last_purchase')} + 1 AS DOUBLE) / CAST(30.0 AS DOUBLE)) AS purchase_frequency
FROM (SELECT user_id, count(transaction_id) AS total_transactions,
             CAST(COALESCE(sum(quantity), 0) AS BIGINT) AS total_quantity,
             {exact_mean('rating')} AS avg_rating_given, COALESCE({exact_std('rating')}, 0.0) AS std_rating_given,
             count(DISTINCT product_id) AS unique_products_bought, avg(quantity) AS avg_quantity_per_txn,
             min(timestamp) AS first_purchase, max(timestamp) AS last_purchase
      FROM transactions_clean WHERE user_id IS NOT NULL GROUP BY user_id)""", "transactions_clean")
cte("user_clicks", f"""
SELECT *, total_events * CAST(0.3 AS DOUBLE) + avg_page_duration * CAST(0.3 AS DOUBLE)
          + cart_adds * CAST(0.2 AS DOUBLE) + unique_products_viewed * CAST(0.2 AS DOUBLE) AS engagement_score
FROM (SELECT user_id, count(event_id) AS total_events, count(DISTINCT session_id) AS total_sessions,
             {exact_mean('page_duration_sec')} AS avg_page_duration, count(DISTINCT product_id) AS unique_products_viewed,
             count_if(event_type = 'add_to_cart') AS cart_adds, count_if(event_type = 'search') AS searches
      FROM clickstream_clean WHERE user_id IS NOT NULL GROUP BY user_id)""", "clickstream_clean")
cte("user_features", """
SELECT t.user_id, total_transactions, total_quantity, avg_rating_given, std_rating_given,
       unique_products_bought, avg_quantity_per_txn, first_purchase, last_purchase,
       days_since_last_purchase, purchase_frequency, total_events, total_sessions, avg_page_duration,
       unique_products_viewed, cart_adds, searches, engagement_score, age, gender_encoded,
       location_encoded, is_premium, age_normalized, days_since_signup,
       CASE WHEN unique_products_viewed IS NULL THEN NULL
            ELSE least(CAST(unique_products_bought AS DOUBLE) / CAST(greatest(unique_products_viewed, 1) AS DOUBLE), CAST(1.0 AS DOUBLE))
       END AS conversion_rate
FROM user_txn t LEFT JOIN user_clicks c ON t.user_id = c.user_id
LEFT JOIN users_clean u ON t.user_id = u.user_id""", "user_txn", "user_clicks", "users_clean")
cte("item_txn", f"""
SELECT *, CAST(total_purchases AS DOUBLE) / CAST(max(total_purchases) OVER () AS DOUBLE) AS purchase_popularity
FROM (SELECT product_id, count(transaction_id) AS total_purchases, count(DISTINCT user_id) AS unique_buyers,
             {exact_mean('rating')} AS avg_rating_received, COALESCE({exact_std('rating')}, 0.0) AS std_rating_received,
             CAST(COALESCE(sum(quantity), 0) AS BIGINT) AS total_quantity_sold,
             avg(quantity) AS avg_quantity_per_purchase
      FROM transactions_clean WHERE product_id IS NOT NULL GROUP BY product_id)""", "transactions_clean")
cte("item_clicks", f"""
SELECT *, CAST(cart_add_count AS DOUBLE) / CAST(greatest(total_views, 1) AS DOUBLE) AS view_to_purchase_ratio
FROM (SELECT product_id, count(event_id) AS total_views, count(DISTINCT user_id) AS unique_viewers,
             {exact_mean('page_duration_sec')} AS avg_view_duration,
             count_if(event_type = 'add_to_cart') AS cart_add_count,
             count_if(event_type = 'wishlist_add') AS wishlist_count
      FROM clickstream_clean WHERE product_id IS NOT NULL GROUP BY product_id)""", "clickstream_clean")
cte("_item_joined", """
SELECT t.product_id, total_purchases, unique_buyers, avg_rating_received, std_rating_received,
       total_quantity_sold, avg_quantity_per_purchase, purchase_popularity, total_views, unique_viewers,
       avg_view_duration, cart_add_count, wishlist_count, view_to_purchase_ratio, p.category, p.price,
       p.brand, p.price_normalized, p.category_encoded, p.num_reviews, p.in_stock, e.sentiment_score,
       e.popularity_score, e.trending_rank, e.social_mentions
FROM item_txn t LEFT JOIN item_clicks c ON t.product_id = c.product_id
LEFT JOIN products_clean p ON t.product_id = p.product_id
LEFT JOIN external_scores e ON t.product_id = e.product_id""",
    "item_txn", "item_clicks", "products_clean", "external_scores")
cte("item_features", """
SELECT i.*, b.brand_total_purchases
FROM _item_joined i LEFT JOIN (SELECT brand, CAST(sum(total_purchases) AS BIGINT) AS brand_total_purchases
                               FROM _item_joined WHERE brand IS NOT NULL GROUP BY brand) b
  ON i.brand = b.brand""", "_item_joined")
cte("pair_txn", f"""
SELECT user_id, product_id, {exact_mean('rating')} AS avg_rating, count(rating) AS num_interactions,
       CAST(COALESCE(sum(quantity), 0) AS BIGINT) AS total_quantity, max(timestamp) AS last_interaction
FROM transactions_clean WHERE user_id IS NOT NULL AND product_id IS NOT NULL
GROUP BY user_id, product_id""", "transactions_clean")
cte("pair_clicks", f"""
SELECT user_id, product_id, count(event_id) AS view_count,
       COALESCE({exact_sum('page_duration_sec')}, 0.0) AS total_view_duration,
       max(CAST(event_type = 'add_to_cart' AS INTEGER)) AS added_to_cart,
       max(CAST(event_type = 'wishlist_add' AS INTEGER)) AS added_to_wishlist
FROM clickstream_clean WHERE user_id IS NOT NULL AND product_id IS NOT NULL
GROUP BY user_id, product_id""", "clickstream_clean")
cte("interaction_features", """
SELECT *, avg_rating * CAST(0.4 AS DOUBLE) + num_interactions * CAST(0.2 AS DOUBLE)
          + view_count * CAST(0.1 AS DOUBLE) + added_to_cart * CAST(0.15 AS DOUBLE)
          + added_to_wishlist * CAST(0.15 AS DOUBLE) AS interaction_score
FROM (SELECT COALESCE(t.user_id, c.user_id) AS user_id, COALESCE(t.product_id, c.product_id) AS product_id,
             COALESCE(avg_rating, 0.0) AS avg_rating, COALESCE(num_interactions, 0) AS num_interactions,
             COALESCE(total_quantity, 0) AS total_quantity, last_interaction,
             COALESCE(view_count, 0) AS view_count, COALESCE(total_view_duration, 0.0) AS total_view_duration,
             CAST(COALESCE(added_to_cart, 0) AS INTEGER) AS added_to_cart,
             CAST(COALESCE(added_to_wishlist, 0) AS INTEGER) AS added_to_wishlist
      FROM pair_txn t FULL OUTER JOIN pair_clicks c
        ON t.user_id = c.user_id AND t.product_id = c.product_id)""", "pair_txn", "pair_clicks")

# ---------------------------------------------------------------------------
# Recommender: split, content vectors, content recommendations, metrics
# ---------------------------------------------------------------------------
_NON_NUMERIC_ITEM_COLUMNS = {"category", "brand", "in_stock"}
CB_FEATURES = [c for c in S.ITEM_FEATURE_COLUMNS
               if c not in _NON_NUMERIC_ITEM_COLUMNS and "id" not in c.lower() and "_encoded" not in c]
_BUCKET = ("(('0x' || substr(md5(concat_ws('|', '42', CAST(user_id AS VARCHAR), CAST(product_id AS VARCHAR))),"
           " 1, 8))::BIGINT % 100)")

cte("_split", f"SELECT *, {_BUCKET} < 20 AS is_test FROM interaction_features", "interaction_features")
cte("train_pairs", "SELECT * EXCLUDE (is_test) FROM _split WHERE NOT is_test", "_split")
cte("test_pairs", "SELECT * EXCLUDE (is_test) FROM _split WHERE is_test", "_split")
cte("_cb_filled", "SELECT product_id, " + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}"
                                                   for c in CB_FEATURES) + " FROM item_features", "item_features")
cte("_cb_stats", "SELECT " + ", ".join(f"min({c}) AS lo_{i}, max({c}) AS hi_{i}" for i, c in enumerate(CB_FEATURES))
    + " FROM _cb_filled", "_cb_filled")
cte("cb_vectors", "SELECT product_id, [" + ", ".join(
    f"CASE WHEN hi_{i} = lo_{i} THEN 0.0 ELSE ({c} - lo_{i}) / (hi_{i} - lo_{i}) END" for i, c in enumerate(CB_FEATURES))
    + "] AS vec FROM _cb_filled, _cb_stats", "_cb_filled", "_cb_stats")
cte("cb_unit", "SELECT product_id, CASE WHEN n > 0 THEN list_transform(vec, lambda x: x / n)"
    " ELSE list_transform(vec, lambda x: x * 0.0) END AS vec"
    " FROM (SELECT *, sqrt(list_reduce(list_prepend(0.0, list_transform(vec, lambda x: x * x)), lambda a, b: a + b)) AS n"
    " FROM cb_vectors)", "cb_vectors")
cte("_cells", "SELECT user_id, product_id, CAST(avg_rating AS DOUBLE) AS value FROM train_pairs WHERE avg_rating > 0",
    "train_pairs")
cte("_dev_mean", "SELECT round(avg(value), 6) AS m FROM _cells", "_cells")
for _side, _key in (("user", "user_id"), ("item", "product_id")):
    cte(f"_dev_{_side}", f"SELECT {_key}, COALESCE(round(avg(value) - (SELECT m FROM _dev_mean), 6), 0.0) AS f"
        f" FROM (SELECT DISTINCT {_key} FROM train_pairs) LEFT JOIN _cells USING ({_key}) GROUP BY {_key}",
        "train_pairs", "_cells", "_dev_mean")
_FEATURE_LIST = "[" + ", ".join(f"'{c}'" for c in CB_FEATURES) + "]"


def long_vectors(table: str) -> str:
    return f"SELECT product_id, unnest({_FEATURE_LIST}) AS feature, unnest(vec) AS value FROM {table}"


def cb_recs(history: str, users_filter: str | None = None) -> str:
    """Top-10 content recommendations for every user with history rows."""
    users = f"SELECT DISTINCT user_id FROM {history}" + (f" WHERE user_id IN ({users_filter})" if users_filter else "")
    hist = f"SELECT h.user_id, h.product_id FROM {history} h WHERE h.user_id IN ({users})"
    prof = ("SELECT user_id, list(v ORDER BY f) AS vec FROM (SELECT h.user_id, f, sum(v) AS v FROM (" + hist + ") h"
            " JOIN (SELECT product_id, generate_subscripts(vec, 1) AS f, unnest(vec) AS v FROM cb_unit) l"
            " ON h.product_id = l.product_id GROUP BY h.user_id, f) GROUP BY user_id")
    zero = f"list_transform(range({len(CB_FEATURES)}), lambda x: 0.0)"
    q = (f"SELECT u.user_id, COALESCE(p.vec, {zero}) AS vec FROM ({users}) u LEFT JOIN ({prof}) p"
         " ON u.user_id = p.user_id")
    seen = f"SELECT DISTINCT h.user_id, h.product_id FROM ({hist}) h JOIN cb_unit c ON h.product_id = c.product_id"
    scores = (f"SELECT q.user_id, i.product_id, CASE WHEN s.product_id IS NOT NULL THEN -1.0"
              f" ELSE list_dot_product(q.vec, i.vec) END AS score FROM ({q}) q CROSS JOIN cb_unit i"
              f" LEFT JOIN ({seen}) s ON s.user_id = q.user_id AND s.product_id = i.product_id")
    return (f"SELECT user_id, CAST(rank AS INTEGER) AS rank, product_id, score FROM (SELECT *, row_number() OVER"
            f" (PARTITION BY user_id ORDER BY score DESC, product_id ASC) AS rank FROM ({scores})) WHERE rank <= 10")


_DEV_SCORE = "least(greatest((SELECT m FROM _dev_mean) + u.f * i.f, 1.0), 5.0)"
DEV_CTES = ("_dev_mean", "_dev_user", "_dev_item", "train_pairs", "test_pairs")


def dev_predictions(pairs: str) -> str:
    """M5 with the one-dimensional model: unknown ids get the mean."""
    return (f"SELECT p.user_id, p.product_id, CASE WHEN u.f IS NULL OR i.f IS NULL THEN (SELECT m FROM _dev_mean)"
            f" ELSE {_DEV_SCORE} END AS prediction FROM {pairs} p LEFT JOIN _dev_user u ON p.user_id = u.user_id"
            f" LEFT JOIN _dev_item i ON p.product_id = i.product_id")


def dev_recs(users: str | None = None, n: int = 10, drop_seen: bool = False) -> str:
    """M6 with the one-dimensional model."""
    cond = [f"u.user_id IN ({users})"] if users else []
    if drop_seen:
        cond.append("NOT EXISTS (SELECT 1 FROM train_pairs t WHERE t.user_id = u.user_id AND t.product_id = i.product_id)")
    scores = (f"SELECT u.user_id, i.product_id, {_DEV_SCORE} AS score FROM _dev_user u CROSS JOIN _dev_item i"
              + (" WHERE " + " AND ".join(cond) if cond else ""))
    return (f"SELECT user_id, CAST(rank AS INTEGER) AS rank, product_id, score FROM (SELECT *, row_number() OVER"
            f" (PARTITION BY user_id ORDER BY score DESC, product_id ASC) AS rank FROM ({scores})) WHERE rank <= {n}")


def per_user_metrics(recs: str, users: str, k: int = 10) -> str:
    act = f"SELECT user_id, product_id FROM test_pairs WHERE user_id IN ({users})"
    n_act = f"SELECT user_id, count(*) AS n_actual FROM ({act}) GROUP BY user_id"
    hits = (f"SELECT r.user_id, count(*) AS hits, sum(1.0 / log2(r.rank + 1)) AS dcg FROM ({recs}) r"
            f" JOIN (SELECT DISTINCT * FROM ({act})) a ON r.user_id = a.user_id AND r.product_id = a.product_id"
            f" WHERE r.rank <= {k} GROUP BY r.user_id")
    idcg = (f"list_reduce(list_prepend(0.0, list_transform(range(1, CAST(least(n.n_actual, {k}) AS BIGINT) + 1),"
            f" lambda r: 1.0 / log2(r + 1))), lambda a, b: a + b)")
    return (f"SELECT n.user_id, CAST(COALESCE(h.hits, 0) AS DOUBLE) / {float(k)} AS precision_at_k,"
            f" CASE WHEN n.n_actual > 0 THEN CAST(COALESCE(h.hits, 0) AS DOUBLE) / CAST(n.n_actual AS DOUBLE)"
            f" ELSE 0.0 END AS recall_at_k,"
            f" CASE WHEN n.n_actual > 0 THEN COALESCE(h.dcg, 0.0) / {idcg} ELSE 0.0 END AS ndcg_at_k"
            f" FROM (SELECT DISTINCT user_id FROM ({users})) u JOIN ({n_act}) n ON u.user_id = n.user_id"
            f" LEFT JOIN ({hits}) h ON n.user_id = h.user_id")


SAMPLE_USERS = ("SELECT user_id FROM (SELECT DISTINCT user_id FROM test_pairs)"
                " ORDER BY md5(concat_ws('|', '42', CAST(user_id AS VARCHAR))), user_id LIMIT 100")
