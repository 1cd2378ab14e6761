import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from basketry.operators import features as FE

T0 = dt.datetime(2024, 1, 1, 10, 0)


def _txn(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, user_id long, product_id long, quantity long,"
                                       " rating double, timestamp timestamp_ntz")


def _clicks(spark, rows):
    return spark.createDataFrame(rows, "event_id long, user_id long, product_id long, event_type string,"
                                       " session_id string, page_duration_sec double")


def test_user_txn_single_purchase_std_zero_and_frequency(spark):
    t = _txn(spark, [("T1", 1, 10, 2, 4.0, T0), ("T2", 2, 10, 1, 3.0, T0),
                     ("T3", 2, 11, 3, 5.0, T0 + dt.timedelta(days=29))])
    out = {r.user_id: r for r in FE.purchase_frequency(FE.user_txn_agg(t)).collect()}
    assert out[1].std_rating_given == 0.0 and out[1].purchase_frequency == 30.0
    assert out[2].unique_products_bought == 2 and out[2].purchase_frequency == 2 / (30 / 30)


def test_conversion_null_without_clicks(spark):
    t = _txn(spark, [("T1", 1, 10, 1, 4.0, T0), ("T2", 2, 10, 1, 4.0, T0), ("T3", 2, 11, 1, 4.0, T0)])
    c = _clicks(spark, [(1, 2, 10, "product_view", "s", 5.0)])
    users = spark.createDataFrame([(1, 30, 0, 0, True, 0.5, 10), (2, 40, 1, 1, False, 1.0, 20)],
                                  "user_id long, age long, gender_encoded int, location_encoded int,"
                                  " is_premium boolean, age_normalized double, days_since_signup long")
    uf = {r.user_id: r for r in FE.user_features(t, c, users).collect()}
    assert uf[1].conversion_rate is None and uf[1].total_events is None
    assert uf[2].conversion_rate == 1.0      # min(1, 2 bought / 1 viewed)
    assert len(FE.user_features(t, c, users).columns) == 25


def test_interaction_click_only_pair_zero_rating_null_time(spark):
    t = _txn(spark, [("T1", 1, 10, 2, 4.0, T0)])
    c = _clicks(spark, [(1, 1, 11, "add_to_cart", "s", 5.0), (2, 1, 11, "product_view", "s", 7.0)])
    out = {(r.user_id, r.product_id): r for r in FE.interaction_features(t, c).collect()}
    click_only = out[(1, 11)]
    assert click_only.avg_rating == 0.0 and click_only.last_interaction is None
    assert click_only.view_count == 2 and click_only.added_to_cart == 1 and click_only.added_to_wishlist == 0
    assert abs(click_only.interaction_score - (0.1 * 2 + 0.15)) < 1e-12
    assert abs(out[(1, 10)].interaction_score - (0.4 * 4 + 0.2)) < 1e-12


def test_brand_totals_join_back_and_null_brand(spark):
    items = spark.createDataFrame([(1, "A", 3), (2, "A", 4), (3, None, 5)],
                                  "product_id long, brand string, total_purchases long")
    out = {r.product_id: r.brand_total_purchases for r in FE.brand_total_purchases(items).collect()}
    assert out == {1: 7, 2: 7, 3: None}


def test_dense_index_matches_sorted_order(spark):
    ids = spark.range(0, 500).select((F.col("id") * 7 % 1000).alias("k")).union(spark.range(0, 20).select(F.col("id").alias("k")))
    idx = FE.dense_index(ids, "k", "i", partitions=5).orderBy("i").collect()
    keys = [r.k for r in idx]
    assert keys == sorted(set(keys)) and [r.i for r in idx] == list(range(len(keys)))


def test_sparsity_counts_zero_cells(spark):
    pairs = spark.createDataFrame([(1, 1, 4.0), (1, 2, 0.0), (2, 1, 3.0)], "user_id long, product_id long, avg_rating double")
    r = FE.matrix_sparsity(pairs).first()
    assert r.nnz == 3 and abs(r.sparsity - 0.25) < 1e-12


def test_dense_index_without_exchange_reuse(spark):
    conf = {"spark.sql.exchange.reuse": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "7"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ids = spark.range(20_000).select(((F.col("id") * 7919) % 19_997).alias("x"))
        rows = FE.dense_index(ids, "x").orderBy("x").collect()
        assert [r.idx for r in rows] == list(range(len(rows))) and len({r.x for r in rows}) == len(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    from basketry.operators.quantiles import exact_median, exact_quantiles
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=501), rng.integers(0, 4, 501).astype(float)
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b)], "a double, b double, c double").repartition(5)
    got = {(r["column"], r["q"]): r["value"] for r in exact_quantiles(df, ["a", "b", "c"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    assert set(c for c, _ in got) == {"a", "b"}
    for (c, q), v in got.items():
        assert np.isclose(v, np.quantile({"a": a, "b": b}[c], q))
    assert df.limit(1).select(exact_median(df, "c").alias("m")).first().m is None


def test_quantiles_move_only_bracketed_values(spark):
    from basketry.operators import quantiles as QU
    rng = np.random.default_rng(11)
    values = rng.normal(size=200_000)
    df = spark.createDataFrame([(float(x), float(i % 5)) for i, x in enumerate(values)], "a double, b double").repartition(4)
    got = {(r["column"], r["q"]): r["value"] for r in QU.exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75]).collect()}
    for q in (0.25, 0.5, 0.75):
        assert got["a", q] == np.quantile(values, q) and got["b", q] == np.quantile(np.arange(200_000) % 5, q)
    inside = 0
    for c, q, lo, hi, under, at in QU.brackets(df, ["a"], [0.25, 0.5, 0.75]):
        assert under <= at and (values < lo).sum() == under
        inside += ((values >= lo) & (values <= hi)).sum()
    assert inside < 0.01 * len(values)


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    from basketry.operators import quantiles as QU
    df = spark.createDataFrame([(float(i),) for i in range(1000)], "a double")
    monkeypatch.setattr(QU.F, "percentile_approx", lambda c, p, a: QU.F.array(*[QU.F.lit(x) for x in (900.0, 901.0)]))
    assert QU.exact_quantiles(df, ["a"], [0.25]).first()["value"] == 249.75


def test_exact_aggregates(spark):
    from basketry.functions.exprs import exact_mean, exact_std, exact_sum
    rng = np.random.default_rng(5)
    x = rng.random(3000).round(6) * 1000
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(x)] + [(7, None), (8, 1.5)], "k long, v double")
    agg = lambda d: {r.k: r[1:] for r in d.groupBy("k").agg(exact_sum("v"), exact_mean("v"), exact_std("v")).collect()}
    got = agg(df.repartition(2))
    assert got == agg(df.repartition(9, "v"))  # to the last bit
    for k in range(3):
        assert np.allclose(got[k], (x[k::3].sum(), x[k::3].mean(), x[k::3].std(ddof=1)), rtol=1e-9)
    assert got[7] == (None, None, None) and got[8] == (1.5, 1.5, None)


def test_feature_tables_read_each_sources_rows_once(spark, monkeypatch):
    from basketry.plans import context
    cleaned, summed = [], []
    clean, sums = context.C.clean_clickstream, context.FE.pair_sums
    monkeypatch.setattr(context.C, "clean_clickstream", lambda raw: cleaned.append(1) or clean(raw))
    monkeypatch.setattr(context.FE, "pair_sums", lambda txn: summed.append(1) or sums(txn))
    t = context.Tables(spark, "/root/testdata/sf0.001")
    got = t.all_features
    assert len(cleaned) == len(summed) == 1
    # the tables' plans start from written rows: no source is read, nothing deduplicated again
    for name in ("user_features", "interaction_features"):
        files = got[name].inputFiles()
        assert files and all("basketry-cut" in f for f in files if "customer" not in f and "nation" not in f and "orders" not in f)
    alone = {"user_features": t.user_features, "item_features": t.item_features, "interaction_features": t.interactions}
    for name, df in alone.items():
        assert got[name].schema == df.schema
        assert got[name].exceptAll(df).count() == 0 == df.exceptAll(got[name]).count()


def test_pair_sums_keep_null_keys_and_ratings(spark):
    rows = [("a", 1, 10, 2, 4.0, 1), ("b", 1, 10, None, None, 2), ("c", 1, None, 5, 3.0, 3), ("d", None, 10, 7, 1.0, 4),
            ("e", 1, 11, 1, 2.5, 5), (None, 2, 11, None, None, 6)]
    txn = spark.createDataFrame(rows, "transaction_id string, user_id long, product_id long, quantity long, rating double,"
                                      " t long").withColumn("timestamp", F.timestamp_seconds("t").cast("timestamp_ntz")).drop("t")
    users = {r["user_id"]: r for r in FE.user_txn_agg(txn).collect()}
    assert (users[1]["total_transactions"], users[1]["total_quantity"], users[1]["unique_products_bought"]) == (4, 8, 2)
    assert users[1]["avg_quantity_per_txn"] == 8 / 3 and users[1]["avg_rating_given"] == 9.5 / 3
    assert (users[2]["total_transactions"], users[2]["total_quantity"], users[2]["avg_quantity_per_txn"]) == (0, 0, None)
    assert users[2]["avg_rating_given"] is None and users[2]["std_rating_given"] == 0.0 and set(users) == {1, 2}
    items = {r["product_id"]: r for r in FE.item_txn_agg(txn).collect()}
    assert (items[10]["total_purchases"], items[10]["unique_buyers"]) == (3, 1) and set(items) == {10, 11}
    pairs = FE.pair_txn_agg(txn)
    assert sorted(map(repr, FE.pair_txn_agg(txn, FE.pair_sums(txn)).collect())) == sorted(map(repr, pairs.collect()))


def test_evaluation_tables_clean_the_purchases_once(spark, monkeypatch):
    from basketry.plans import catalog, context
    from basketry.plans.context import Tables
    cleaned = []
    clean = context.C.clean_transactions
    monkeypatch.setattr(context.C, "clean_transactions", lambda raw: cleaned.append(1) or clean(raw))
    tables = []
    monkeypatch.setattr(catalog.M, "evaluate_cb", lambda unit, pairs, test, dim: tables.extend([unit, pairs]))
    catalog.QUERIES["m19_evaluate_cb"](spark, "/root/testdata/sf0.001")
    assert len(cleaned) == 1
    alone = Tables(spark, "/root/testdata/sf0.001").interactions
    assert tables[1].exceptAll(alone).count() == 0 == alone.exceptAll(tables[1]).count()
