from basketry.operators import profile as P


def test_histogram_last_bin_closed_and_empty_bins_present(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (3.0,), (5.0,)], "rating double")
    h = [(r.bin, r["count"]) for r in P.rating_histogram(df).orderBy("bin").collect()]
    assert h == [(1, 2), (2, 0), (3, 1), (4, 0), (5, 1)]


def test_histogram_constant_column_middle_bin(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "rating double")
    h = {r.bin: r["count"] for r in P.histogram(df, "rating", 5).collect()}
    assert h[3] == 2 and sum(h.values()) == 2


def test_histogram_all_null_is_empty(spark):
    df = spark.createDataFrame([(None,), (None,)], "rating double")
    assert P.histogram(df, "rating", 5).count() == 0


def test_top_k_ties_by_id(spark):
    df = spark.createDataFrame([(3,), (1,), (2,), (2,), (3,), (None,)], "product_id long")
    out = [(r.product_id, r.txn_count) for r in P.top_products(df, 2).collect()]
    assert out == [(2, 2), (3, 2)]


def test_category_share_pct(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "category string")
    out = {r.category: (r["count"], r.pct) for r in P.category_share(df).collect()}
    assert out == {"a": (2, 50.0), "b": (1, 25.0)}


def test_interaction_pivot_wide(spark):
    rows = [(1, 10, 4.0), (1, 10, 2.0), (1, 11, 5.0), (2, 11, 1.0), (3, 12, 3.0)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, rating double")
    wide = {r.user_id: r.asDict() for r in P.interaction_pivot(df, k=2).collect()}
    # top-2 users: 1 (3 rows), then 2 and 3 tie at 1 row -> 2; top-2 products in order: p1 is 10, p2 is 11
    assert set(wide) == {1, 2}
    assert wide[1]["p1"] == 3.0 and wide[1]["p2"] == 5.0 and wide[2]["p1"] is None


def test_sparsity_counts_rows_not_pairs(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (2, 11)], "user_id long, product_id long")
    r = P.interaction_sparsity(df).first()
    assert r.n_interactions == 3 and abs(r.sparsity - (1 - 3 / 4)) < 1e-12
