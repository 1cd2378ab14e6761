from basketry.operators import quality as Q

TXN = "transaction_id string, user_id long, product_id long, quantity long, rating double, timestamp string, payment_method string"


def _txn(spark, rows):
    return spark.createDataFrame(rows, TXN)


def test_missing_pct_exactly_five_is_critical(spark):
    rows = [(f"T{i}", 1, 1, 1, (None if i == 0 else 3.0), "2024-01-01 00:00:00", "c") for i in range(20)]
    mv = {r.column: r for r in Q.missing_values(_txn(spark, rows), "transactions").collect()}
    assert mv["rating"].null_pct == 5.0 and mv["rating"].severity == "critical"
    rep = Q.report(_txn(spark, rows), "transactions").first()
    assert rep.critical_issues == 1
    # 100 - 2*(5/7) - 15 = 83.57 -> 83.6
    assert rep.overall_quality_score == 83.6


def test_duplicates_and_pk_with_nulls(spark):
    rows = [("T1", None, 1, 1, 3.0, "t", "c")] * 3 + [("T1", 2, 1, 1, 3.0, "t", "c"), (None, 1, 1, 1, 1.0, "t", "c"),
                                                     (None, 2, 1, 1, 1.0, "t", "c")]
    d = Q.duplicates(_txn(spark, rows), "transactions").first()
    assert d.total_duplicates == 2          # the triple row repeats twice
    assert d.primary_key_duplicates == 4    # T1 x4 -> 3 repeats, null x2 -> 1 repeat


def test_rows_with_one_key_are_compared_whole(spark, monkeypatch):
    from pyspark.sql import functions as F
    rows = [(f"T{i % 7}", None, i % 3, 1, 3.0, "t", None) for i in range(40)] + [("T1", 1, None, 1, 3.0, "t", "c")] * 2
    df = _txn(spark, rows)
    want = len(rows) - len(set(rows))
    assert Q.duplicate_rows(df).first().total_duplicates == want
    monkeypatch.setattr(Q, "row_keys", lambda df: [F.lit(1).alias("_k1"), F.lit(2).alias("_k2")])
    assert Q.duplicate_rows(df).first().total_duplicates == want
    assert Q.duplicate_rows(df.limit(0)).first().total_duplicates == 0


def test_nulls_in_other_columns_give_other_keys(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert df.select(*Q.row_keys(df)).distinct().count() == 2


def test_ranges_coerce_and_all_null(spark):
    df = spark.createDataFrame([("0.5",), ("9",), ("x",), ("3",)], "rating string")
    r = {x.column: x for x in Q.ranges(df.withColumnRenamed("rating", "rating"), "transactions").collect()}
    assert r["rating"].below_range == 1 and r["rating"].above_range == 1
    assert r["rating"].actual_min == 0.5 and r["rating"].actual_max == 9.0
    df2 = spark.createDataFrame([(None,), (None,)], "rating double")
    r2 = Q.ranges(df2, "transactions").first()
    assert r2.actual_min is None and r2.below_range == 0


def test_allowed_values_samples_sorted_first_five(spark):
    vals = ["zz", "b", "a", "c", "d", "e", "f", "add_to_cart", None, "a"]
    df = spark.createDataFrame([(v,) for v in vals], "event_type string")
    r = Q.allowed_values(df, "clickstream").first()
    assert r.invalid_count == 8
    assert r.invalid_samples == "a,b,c,d,e"


def test_schema_mismatch_is_critical(spark):
    df = spark.createDataFrame([("P1", "n")], "product_id string, product_name string")
    iss = Q.issues(df, "products").collect()
    assert any(i.type == "schema_mismatch" and i.details == "Missing columns: ['category', 'price', 'brand']"
               for i in iss)
    assert Q.report(df, "products").first().overall_quality_score == 85.0


def test_empty_table(spark):
    df = spark.createDataFrame([], TXN)
    rep = Q.report(df, "transactions").first()
    assert rep.total_issues == 0 and rep.overall_quality_score == 100.0


def test_numeric_summary_linear_quartiles(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "price double")
    r = Q.numeric_summary(df, "products").first()
    assert (r.p25, r.p50, r.p75) == (1.75, 2.5, 3.25)
    assert abs(r.std - 1.2909944487358056) < 1e-12
