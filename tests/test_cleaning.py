import datetime as dt

from pyspark.sql import functions as F

from basketry import schemas as S
from basketry.operators import cleaning as C

TXN = "transaction_id string, user_id long, product_id long, quantity long, rating double, timestamp string, payment_method string"


def test_dedup_exact_treats_null_as_equal(spark):
    df = spark.createDataFrame([("T1", None, 1, None, 4.0, "2024-01-01 00:00:00", "card")] * 3
                               + [("T2", 1, 1, 1, 3.0, "2024-01-01 00:00:00", "card")], TXN)
    assert C.dedup_exact(df).count() == 2


def test_dedup_by_key_is_deterministic_and_keeps_null_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z"), (None, "y"), (2, None)], "k long, v string")
    out = {r["k"]: r["v"] for r in C.dedup_by_key(df, "k").collect()}
    assert out == {1: "a", None: "y", 2: None}
    # same answer under a different partitioning
    out2 = {r["k"]: r["v"] for r in C.dedup_by_key(df.repartition(3), "k").collect()}
    assert out == out2


def test_impute_median_even_count_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "rating double")
    vals = sorted(r[0] for r in C.impute_median(df, "rating").collect())
    assert vals == [1.0, 2.0, 3.0, 4.0, 10.0]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(0.5,), (7.0,), (None,), (3.0,)], "rating double")
    assert [r[0] for r in C.clip(df, "rating", 1, 5).collect()] == [1.0, 5.0, None, 3.0]


def test_parse_timestamp_drops_unparseable(spark):
    df = spark.createDataFrame([("2024-03-01 10:00:00",), ("not a date",), (None,)], "timestamp string")
    out = C.parse_timestamp_coerce(df, "timestamp").collect()
    assert len(out) == 1 and out[0][0] == dt.datetime(2024, 3, 1, 10, 0)


def test_date_parts_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 13, 0),), (dt.datetime(2024, 1, 7, 1, 0),)],
                               "timestamp timestamp_ntz")
    rows = C.date_parts(df).orderBy("timestamp").collect()
    assert [(r.day_of_week, r.hour, r.month) for r in rows] == [(0, 13, 1), (6, 1, 1)]


def test_min_max_constant_column_is_null(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "price double")
    assert all(r.price_normalized is None for r in C.min_max_scale(df, "price", "price_normalized").collect())
    df2 = spark.createDataFrame([(1.0,), (3.0,), (2.0,)], "price double")
    assert sorted(r.price_normalized for r in C.min_max_scale(df2, "price", "price_normalized").collect()) == [0.0, 0.5, 1.0]


def test_category_codes_lexical_null_minus_one(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "cat string")
    out = sorted((r.cat or "", r.code) for r in C.category_codes(df, "cat", "code").collect())
    assert out == [("", -1), ("a", 0), ("a", 0), ("b", 1), ("c", 2)]


def test_map_encode_unknown_is_null(spark):
    df = spark.createDataFrame([("M",), ("F",), ("Other",), ("X",), (None,)], "gender string")
    out = [r.g for r in C.map_encode(df, "gender", S.GENDER_CODES, "g").collect()]
    assert out == [0, 1, 2, None, None]


def test_days_since_floors_across_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59),), (dt.datetime(2024, 1, 2, 0, 1),)],
                               "ts timestamp_ntz")
    out = [r.d for r in C.days_since(df, "ts", "d", dt.datetime(2024, 1, 2, 0, 0)).collect()]
    assert out == [0, -1]


def test_clean_transactions_order_of_steps(spark):
    rows = [
        ("T1", 1, 10, None, None, "2024-01-01 10:00:00", "card"),
        ("T1", 1, 10, None, None, "2024-01-01 10:00:00", "card"),   # exact duplicate
        ("T2", None, 10, 2, 5.0, "2024-01-02 10:00:00", "card"),     # null user -> dropped
        ("T3", 2, 11, 3, 1.0, "2024-01-03 10:00:00", "cash"),
        ("T4", 2, 12, 1, 9.0, "bad", "cash"),                         # clipped, then dropped (bad ts)
    ]
    out = C.clean_transactions(spark.createDataFrame(rows, TXN)).orderBy("transaction_id").collect()
    assert [r.transaction_id for r in out] == ["T1", "T3"]
    # median over T1(null), T3(1.0), T4(9.0) after dedup + key drop = 5.0
    assert out[0].rating == 5.0 and out[0].quantity == 1
    assert out[1].day_of_week == 2
