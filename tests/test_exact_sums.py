from pyspark.sql import functions as F

from basketry.functions.exprs import split_sum
from basketry.operators import snapshots as K


def test_sums_over_the_range_of_longs_are_exact(spark):
    most = (1 << 63) - 1
    for values in ([most, most, 5, None], [-most, -most, -1], [(1 << 31) - 1, 1 << 31, -(1 << 31)], [0]):
        df = spark.createDataFrame([(x,) for x in values], "h long").repartition(2)
        assert int(df.agg(split_sum(F.col("h"))).first()[0]) == sum(x for x in values if x is not None)
    assert spark.createDataFrame([], "h long").agg(split_sum(F.col("h"))).first()[0] is None


def test_fingerprint_adds_no_decimals_up_row_by_row(spark):
    df = spark.range(1000).select("id", (F.col("id") * 0.25).alias("x"))
    plan = K.fingerprint(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(conv(" not in plan.lower()
    h = F.conv(F.substring(F.md5(K._canonical(df).cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    assert K.fingerprint(df).first()["hash_sum"] == df.agg(F.sum(h)).first()[0]
