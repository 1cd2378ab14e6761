"""Exact quantiles of any number of columns, most values never leaving their task.

A mergeable quantile sketch brackets each wanted rank between two values; a
pass over the data counts what lies under and inside each bracket, which also
proves that the bracket holds the rank (else it is widened); only the values
inside the brackets are then counted, range-partitioned and written together
with each row's partition.  Per-partition sums give those values their ranks,
and the neighbours of the wanted positions are picked and interpolated
linearly.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialised

#: The sketch's rank error is at most 1/ACCURACY of the values; brackets reach
#: twice as far to either side, so they hold about 4/ACCURACY of them.
ACCURACY = 5000


def _inside(c: str, lo: float | None, hi: float | None) -> Column:
    """Whether a value lies in a bracket; None is open."""
    x = F.col(c)
    cond = x.isNotNull()
    if lo is not None:
        cond &= x >= F.lit(lo)
    return cond & (x <= F.lit(hi)) if hi is not None else cond


def _under(c: str, lo: float | None) -> Column:
    return F.col(c) < F.lit(lo) if lo is not None else F.lit(False)


def brackets(t: DataFrame, cols: list[str], qs: list[float], accuracy: int = ACCURACY) -> list[tuple]:
    """``(column, q, lo, hi, values under lo, position)`` with positions
    floor and ceil of q·(n−1) inside [lo, hi], for columns with values."""
    reach = 2.0 / accuracy
    probs = F.array(*[F.lit(min(1.0, max(0.0, q + d))) for q in qs for d in (-reach, reach)])
    sketch = t.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"n{i}"), F.percentile_approx(c, probs, accuracy).alias(f"p{i}"))]).first()
    open_ = [(c, q, sketch[f"n{i}"], sketch[f"p{i}"][2 * j] if q > reach else None,
              sketch[f"p{i}"][2 * j + 1] if q + reach < 1 else None)
             for i, c in enumerate(cols) if sketch[f"n{i}"] for j, q in enumerate(qs)]
    found = []
    while open_:
        counts = t.agg(*[x for k, (c, _, _, lo, hi) in enumerate(open_) for x in (
            F.count_if(F.coalesce(_under(c, lo), F.lit(False))).alias(f"u{k}"),
            F.count_if(F.coalesce(_inside(c, lo, hi), F.lit(False))).alias(f"i{k}"))]).first()
        wider = []
        for k, (c, q, n, lo, hi) in enumerate(open_):
            at, under = q * (n - 1), counts[f"u{k}"]
            low, high = under <= math.floor(at), math.ceil(at) < under + counts[f"i{k}"]
            if low and high:
                found.append((c, q, lo, hi, under, at))
            else:
                wider.append((c, q, n, lo if low else None, hi if high else None))
        open_ = wider
    return found


def exact_quantiles(df: DataFrame, cols: list[str], qs: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """``column, q, value``: one row per column with a non-null value and
    quantile ``q``, at position q·(n−1) of the sorted values."""
    narrow = materialised(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), "quantile-columns")
    found = brackets(narrow, cols, qs, accuracy)
    # a bracket of one value is the quantile, however many rows hold that value
    known = df.sparkSession.createDataFrame([(c, float(q), float(lo)) for c, q, lo, hi, _, _ in found if lo is not None and lo == hi],
                                            "column string, q double, value double")
    wanted = [w for w in found if w[2] is None or w[2] != w[3]]
    if not wanted:
        return known
    near = F.array(*[F.when(_inside(c, lo, hi), F.struct(F.lit(c).alias("column"), F.lit(float(q)).alias("q"),
                                                         F.col(c).alias("value"))) for c, q, lo, hi, _, _ in wanted])
    counted = (narrow.select(F.explode(F.filter(near, lambda x: x.isNotNull())).alias("x")).select("x.*")
               .groupBy("column", "q", "value").agg(F.count(F.lit(1)).alias("n")))
    t = materialised(counted.repartitionByRange("column", "q", "value").withColumn("_pid", F.spark_partition_id()),
                     "quantile-values")
    # one row per (partition, column, q)
    sizes = t.groupBy("column", "q", "_pid").agg(F.sum("n").alias("part_n"))
    before = F.coalesce(F.sum("part_n").over(Window.partitionBy("column", "q").orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("column", "q", "_pid", before.alias("before"))
    inside = F.sum("n").over(Window.partitionBy("column", "q", "_pid").orderBy("value")
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    places = F.create_map(*[x for c, q, _, _, under, at in wanted for x in (
        F.struct(F.lit(c).alias("c"), F.lit(float(q)).alias("q")), F.struct(F.lit(under).alias("under"), F.lit(at).alias("at")))])
    ranked = t.withColumn("_in", inside).join(sizes, ["column", "q", "_pid"]).withColumn(
        "_place", places[F.struct(F.col("column").alias("c"), F.col("q"))]).select(
        "column", "q", "value", F.col("_place.at").alias("at"),
        (F.col("_place.under") + F.col("before") + F.col("_in") - F.col("n")).alias("lo"),
        (F.col("_place.under") + F.col("before") + F.col("_in") - F.lit(1)).alias("hi"))
    down, up = F.floor("at"), F.ceil("at")
    low = F.max(F.when((F.col("lo") <= down) & (down <= F.col("hi")), F.col("value")))
    high = F.max(F.when((F.col("lo") <= up) & (up <= F.col("hi")), F.col("value")))
    return (ranked.groupBy("column", "q").agg(low.alias("low"), high.alias("high"), F.max("at").alias("at"))
                .select("column", "q", (F.col("low") + (F.col("high") - F.col("low")) * (F.col("at") - F.floor("at")))
                        .alias("value")).unionByName(known))


def exact_median(df: DataFrame, c: str) -> Column:
    """The median of one column as a scalar (null without values)."""
    return exact_quantiles(df, [c], [0.5]).select("value").scalar()
