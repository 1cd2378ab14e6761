"""Scalar column expressions shared by the operators.

All are built-in Spark expressions (JVM side, inside whole-stage codegen).
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo, hi) -> Column:
    """Clamp to [lo, hi]; null stays null (``least``/``greatest`` would skip nulls)."""
    x = col_(c)
    return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)


def safe_div(num, den) -> Column:
    """Division that yields null instead of raising under ANSI mode."""
    return F.try_divide(col_(num), col_(den))


def parse_timestamp(c, fmt: str) -> Column:
    """Parse a string to TIMESTAMP_NTZ; unparseable -> null.

    ``try_to_timestamp`` reads the wall clock in the session zone and the NTZ
    cast reads it back in the same zone, so the result is zone independent.
    """
    return F.try_to_timestamp(col_(c), F.lit(fmt)).cast("timestamp_ntz")


def as_of_literal(as_of) -> Column:
    """A fixed 'now' as a TIMESTAMP_NTZ literal."""
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    elif isinstance(as_of, _dt.date) and not isinstance(as_of, _dt.datetime):
        as_of = _dt.datetime(as_of.year, as_of.month, as_of.day)
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def whole_days_between(start, end) -> Column:
    """Whole 24 h periods from ``start`` to ``end`` (floor, may be negative)."""
    us = F.timestamp_diff("MICROSECOND", col_(start).cast("timestamp_ntz"),
                          col_(end).cast("timestamp_ntz"))
    return F.floor(us / F.lit(MICROS_PER_DAY)).cast("long")


def weekday_mon0(c) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(col_(c))


def hash_bucket(seed: int, *cols, buckets: int = 100) -> Column:
    """Reproducible bucket in [0, buckets) from the md5 of ``seed|c1|c2...``.

    The first 8 hex digits of md5 are read as an unsigned integer, which
    DuckDB computes identically, so splits agree across engines and do not
    depend on partitioning.
    """
    key = F.concat_ws("|", F.lit(str(seed)), *[col_(c).cast("string") for c in cols])
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def hash_order_key(seed: int, c) -> Column:
    """Deterministic pseudo-random ordering key for sampling (md5 of seed|id)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), col_(c).cast("string")))


def minmax_scale(c, lo: Column, hi: Column) -> Column:
    """(x - min) / (max - min); constant column -> null (division by zero)."""
    return F.try_divide(col_(c) - lo, hi - lo)


#: Exact sums count in these parts of one.
UNITS = 1_000_000


def _units(c) -> Column:
    return F.round(col_(c).cast("double") * F.lit(float(UNITS))).cast("decimal(20,0)")


def exact_sum(c) -> Column:
    """Sum in whole millionths, kept as a decimal: the same for any order and
    partitioning of the rows, as a sum of doubles is not."""
    return F.sum(_units(c)).cast("double") / F.lit(float(UNITS))


def exact_mean(c) -> Column:
    """Mean from the exact sum; null without values."""
    return _mean(F.count(col_(c)), F.sum(_units(c)))


def exact_std(c) -> Column:
    """Sample standard deviation from exact sums of values and squares; null
    for fewer than two values."""
    n, s, q = exact_parts(c)
    return _std(n, s, q)


def exact_parts(c) -> tuple[Column, Column, Column]:
    """Count, exact sum and exact sum of squares of a column's values (in units),
    which can be added up further: see ``mean_of_parts`` and ``std_of_parts``."""
    u = _units(c)
    return F.count(col_(c)), F.sum(u), F.sum((u * u).cast("decimal(38,0)"))


def mean_of_parts(n: str, s: str) -> Column:
    """``exact_mean`` of all values from columns of counts and sums."""
    return _mean(F.sum(n), F.sum(s))


def mean_of_row(n: str, s: str) -> Column:
    """``exact_mean`` from one row's count and sum."""
    return _mean(F.col(n), F.col(s))


def std_of_parts(n: str, s: str, q: str) -> Column:
    """``exact_std`` of all values from columns of counts, sums and squares."""
    return _std(F.sum(n), F.sum(s), F.sum(q))


def _mean(n: Column, s: Column) -> Column:
    return F.try_divide(s.cast("double"), n.cast("double") * F.lit(float(UNITS)))


def _std(n: Column, s: Column, q: Column) -> Column:
    s = s.cast("decimal(38,0)")
    spread = (n.cast("decimal(20,0)") * q).cast("decimal(38,0)") - (s * s).cast("decimal(38,0)")
    return F.when(n > 1, F.sqrt(spread.cast("double") / (n * (n - 1)).cast("double")) / F.lit(float(UNITS)))


def split_sum(x: Column) -> Column:
    """Sum of longs as a decimal(38,0), from the sums of their upper parts and
    lower 31 bits, which are many times faster to add up than decimals."""
    low = F.sum(x.bitwiseAND(F.lit((1 << 31) - 1)))
    return (F.sum(F.shiftright(x, 31)).cast("decimal(38,0)") * F.lit(1 << 31).cast("decimal(11,0)")
            + low.cast("decimal(38,0)")).cast("decimal(38,0)")


def double_text(c) -> Column:
    """A double as text that stands for its very bits (0 and -0 alike), the same
    in any engine: sign, whole part and two runs of 52 binary places."""
    sign = F.when(col_(c) < 0, "-").otherwise("")
    x, places = F.abs(col_(c)), F.lit(float(1 << 52))  # taking off the whole part of |x| is exact
    first = (x - F.floor(x).cast("double")) * places
    second = (first - F.floor(first).cast("double")) * places
    digits = F.concat_ws(":", *[F.floor(p).cast("string") for p in (x, first, second)])
    return F.when(x < F.lit(float(1 << 62)), F.concat(sign, digits)).otherwise(col_(c).cast("string"))
