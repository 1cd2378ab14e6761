"""Data-quality operators.

Per source, one *facts* row holds every scalar that the checks need: row
count, null counts, range violations, minima, maxima and invalid counts from
one aggregate without a key, and both duplicate counts.  Every report (missing
values, ranges, issues, counts, score) is then a projection or an ``inline``
of that one row.

Duplicate rows are found in two stages: 128-bit row keys are counted, and only
rows whose key occurs twice are compared whole.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..sources.shared import materialised
from .quantiles import exact_quantiles

ISSUE_COLUMNS = ["source", "type", "severity", "column", "details"]


def _n(c: str) -> str:
    return f"n__{c}"


def _numeric(c: str) -> Column:
    """pandas ``to_numeric(errors='coerce')``: unparsable -> null."""
    return F.col(c).try_cast("double")


def _str(x: Column) -> Column:
    return x.cast("string")


def rules_for(source: str, df: DataFrame):
    present = set(df.columns)
    required = S.REQUIRED_COLUMNS.get(source, [])
    ranges = {c: r for c, r in S.RANGES.get(source, {}).items() if c in present}
    allowed = {c: v for c, v in S.ALLOWED_VALUES.get(source, {}).items() if c in present}
    missing = [c for c in required if c not in present]
    pk = next((c for c in S.PK_CANDIDATES if c in present), None)
    return required, ranges, allowed, missing, pk


# ---------------------------------------------------------------------------
# Single-pass facts
# ---------------------------------------------------------------------------

def row_keys(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row, nulls told apart from values."""
    nulls = F.array(*[F.col(c).isNull() for c in df.columns])
    return [F.xxhash64(F.lit(i), nulls, *df.columns).alias(f"_k{i}") for i in (1, 2)]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """V3 core: rows repeating an earlier row over all columns (null == null).

    Row keys are counted first, combined map-side: two longs and a count per
    distinct row cross the shuffle.  The keys that occur twice are written;
    rows that have one of them (a broadcast look-up while the planner finds the
    keys small) are then counted whole, so equal keys of unequal rows do no
    harm."""
    twice = materialised(df.select(*row_keys(df)).groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("_c"))
                         .where("_c > 1").select("_k1", "_k2"), "row-keys")
    again = df.select("*", *row_keys(df)).join(twice, ["_k1", "_k2"], "left_semi")
    return (again.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
              .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("total_duplicates")))


def pk_duplicates(df: DataFrame, pk: str | None) -> DataFrame:
    """V4 core: repeats of the key; nulls count as one value."""
    if pk is None:
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("primary_key_duplicates"))
    return (df.groupBy(pk).agg(F.count(F.lit(1)).alias("_c"))
              .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("primary_key_duplicates")))


def facts(df: DataFrame, source: str) -> DataFrame:
    """One row of every scalar the quality checks need.  What needs no key comes
    from one aggregate that sends a row per task; the duplicate counts are
    scalar subqueries over row keys and over the primary key alone."""
    _, ranges, allowed, _, pk = rules_for(source, df)
    rows_where = lambda cond: F.count_if(F.coalesce(cond, F.lit(False))).cast("long")
    facts_ = {"_rows": F.count(F.lit(1))} | {_n(c): rows_where(F.col(c).isNull()) for c in df.columns}
    for c, (lo, hi) in ranges.items():
        x = _numeric(c)
        facts_ |= {f"below__{c}": rows_where(x < F.lit(lo)), f"above__{c}": rows_where(x > F.lit(hi)),
                   f"min__{c}": F.min(x), f"max__{c}": F.max(x)}
    for c, vals in allowed.items():
        facts_[f"invalid__{c}"] = rows_where(F.col(c).isNotNull() & ~F.col(c).isin(*vals))
    return df.agg(*[x.alias(n) for n, x in facts_.items()], F.lit(len(df.columns)).alias("_ncols")).select(
        "*", duplicate_rows(df).scalar().alias("total_duplicates"),
        pk_duplicates(df, pk).scalar().alias("primary_key_duplicates"))


def _pct(num: Column, rows: Column) -> Column:
    # same operation order as the rule: count / rows * 100
    return num.cast("double") / F.greatest(rows, F.lit(1)).cast("double") * F.lit(100.0)


def _missing_pct(c: str) -> Column:
    return F.bround(F.try_divide(F.col(_n(c)).cast("double"), F.col("_rows").cast("double")) * F.lit(100.0), 2)


# ---------------------------------------------------------------------------
# Individual reports
# ---------------------------------------------------------------------------

def required_columns(df: DataFrame, source: str) -> DataFrame:
    """V1: required columns absent from the table (schema check)."""
    required, _, _, missing, _ = rules_for(source, df)
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        F.lit(source).alias("source"), F.lit(len(required)).alias("n_required"),
        F.lit(len(missing)).alias("n_missing"), F.lit(",".join(missing)).alias("missing_columns"),
        "total_rows")


def missing_values(df: DataFrame, source: str, fx: DataFrame | None = None) -> DataFrame:
    """V2: per column with nulls: count, pct (2 dp, half-even) and severity."""
    fx = fx if fx is not None else facts(df, source)
    recs = [F.struct(F.lit(c).alias("column"), F.col(_n(c)).cast("long").alias("null_count"),
                     _missing_pct(c).alias("null_pct")) for c in df.columns]
    return (fx.select(F.inline(F.array(*recs)))
              .where(F.col("null_count") > 0)
              .select(F.lit(source).alias("source"), "column", "null_count", "null_pct",
                      F.when(F.col("null_pct") < S.MISSING_CRITICAL_PCT, "warning")
                       .otherwise("critical").alias("severity")))


def duplicates(df: DataFrame, source: str, fx: DataFrame | None = None) -> DataFrame:
    """V3 + V4: duplicate rows and primary-key repeats."""
    fx = fx if fx is not None else facts(df, source)
    pk = rules_for(source, df)[4]
    return fx.select(F.lit(source).alias("source"), F.col("_rows").alias("total_rows"),
                     "total_duplicates", F.lit(pk).cast("string").alias("pk_column"),
                     "primary_key_duplicates")


def ranges(df: DataFrame, source: str, fx: DataFrame | None = None) -> DataFrame:
    """V5: below/above counts and actual min/max per ranged column."""
    _, rng, _, _, _ = rules_for(source, df)
    schema = ("source string, column string, min_expected double, max_expected double, actual_min double,"
              " actual_max double, below_range long, above_range long")
    if not rng:
        return df.sparkSession.createDataFrame([], schema)
    fx = fx if fx is not None else facts(df, source)
    recs = [F.struct(F.lit(c).alias("column"), F.lit(float(lo)).alias("min_expected"),
                     F.lit(float(hi)).alias("max_expected"), F.col(f"min__{c}").alias("actual_min"),
                     F.col(f"max__{c}").alias("actual_max"),
                     F.col(f"below__{c}").cast("long").alias("below_range"),
                     F.col(f"above__{c}").cast("long").alias("above_range"))
            for c, (lo, hi) in rng.items()]
    return fx.select(F.lit(source).alias("source"), F.inline(F.array(*recs)))


def allowed_values(df: DataFrame, source: str, samples: int = 5) -> DataFrame:
    """V6: non-null values outside the allowed list: count and the first
    ``samples`` distinct offending values in sorted order.

    Samples come from distinct values -> ordered limit (a bounded top-k per
    partition merged on one task), never from collecting all offenders.
    """
    _, _, allowed, _, _ = rules_for(source, df)
    schema = "source string, column string, invalid_count long, invalid_samples string"
    if not allowed:
        return df.sparkSession.createDataFrame([], schema)
    parts = []
    for c, vals in allowed.items():
        bad = df.where(F.col(c).isNotNull() & ~F.col(c).isin(*vals))
        cnt = bad.select(F.count(F.lit(1))).scalar()
        smp = (bad.select(F.col(c).cast("string").alias("v")).distinct().orderBy("v").limit(samples)
                  .agg(F.array_join(F.array_sort(F.collect_list("v")), ",").alias("s")).select("s").scalar())
        parts.append(df.sparkSession.range(1).select(
            F.lit(source).alias("source"), F.lit(c).alias("column"), cnt.cast("long").alias("invalid_count"),
            F.coalesce(smp, F.lit("")).alias("invalid_samples")))
    return reduce(DataFrame.unionByName, parts)


def shape_and_types(df: DataFrame, source: str) -> DataFrame:
    """V7: rows, columns and column -> type."""
    types = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        F.lit(source).alias("source"), "total_rows", F.lit(len(df.columns)).alias("total_columns"),
        F.lit(types).alias("column_types"))


def numeric_summary(df: DataFrame, source: str) -> DataFrame:
    """V8: count, mean, sample std, min, exact quartiles (linear interpolation)
    and max of every numeric non-boolean column; null statistics for a column
    without values."""
    cols = S.numeric_columns(df.schema)
    schema = ("source string, column string, count long, mean double, std double, min double, p25 double,"
              " p50 double, p75 double, max double")
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")).alias(f"s__{c}"))
    rows = df.agg(*aggs).select(F.inline(F.array(*[F.col(f"s__{c}") for c in cols])))
    at = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("column").agg(
        *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n) for n, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))])
    return rows.join(at, "column", "left").select(F.lit(source).alias("source"), "column", "count", "mean", "std", "min",
                                                  "p25", "p50", "p75", "max")


# ---------------------------------------------------------------------------
# Issues, counts, score
# ---------------------------------------------------------------------------

def _issue_structs(df: DataFrame, source: str) -> list[Column]:
    """One ``when(condition, struct)`` per possible issue, over the facts row."""
    _, rng, allowed, missing, _ = rules_for(source, df)
    none = F.lit(None).cast("string")
    recs = []

    def rec(cond, typ, sev, column, details):
        recs.append(F.when(cond, F.struct(F.lit(typ).alias("type"), sev.alias("severity"),
                                          column.alias("column"), details.alias("details"))))

    if missing:
        listed = "[" + ", ".join(f"'{c}'" for c in missing) + "]"
        rec(F.lit(True), "schema_mismatch", F.lit("critical"), none,
            F.lit(S.ISSUE_SCHEMA.format(cols=listed)))
    for c in df.columns:
        pct = _missing_pct(c)
        rec(F.col(_n(c)) > 0, "missing_values",
            F.when(pct < S.MISSING_CRITICAL_PCT, "warning").otherwise("critical"), F.lit(c),
            F.concat(_str(F.col(_n(c))), F.lit(" missing ("), _str(pct), F.lit("%)")))
    rec(F.col("total_duplicates") > 0, "duplicates", F.lit("warning"), none,
        F.concat(_str(F.col("total_duplicates")), F.lit(" duplicate rows found")))
    for c in rng:
        b, a = F.col(f"below__{c}"), F.col(f"above__{c}")
        rec((b > 0) | (a > 0), "range_violation", F.lit("warning"), F.lit(c),
            F.concat(_str(b), F.lit(" below min, "), _str(a), F.lit(" above max")))
    for c in allowed:
        n = F.col(f"invalid__{c}")
        rec(n > 0, "invalid_values", F.lit("warning"), F.lit(c),
            F.concat(_str(n), F.lit(" rows with invalid values")))
    return recs


def issues(df: DataFrame, source: str, fx: DataFrame | None = None) -> DataFrame:
    """V9: flat issue list (source, type, severity, column, details)."""
    fx = fx if fx is not None else facts(df, source)
    recs = _issue_structs(df, source)
    return (fx.select(F.explode(F.array(*recs)).alias("i")).where(F.col("i").isNotNull())
              .select(F.lit(source).alias("source"), "i.type", "i.severity", "i.column", "i.details"))


def _score_columns(df: DataFrame, source: str) -> list[Column]:
    _, rng, _, missing, _ = rules_for(source, df)
    rows = F.col("_rows")
    reported = [F.when(F.col(_n(c)) > 0, _missing_pct(c)).otherwise(F.lit(0.0)) for c in df.columns]
    critical = F.lit(1 if missing else 0) + sum(
        (F.when((F.col(_n(c)) > 0) & (_missing_pct(c) >= S.MISSING_CRITICAL_PCT), 1).otherwise(0)
         for c in df.columns), F.lit(0))
    warning = (sum((F.when((F.col(_n(c)) > 0) & (_missing_pct(c) < S.MISSING_CRITICAL_PCT), 1).otherwise(0)
                    for c in df.columns), F.lit(0))
               + F.when(F.col("total_duplicates") > 0, 1).otherwise(0)
               + sum((F.when((F.col(f"below__{c}") + F.col(f"above__{c}")) > 0, 1).otherwise(0) for c in rng),
                     F.lit(0))
               + sum((F.when(F.col(f"invalid__{c}") > 0, 1).otherwise(0)
                      for c in S.ALLOWED_VALUES.get(source, {}) if c in df.columns), F.lit(0)))
    avg_missing = sum(reported, F.lit(0.0)) / F.greatest(F.col("_ncols"), F.lit(1)).cast("double")
    score = F.lit(100.0) - F.least(avg_missing * F.lit(float(S.SCORE_MISSING_WEIGHT)),
                                   F.lit(float(S.SCORE_MISSING_CAP)))
    score = score - F.least(_pct(F.col("total_duplicates"), rows), F.lit(float(S.SCORE_DUP_CAP)))
    for c in rng:
        score = score - F.least(_pct(F.col(f"below__{c}") + F.col(f"above__{c}"), rows),
                                F.lit(float(S.SCORE_RANGE_CAP)))
    score = score - critical.cast("double") * F.lit(float(S.SCORE_CRITICAL_PENALTY))
    return [
        F.lit(source).alias("source"),
        (critical + warning).cast("long").alias("total_issues"),
        critical.cast("long").alias("critical_issues"),
        warning.cast("long").alias("warning_issues"),
        F.bround(F.greatest(score, F.lit(0.0)), 1).alias("overall_quality_score")]


def _counts_and_score(df: DataFrame, source: str, fx: DataFrame) -> DataFrame:
    return fx.select(*_score_columns(df, source))


def issue_counts(df: DataFrame, source: str, fx: DataFrame | None = None) -> DataFrame:
    """Issue totals by severity."""
    fx = fx if fx is not None else facts(df, source)
    return _counts_and_score(df, source, fx).drop("overall_quality_score")


def quality_score(df: DataFrame, source: str, fx: DataFrame | None = None) -> DataFrame:
    """0–100 quality score."""
    fx = fx if fx is not None else facts(df, source)
    return _counts_and_score(df, source, fx).select("source", "overall_quality_score")


def report(df: DataFrame, source: str) -> DataFrame:
    """One source's summary row (V10 + V11)."""
    return _counts_and_score(df, source, facts(df, source))


def report_with_issues(df: DataFrame, source: str) -> DataFrame:
    """V12 row of one source plus its V9 issues as an array, from a single
    facts computation (write once, then split)."""
    fx = facts(df, source)
    return fx.select(*_score_columns(df, source),
                     F.filter(F.array(*_issue_structs(df, source)), lambda x: x.isNotNull()).alias("issues"))


def report_all(sources: dict[str, DataFrame]) -> DataFrame:
    """Summary row for every source."""
    return reduce(DataFrame.unionByName, [report(df, s) for s, df in sources.items()])


def issues_all(sources: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [issues(df, s) for s, df in sources.items()])


def for_all(fn, sources: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [fn(df, s) for s, df in sources.items()])
