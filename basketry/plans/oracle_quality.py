"""DuckDB SQL for the data-quality reports, generated from the same rule set."""
from __future__ import annotations

from .. import schemas as S
from . import oracle as O


def _cols(source: str) -> list[str]:
    return [f.name for f in S.SOURCE_SCHEMAS[source].fields]


def _rules(source: str):
    cols = set(_cols(source))
    rng = {c: r for c, r in S.RANGES.get(source, {}).items() if c in cols}
    allowed = {c: v for c, v in S.ALLOWED_VALUES.get(source, {}).items() if c in cols}
    missing = [c for c in S.REQUIRED_COLUMNS.get(source, []) if c not in cols]
    pk = next((c for c in S.PK_CANDIDATES if c in cols), None)
    return rng, allowed, missing, pk


def _d(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def _lst(vals) -> str:
    return ", ".join("'" + v + "'" for v in vals)


def _missing_pct(c: str) -> str:
    return f"round_even({_d('n__' + c)} / {_d('_rows')} * {_d(100.0)}, 2)"


def facts_cte(source: str) -> str:
    name = f"_fx_{source}"
    if name in O._CTES:
        return name
    cols = _cols(source)
    rng, allowed, _, pk = _rules(source)
    aggs = ["count(*) AS _rows"] + [f"count_if({c} IS NULL) AS n__{c}" for c in cols]
    for c, (lo, hi) in rng.items():
        x = f"TRY_CAST({c} AS DOUBLE)"
        aggs += [f"count_if({x} < {lo}) AS below__{c}", f"count_if({x} > {hi}) AS above__{c}",
                 f"min({x}) AS min__{c}", f"max({x}) AS max__{c}"]
    for c, vals in allowed.items():
        aggs.append(f"count_if({c} IS NOT NULL AND {c} NOT IN ({_lst(vals)})) AS invalid__{c}")
    allc = ", ".join(cols)
    dup = (f"(SELECT CAST(COALESCE(sum(_c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS _c FROM {source}"
           f" GROUP BY {allc}))")
    pkd = (f"(SELECT CAST(COALESCE(sum(_c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS _c FROM {source}"
           f" GROUP BY {pk}))") if pk else "CAST(0 AS BIGINT)"
    body = (f"SELECT {', '.join(aggs)}, {len(cols)} AS _ncols, {dup} AS total_duplicates,"
            f" {pkd} AS primary_key_duplicates FROM {source}")
    O.cte(name, body, source)
    return name


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _all_sources(fn) -> str:
    parts, deps = [], []
    for s in S.SOURCES:
        p, d = fn(s)
        if p:
            parts.append(p)
            deps += d
    return O.sql(_union(parts), *deps)


def v1() -> str:
    def one(s):
        _, _, missing, _ = _rules(s)
        req = S.REQUIRED_COLUMNS.get(s, [])
        return (f"SELECT '{s}' AS source, {len(req)} AS n_required, {len(missing)} AS n_missing,"
                f" '{','.join(missing)}' AS missing_columns, count(*) AS total_rows FROM {s}", [s])
    return _all_sources(one)


def v2() -> str:
    def one(s):
        fx = facts_cte(s)
        parts = [f"SELECT '{s}' AS source, '{c}' AS \"column\", CAST(n__{c} AS BIGINT) AS null_count,"
                 f" {_missing_pct(c)} AS null_pct,"
                 f" CASE WHEN {_missing_pct(c)} < {S.MISSING_CRITICAL_PCT} THEN 'warning' ELSE 'critical' END"
                 f" AS severity FROM {fx} WHERE n__{c} > 0" for c in _cols(s)]
        return _union(parts), [fx]
    return _all_sources(one)


def v3v4() -> str:
    def one(s):
        fx = facts_cte(s)
        pk = _rules(s)[3]
        pkl = f"'{pk}'" if pk else "CAST(NULL AS VARCHAR)"
        return (f"SELECT '{s}' AS source, _rows AS total_rows, total_duplicates, {pkl} AS pk_column,"
                f" primary_key_duplicates FROM {fx}", [fx])
    return _all_sources(one)


def v5() -> str:
    def one(s):
        rng = _rules(s)[0]
        if not rng:
            return None, []
        fx = facts_cte(s)
        parts = [f"SELECT '{s}' AS source, '{c}' AS \"column\", {_d(float(lo))} AS min_expected,"
                 f" {_d(float(hi))} AS max_expected, min__{c} AS actual_min, max__{c} AS actual_max,"
                 f" CAST(below__{c} AS BIGINT) AS below_range, CAST(above__{c} AS BIGINT) AS above_range"
                 f" FROM {fx}" for c, (lo, hi) in rng.items()]
        return _union(parts), [fx]
    return _all_sources(one)


def v6() -> str:
    def one(s):
        allowed = _rules(s)[1]
        if not allowed:
            return None, []
        parts = []
        for c, vals in allowed.items():
            cond = f"{c} IS NOT NULL AND {c} NOT IN ({_lst(vals)})"
            smp = (f"(SELECT COALESCE(string_agg(v, ',' ORDER BY v), '') FROM (SELECT DISTINCT CAST({c} AS VARCHAR)"
                   f" AS v FROM {s} WHERE {cond} ORDER BY v LIMIT 5))")
            parts.append(f"SELECT '{s}' AS source, '{c}' AS \"column\", CAST(count_if({cond}) AS BIGINT)"
                         f" AS invalid_count, {smp} AS invalid_samples FROM {s}")
        return _union(parts), [s]
    return _all_sources(one)


def v7() -> str:
    def one(s):
        types = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in S.SOURCE_SCHEMAS[s].fields)
        return (f"SELECT '{s}' AS source, count(*) AS total_rows, {len(_cols(s))} AS total_columns,"
                f" '{types}' AS column_types FROM {s}", [s])
    return _all_sources(one)


def v8() -> str:
    def one(s):
        cols = [c for c in S.numeric_columns(S.SOURCE_SCHEMAS[s])]
        if not cols:
            return None, []
        parts = [f"SELECT '{s}' AS source, '{c}' AS \"column\", count({c}) AS count, avg({_d(c)}) AS mean,"
                 f" stddev_samp({_d(c)}) AS std, min({_d(c)}) AS min,"
                 f" quantile_cont({_d(c)}, 0.25) AS p25, quantile_cont({_d(c)}, 0.5) AS p50,"
                 f" quantile_cont({_d(c)}, 0.75) AS p75, max({_d(c)}) AS max FROM {s}" for c in cols]
        return _union(parts), [s]
    return _all_sources(one)


def _issue_parts(s: str) -> tuple[list[str], str]:
    fx = facts_cte(s)
    rng, allowed, missing, _ = _rules(s)
    parts = []
    sel = f"SELECT '{s}' AS source, "
    if missing:
        listed = "[" + ", ".join(f"''{c}''" for c in missing) + "]"
        parts.append(sel + f"'schema_mismatch' AS type, 'critical' AS severity, CAST(NULL AS VARCHAR) AS \"column\","
                     f" 'Missing columns: {listed}' AS details FROM {fx}")
    for c in _cols(s):
        pct = _missing_pct(c)
        parts.append(sel + f"'missing_values' AS type, CASE WHEN {pct} < {S.MISSING_CRITICAL_PCT} THEN 'warning'"
                     f" ELSE 'critical' END AS severity, '{c}' AS \"column\","
                     f" CAST(n__{c} AS VARCHAR) || ' missing (' || CAST({pct} AS VARCHAR) || '%)' AS details"
                     f" FROM {fx} WHERE n__{c} > 0")
    parts.append(sel + "'duplicates' AS type, 'warning' AS severity, CAST(NULL AS VARCHAR) AS \"column\","
                 f" CAST(total_duplicates AS VARCHAR) || ' duplicate rows found' AS details FROM {fx}"
                 " WHERE total_duplicates > 0")
    for c in rng:
        parts.append(sel + f"'range_violation' AS type, 'warning' AS severity, '{c}' AS \"column\","
                     f" CAST(below__{c} AS VARCHAR) || ' below min, ' || CAST(above__{c} AS VARCHAR) || ' above max'"
                     f" AS details FROM {fx} WHERE below__{c} > 0 OR above__{c} > 0")
    for c in allowed:
        parts.append(sel + f"'invalid_values' AS type, 'warning' AS severity, '{c}' AS \"column\","
                     f" CAST(invalid__{c} AS VARCHAR) || ' rows with invalid values' AS details FROM {fx}"
                     f" WHERE invalid__{c} > 0")
    return parts, fx


def v9() -> str:
    def one(s):
        parts, fx = _issue_parts(s)
        return _union(parts), [fx]
    return _all_sources(one)


def _score_select(s: str, with_score: bool = True, with_counts: bool = True) -> tuple[str, list[str]]:
    fx = facts_cte(s)
    rng, allowed, missing, _ = _rules(s)
    cols = _cols(s)
    crit = [f"CASE WHEN n__{c} > 0 AND {_missing_pct(c)} >= {S.MISSING_CRITICAL_PCT} THEN 1 ELSE 0 END" for c in cols]
    warn = [f"CASE WHEN n__{c} > 0 AND {_missing_pct(c)} < {S.MISSING_CRITICAL_PCT} THEN 1 ELSE 0 END" for c in cols]
    warn.append("CASE WHEN total_duplicates > 0 THEN 1 ELSE 0 END")
    warn += [f"CASE WHEN below__{c} + above__{c} > 0 THEN 1 ELSE 0 END" for c in rng]
    warn += [f"CASE WHEN invalid__{c} > 0 THEN 1 ELSE 0 END" for c in allowed]
    critical = f"({1 if missing else 0} + " + " + ".join(crit) + ")"
    warning = "(0 + " + " + ".join(warn) + ")"
    reported = " + ".join(f"CASE WHEN n__{c} > 0 THEN {_missing_pct(c)} ELSE {_d(0.0)} END" for c in cols)
    avg_missing = f"({_d(0.0)} + {reported}) / {_d('greatest(_ncols, 1)')}"

    def pct(x):
        return f"{_d(x)} / {_d('greatest(_rows, 1)')} * {_d(100.0)}"

    score = (f"{_d(100.0)} - least({avg_missing} * {_d(float(S.SCORE_MISSING_WEIGHT))},"
             f" {_d(float(S.SCORE_MISSING_CAP))})")
    score = f"({score}) - least({pct('total_duplicates')}, {_d(float(S.SCORE_DUP_CAP))})"
    for c in rng:
        score = f"({score}) - least({pct(f'below__{c} + above__{c}')}, {_d(float(S.SCORE_RANGE_CAP))})"
    score = f"({score}) - {_d(critical)} * {_d(float(S.SCORE_CRITICAL_PENALTY))}"
    sel = [f"'{s}' AS source"]
    if with_counts:
        sel += [f"CAST({critical} + {warning} AS BIGINT) AS total_issues",
                f"CAST({critical} AS BIGINT) AS critical_issues", f"CAST({warning} AS BIGINT) AS warning_issues"]
    if with_score:
        sel.append(f"round_even(greatest({score}, {_d(0.0)}), 1) AS overall_quality_score")
    return f"SELECT {', '.join(sel)} FROM {fx}", [fx]


def v10() -> str:
    return _all_sources(lambda s: _score_select(s, with_score=False))


def v11() -> str:
    return _all_sources(lambda s: _score_select(s, with_counts=False))


def v12() -> str:
    return _all_sources(lambda s: _score_select(s))
