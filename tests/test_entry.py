"""Every registered query with an oracle against DuckDB on the same files."""
import math
import re
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

import __spark_entry__ as E
from basketry.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    ids = {re.match(r"[a-z]\d+", n)[0] for n in ORACLE}
    wanted = {f"{f}{i}" for f, n in (("s", 9), ("v", 12), ("c", 18), ("e", 9), ("j", 7), ("a", 9), ("f", 16), ("t", 9),
                                     ("k", 6), ("m", 22)) for i in range(1, n + 1)}
    assert wanted <= ids  # each ID of the inventory has an oracle


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 25


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        a, b = float(a), float(b)
        return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return str(a) == str(b)


def ordered(rows):
    key = lambda r: tuple((v is None, f"{v:.5f}" if isinstance(v, float) else str(v)) for v in r)
    return sorted(rows, key=key)


def difference(got, want):
    if len(got) != len(want):
        return f"{len(got)} rows, {len(want)} expected"
    for a, b in zip(ordered(got), ordered(want)):
        if not all(map(close, a, b)):
            return f"{a} expected {b}"
    return None


def test_every_query_matches_its_oracle(spark, duck):
    wrong = {}

    def run(name):
        try:
            df = QUERIES[name](spark, SF)
            cols = sorted(df.columns)
            got = [tuple(r) for r in df.select(*cols).collect()]
            con = duck.cursor()
            names = ", ".join(f'"{c}"' for c in cols)
            want = con.execute(f"SELECT {names} FROM ({ORACLE[name]})").fetchall()
            wrong[name] = difference(got, want)
        except Exception as e:  # noqa: BLE001 - reported with the other differences
            wrong[name] = f"{type(e).__name__}: {str(e)[:500]}"
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(run, ORACLE))
    assert {n: w for n, w in wrong.items() if w} == {}


@pytest.mark.parametrize("name", ["c13_clean_transactions", "v12_dq_report_all", "f13_dense_index",
                                  "k3_snapshot_fingerprint"])
def test_results_do_not_depend_on_partitioning(spark, name):
    name = next(n for n in QUERIES if n.startswith(name))
    first = ordered(map(tuple, QUERIES[name](spark, SF).collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert difference(list(map(tuple, QUERIES[name](spark, SF).collect())), first) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
