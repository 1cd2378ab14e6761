"""Golden figures recorded by the original run, rebuilt with rows of the same
shape: 5,050 transactions, 47 exact duplicates, nulls 30/30/40/264 in
user/product/quantity/rating -> missing pct 0.59/0.59/0.79/5.23, one critical
issue, quality score 82.0; cleaning keeps 5,050 - 47 - 60 = 4,943 rows."""
from basketry.operators import cleaning as C
from basketry.operators import quality as Q

TXN = "transaction_id string, user_id long, product_id long, quantity long, rating double, timestamp string, payment_method string"


def _rows():
    rows = []
    for i in range(5003):
        rows.append([f"T{i:06d}", 1000 + i % 500, 2000 + i % 200, 1 + i % 4, float(1 + i % 5),
                     f"2024-{1 + i % 12:02d}-{1 + i % 28:02d} {i % 24:02d}:00:00", "card"])
    for i in range(0, 30):
        rows[i][1] = None                     # null user
    for i in range(30, 60):
        rows[i][2] = None                     # null product
    for i in range(60, 100):
        rows[i][3] = None                     # null quantity
    for i in range(100, 364):
        rows[i][4] = None                     # null rating
    dups = [list(rows[i]) for i in range(1000, 1047)]   # 47 exact copies of complete rows
    return [tuple(r) for r in rows + dups]


def test_recorded_quality_figures(spark):
    df = spark.createDataFrame(_rows(), TXN)
    mv = {r.column: (r.null_count, r.null_pct, r.severity) for r in Q.missing_values(df, "transactions").collect()}
    assert mv == {"user_id": (30, 0.59, "warning"), "product_id": (30, 0.59, "warning"),
                  "quantity": (40, 0.79, "warning"), "rating": (264, 5.23, "critical")}
    d = Q.duplicates(df, "transactions").first()
    assert (d.total_rows, d.total_duplicates, d.primary_key_duplicates) == (5050, 47, 47)
    rep = Q.report(df, "transactions").first()
    assert rep.overall_quality_score == 82.0 and rep.critical_issues == 1


def test_recorded_cleaning_count(spark):
    df = spark.createDataFrame(_rows(), TXN)
    assert C.clean_transactions(df).count() == 4943
