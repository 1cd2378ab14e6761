import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import linalg, metrics as M, recommend as R
from basketry.operators import scoring
from basketry.operators.scoring import top_n_dot


def _pairs(spark, n_users=12, n_items=9, density=0.5, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(n_users):
        for i in range(n_items):
            if rng.random() < density:
                rows.append((u, 100 + i, float(rng.integers(1, 6)) if rng.random() < 0.8 else 0.0))
    return spark.createDataFrame(rows, "user_id long, product_id long, avg_rating double"), rows


def _dense(rows):
    us = sorted({r[0] for r in rows}); it = sorted({r[1] for r in rows})
    a = np.zeros((len(us), len(it)))
    for u, i, v in rows:
        a[us.index(u), it.index(i)] = v
    return a, us, it


@pytest.mark.parametrize("block, tile", [(None, 4096), (3, 4), (2, 5)])
def test_svd_matches_numpy(spark, block, tile):
    """Block sizes below the space and several tiles per side included."""
    df, rows = _pairs(spark, 30, 24, seed=4)
    a, us, it = _dense(rows)
    mean = a[a > 0].mean()
    c = a.copy(); c[a > 0] -= mean
    k = 6 if block else 23
    u, s, vt = np.linalg.svd(c, full_matrices=False)
    ref = np.clip(mean + (u[:, :k] * s[:k]) @ vt[:k], 1, 5)
    model = R.svd_fit(df, n_factors=k, block=block, tile=tile, tol=1e-9)
    assert np.allclose(model.sigma, s[:k], rtol=1e-8)
    allp = spark.createDataFrame([(x, y) for x in us for y in it], "user_id long, product_id long")
    pred = {(r.user_id, r.product_id): r.prediction for r in R.predict_pairs(model, allp).collect()}
    got = np.array([[pred[(x, y)] for y in it] for x in us])
    assert np.allclose(got, ref, atol=1e-6)


def test_svd_meets_its_tolerance_and_restarts(spark, monkeypatch):
    df, rows = _pairs(spark, 60, 50, seed=9)
    a, us, it = _dense(rows)
    cells = df.withColumnRenamed("avg_rating", "value")
    uf, vf, sigma = linalg.truncated_svd(cells, "user_id", "product_id", 4, block=5, tol=1e-4, tile=16, max_blocks=3)
    v = np.array([r.vec for r in vf.orderBy("product_id").collect()])
    u = np.array([r.vec for r in uf.orderBy("user_id").collect()])
    assert np.allclose(np.linalg.norm(v, axis=0), 1) and np.allclose(u, a @ v)
    assert (np.linalg.norm(a.T @ u - v * sigma ** 2, axis=0) <= 1.01e-4 * sigma ** 2).all()
    assert np.allclose(sigma, np.linalg.svd(a)[1][:4], rtol=1e-6)


def test_svd_of_low_rank_and_degenerate_matrices(spark):
    x, y = np.arange(1, 9.0), np.arange(1, 7.0)
    cells = spark.createDataFrame([(i, j, float(x[i] * y[j])) for i in range(8) for j in range(6)],
                                  "user_id long, product_id long, value double")
    uf, vf, sigma = linalg.truncated_svd(cells, "user_id", "product_id", 4)
    assert np.allclose(sigma, [np.linalg.norm(x) * np.linalg.norm(y)]) and vf.count() == 6 and uf.count() == 8
    with pytest.raises(ValueError):
        linalg.truncated_svd(cells.where("value < 0"), "user_id", "product_id", 2)


def test_predict_unknown_is_mean(spark):
    df, rows = _pairs(spark)
    model = R.svd_fit(df)
    p = R.predict_pairs(model, spark.createDataFrame([(999, 100), (0, 999)], "user_id long, product_id long")).collect()
    assert all(abs(r.prediction - model.global_mean) < 1e-12 for r in p)


def test_top_n_tie_break_by_id(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "qid long, vec array<double>")
    items = spark.createDataFrame([(5, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.5, 0.0]), (9, [2.0, 0.0])],
                                  "item long, vec array<double>")
    out = [(r.item, r.rank) for r in top_n_dot(q, items, 3).orderBy("rank").collect()]
    assert out == [(9, 1), (3, 2), (5, 3)]


def test_top_n_in_several_blocks_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    q, v = rng.integers(-3, 4, (40, 3)), rng.integers(-3, 4, (60, 3))  # many ties
    pairs = {(int(a), int(b)) for a, b in zip(rng.integers(0, 40, 300), rng.integers(0, 60, 300))}
    queries = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(q)], "qid long, vec array<double>")
    items = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "item long, vec array<double>")
    seen = spark.createDataFrame(sorted(pairs) + [(99, 1), (1, 99)], "qid long, item long")
    for opts, score in (({}, lambda i, j: float(q[i] @ v[j])),
                        ({"exclude_self": True}, lambda i, j: None if i == j else float(q[i] @ v[j])),
                        ({"mean": 3.0}, lambda i, j: float(np.clip(3.0 + q[i] @ v[j], 1, 5))),
                        ({"seen": seen}, lambda i, j: -1.0 if (i, j) in pairs else float(q[i] @ v[j])),
                        ({"seen": seen, "drop_seen": True}, lambda i, j: None if (i, j) in pairs else float(q[i] @ v[j]))):
        want = []
        for i in range(40):
            ranked = sorted((-s, j) for j in range(60) if (s := score(i, j)) is not None)[:7]
            want += [(i, j, -s, r + 1) for r, (s, j) in enumerate(ranked)]
        for blocks in ({}, {"item_block": 9, "query_block": 7}):
            got = sorted(map(tuple, top_n_dot(queries, items, 7, **opts, **blocks).collect()), key=lambda r: (r[0], r[3]))
            assert got == want


def test_content_scores_equal_explicit_pair_sum(spark):
    rng = np.random.default_rng(3)
    vecs = {100 + i: rng.random(4) for i in range(8)}
    vecs[107] = np.zeros(4)
    unit = R.unit_vectors(spark.createDataFrame([(k, v.tolist()) for k, v in vecs.items()],
                                                "product_id long, vec array<double>"))
    hist = spark.createDataFrame([(1, 100), (1, 101), (2, 107)], "user_id long, product_id long")
    recs = {(r.user_id, r.product_id): r.score for r in R.recommend_cb(hist, unit, n=8, dim=4).collect()}

    def cos(a, b):
        na, nb = np.linalg.norm(a), np.linalg.norm(b)
        return 0.0 if na == 0 or nb == 0 else float(a @ b / (na * nb))
    for j in vecs:
        want = -1.0 if j in (100, 101) else cos(vecs[100], vecs[j]) + cos(vecs[101], vecs[j])
        assert abs(recs[(1, j)] - want) < 1e-12
    assert all(abs(recs[(2, j)] - (-1.0 if j == 107 else 0.0)) < 1e-12 for j in vecs)


def test_similar_items_excludes_self(spark):
    unit = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], "product_id long, vec array<double>")
    out = R.similar_items(unit, n=2).collect()
    assert all(r.product_id != r.similar_product_id for r in out)
    assert {(r.product_id, r.rank): r.similar_product_id for r in out}[(1, 1)] == 2


def test_metrics_hand_computed(spark):
    recs = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (1, 3, 12)], "user_id long, rank int, product_id long")
    actual = spark.createDataFrame([(1, 11), (1, 13)], "user_id long, product_id long")
    users = spark.createDataFrame([(1,)], "user_id long")
    r = M.per_user_metrics(recs, actual, users, k=10).first()
    assert r.precision_at_k == 0.1 and r.recall_at_k == 0.5
    assert abs(r.ndcg_at_k - (1 / np.log2(3)) / (1 + 1 / np.log2(3))) < 1e-12


def test_split_disjoint_complete_and_partition_independent(spark):
    df, _ = _pairs(spark, 30, 20)
    tr, te = R.split_train_test(df)
    a = {(r.user_id, r.product_id) for r in tr.collect()}
    b = {(r.user_id, r.product_id) for r in te.collect()}
    assert not (a & b) and len(a | b) == df.count()
    tr2, _ = R.split_train_test(df.repartition(7))
    assert {(r.user_id, r.product_id) for r in tr2.collect()} == a


def test_block_products_sums_and_inner_products(spark):
    rng = np.random.default_rng(5)
    a = rng.random((20, 13)) * (rng.random((20, 13)) < 0.4)
    a[0] = rng.random(13)  # a hot row
    cells = spark.createDataFrame([(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))],
                                  "u long, p long, value double")
    rows, cols = linalg.key_blocks(cells, "u", 6), linalg.key_blocks(cells, "p", 4)
    tiled = linalg.tiles(cells, rows, cols, "u", "p", most=8)
    assert max(len(r.v) for r in tiled.collect()) <= 16
    z = linalg.start_block(cols, 3, 1)
    both = linalg.Tiled(tiled)
    table = lambda df, blocks, key, w: np.array([r.vec for r in linalg.to_vectors(df, blocks, key, w).orderBy(key).collect()])
    zm = table(z, cols, "p", 3)
    used = sorted({int(i) for i in np.nonzero(a)[0]})
    y = both.product(z, 3)
    assert np.allclose(table(y, rows, "u", 3), (a @ zm)[used])
    assert np.allclose(table(both.product(y, 3, transpose=True), cols, "p", 3), a.T @ a @ zm)
    t, m = rng.random((3, 2)), rng.random((5, 3))
    panels = [linalg.Panel(z, t), linalg.Panel(z, np.eye(3))]
    q = np.hstack([zm @ t, zm])
    assert np.allclose(table(both.product(z, 2, t=t), rows, "u", 2), (a @ zm @ t)[used])
    assert np.allclose(linalg.inner_products(z, 3, panels), np.vstack([q.T @ zm, zm.T @ zm]))
    assert np.allclose(table(linalg.combine(z, 3, panels, m), cols, "p", 3), zm + q @ m)
    assert np.allclose(table(linalg.combine(None, 0, panels, m), cols, "p", 3), q @ m)
    both.release()


def test_pass_multiplies_and_projects_in_two_writes(spark, monkeypatch):
    """A pass writes A q and the next panel with their inner products; no other
    table, and no job for inner products, while the basis is orthogonal."""
    df, rows = _pairs(spark, 60, 50, seed=9)
    a, us, it = _dense(rows)
    cells = df.withColumnRenamed("avg_rating", "value")
    calls, inner, wrote = [], linalg.inner_products, linalg._Folder.with_gram
    monkeypatch.setattr(linalg, "inner_products", lambda *x: calls.append("inner") or inner(*x))
    monkeypatch.setattr(linalg._Folder, "with_gram", lambda self, name, *x: calls.append(name) or wrote(self, name, *x))
    uf, vf, sigma = linalg.truncated_svd(cells, "user_id", "product_id", 3, block=6, tol=1e-2, tile=16)
    assert calls[0] == "inner" and calls[1:] == [f"{x}-{n + (x == 'panel')}" for n in range(len(calls) // 2) for x in ("product", "panel")]
    assert len(calls) > 5 and np.allclose(sigma, np.linalg.svd(a)[1][:3], rtol=1e-2)


def test_cells_of_a_tile_are_all_added():
    rng = np.random.default_rng(3)
    for n, hot in ((0, 0), (700, 0), (3000, 2000)):  # none, short rows, and a row of 2000 cells
        to = np.r_[rng.integers(0, 500, n - hot if n else 0), np.full(hot, 7)].astype(np.int32)
        frm, v, x = rng.integers(0, 400, len(to)), rng.random(len(to)), rng.random((400, 5))
        out, want = np.ones((500, 5)), np.ones((500, 5))
        linalg._add_cells(out, x, to, frm, v)
        np.add.at(want, to, v[:, None] * x[frm])
        assert np.allclose(out, want)


def test_residuals_are_looked_at_when_they_can_be_small():
    look = lambda *x: np.array(x, float)
    assert linalg._wait(np.zeros(0), look(1, 0.5, 0.1), 1e-3) == 1
    assert linalg._wait(look(4, 0.2, 0.1), look(5, 0.15, 0.08), 1e-3) == linalg.SKIP
    assert linalg._wait(look(20, 4e-3, 1e-4), look(21, 2e-3, 8e-5), 1e-3) == 1
    assert linalg._wait(look(4, 0.2, 1e-3), look(5, 0.15, 1e-5), 1e-3) == 1  # a pair that converges fast


def test_product_sends_a_dense_block_once_to_each_group(spark):
    assert linalg.grid(59, 44, 24) == (4, 6)  # 4 × 59 and 6 × 44 blocks move, not 59 × 44 of both
    assert all(linalg.grid(i, o, 24)[0] >= o / linalg.GROUP for i in (1, 7, 900) for o in (1, 50, 2000))  # a task holds its group
    cells = spark.range(400).selectExpr("id % 20 AS u", "id DIV 20 AS p", "1.0D + id AS value")
    rows, cols = linalg.key_blocks(cells, "u", 1), linalg.key_blocks(cells, "p", 1)
    tiled = linalg.Tiled(linalg.tiles(cells, rows, cols, "u", "p"))
    met = tiled.meetings(linalg.start_block(cols, 2, 1)).select("inner", "outer", F.spark_partition_id().alias("task")).collect()
    tiled.release()
    dense, sparse = [r for r in met if r.outer is None], [r for r in met if r.outer is not None]
    groups, shares = tiled.grids[False]
    assert len(dense) == groups * len({r.inner for r in met}) < len(sparse) / 2 and len({r.task for r in met}) == groups * shares
    assert {(r.task, r.inner) for r in sparse} <= {(r.task, r.inner) for r in dense}  # every tile meets its dense block
    per_task = [len({r.outer for r in sparse if r.task == t}) for t in {r.task for r in met}]
    assert max(per_task) <= -(-len({r.outer for r in sparse}) // groups) + 3


def test_deviation_queries_write_the_split_pairs_once(spark, monkeypatch):
    from basketry.plans import catalog
    plain, wrote = catalog.materialised, []
    monkeypatch.setattr(catalog, "materialised", lambda df, name: wrote.append(df.columns) or plain(df, name))
    sf = "/root/testdata/sf0.001"
    _, train, test = catalog._deviation_model(spark, sf)
    assert wrote == [["user_id", "product_id", "avg_rating", "is_test"]]
    pairs = catalog.Tables(spark, sf).interactions
    for got, want in zip((train, test), R.split_train_test(pairs)):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect())) != []


def test_evaluation_reads_the_test_pairs_of_its_users_once(spark, monkeypatch):
    df, rows = _pairs(spark, 30, 20)
    train, test = R.split_train_test(df)
    model, plain, wrote = R.mean_deviation_model(train), M.materialised, {}
    monkeypatch.setattr(M, "materialised", lambda df, name: wrote.setdefault(name, plain(df, name)))
    out = M.evaluate_cf(model, test, n=5).first()
    users = {r.user_id for r in wrote["test-users"].collect()}
    mine = {(r.user_id, r.product_id): r.avg_rating for r in test.collect() if r.user_id in users}
    assert len(users) == 5 and {(r[0], r[1]) for r in wrote["test-pairs"].collect()} == set(mine)
    off = [(r.prediction - mine[r.user_id, r.product_id]) ** 2 for r in wrote["test-predictions"].collect()]
    assert len(off) == len(mine) and abs(out.rmse - np.mean(off) ** 0.5) < 1e-4


def test_interrupted_fit_goes_on_after_its_last_pass(spark, tmp_dir, monkeypatch):
    df, rows = _pairs(spark, 60, 50, seed=9)
    cells = df.withColumnRenamed("avg_rating", "value")
    fit = lambda folder: linalg.truncated_svd(cells, "user_id", "product_id", 4, block=5, tol=1e-6, tile=16, folder=folder)
    whole = fit(os.path.join(tmp_dir, "whole"))
    plain, seen = linalg._Folder.commit, []

    def stop(self, n, **small):
        plain(self, n, **small)
        seen.append(n)
        if n == 4:
            raise KeyboardInterrupt
    monkeypatch.setattr(linalg._Folder, "commit", stop)
    with pytest.raises(KeyboardInterrupt):
        fit(os.path.join(tmp_dir, "part"))
    made = {f: os.path.getmtime(f) for f in glob.glob(os.path.join(tmp_dir, "part", "*", "*", "part-*"))}
    again = fit(os.path.join(tmp_dir, "part"))
    assert seen[:5] == [0, 1, 2, 3, 4] and seen[5] == 5  # no pass twice
    assert all(os.path.getmtime(f) == t for f, t in made.items())  # and nothing written anew
    assert np.array_equal(again[2], whole[2])
    for a, b in zip(again[:2], whole[:2]):
        key = a.columns[0]
        assert [r.vec for r in a.orderBy(key).collect()] == [r.vec for r in b.orderBy(key).collect()]


def test_passes_write_alike_and_read_two_panels(spark, tmp_dir):
    df, _ = _pairs(spark, 90, 80, density=0.7, seed=2)
    linalg.truncated_svd(df.withColumnRenamed("avg_rating", "value"), "user_id", "product_id", 3, block=4, tol=1e-4, tile=32,
                         folder=tmp_dir)
    size = lambda name: sum(map(os.path.getsize, glob.glob(os.path.join(tmp_dir, "*", name, "part-*"))))
    panels = [size(f"panel-{n}") for n in range(1, 5)]
    products = [size(f"product-{n}") for n in range(1, 5)]
    assert max(panels) < 1.2 * min(panels) and max(products) < 1.2 * min(products)


def test_one_item_block_keeps_all_tasks_busy(spark):
    rng = np.random.default_rng(6)
    queries = spark.createDataFrame([(i, rng.random(3).tolist()) for i in range(3000)], "qid long, vec array<double>")
    items = spark.createDataFrame([(i, rng.random(3).tolist()) for i in range(50)], "item long, vec array<double>")
    want = sorted(map(tuple, top_n_dot(queries, items, 3).collect()))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met, _, n_items = scoring._meetings(queries, items, scoring.ITEM_BLOCK, scoring.QUERY_BLOCK)
        assert n_items == 1 and met.select(F.spark_partition_id()).distinct().count() == 40  # tasks that score
        assert sorted(map(tuple, top_n_dot(queries, items, 3).collect())) == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_recommend_cf_exclude_known(spark):
    df, rows = _pairs(spark, 8, 12, 0.4)
    model = R.svd_fit(df)
    users = spark.createDataFrame([(u,) for u in sorted({r[0] for r in rows})], "user_id long")
    recs = R.recommend_cf(model, users, n=3, exclude_known=True, train=df).collect()
    seen = {(r[0], r[1]) for r in rows}
    assert recs and all((r.user_id, r.product_id) not in seen for r in recs)
    with pytest.raises(ValueError):
        R.recommend_cf(model, users, exclude_known=True)
    plain = R.recommend_cf(model, users, n=3).collect()
    assert len(plain) == 3 * len({r[0] for r in rows})


def test_content_recommendations_clean_the_purchases_once(spark, monkeypatch):
    from basketry.plans import catalog, context
    plain, calls = context.C.clean_transactions, []
    monkeypatch.setattr(context.C, "clean_transactions", lambda *x: calls.append(1) or plain(*x))
    recs, test, users = catalog._cb_eval_recs(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1 and test.columns == ["user_id", "product_id"]
    assert recs.select("user_id").distinct().count() == users.count() > 0
