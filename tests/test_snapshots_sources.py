import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from basketry import schemas as S
from basketry.operators import snapshots as K
from basketry.sources import files as SF
from basketry.streaming.landing import land_csv_stream


def _feats(spark):
    u = spark.createDataFrame([(1, 2.0, None), (2, None, "x")], "user_id long, a double, b string")
    i = spark.createDataFrame([(10, 1)], "product_id long, total_purchases long")
    return {"user_features": u, "item_features": i}


def test_snapshot_roundtrip_latest_and_fingerprint(spark, tmp_dir):
    f = _feats(spark)
    m1 = K.snapshot_write(f, tmp_dir, "v1", created_at=dt.datetime(2024, 1, 1)).first()
    K.snapshot_write({"user_features": f["user_features"]}, tmp_dir, "v2", created_at=dt.datetime(2024, 1, 2))
    assert K.latest_version(spark, tmp_dir) == "v2"
    got = K.snapshot_read(spark, tmp_dir, "v1")
    assert set(got) == {"user_features", "item_features"}
    assert sorted(got["user_features"].collect()) == sorted(f["user_features"].collect())
    # equal data -> equal hash, independent of partitioning
    m3 = K.snapshot_write({n: df.repartition(3) for n, df in f.items()}, tmp_dir, "v3",
                          created_at=dt.datetime(2024, 1, 3)).first()
    assert m1.data_hash == m3.data_hash
    assert K.manifest(spark, tmp_dir).count() == 3


def test_snapshot_read_falls_back_to_current(spark, tmp_dir):
    cur = _feats(spark)
    assert K.snapshot_read(spark, os.path.join(tmp_dir, "none"), current=cur) == cur


def test_entity_lookup_unknown_ids(spark):
    u = _feats(spark)["user_features"]
    ids = spark.createDataFrame([(2,), (2,), (99,)], "user_id long")
    assert [r.user_id for r in K.entity_lookup(u, ids, "user_id").collect()] == [2]


def test_snapshot_lookup_opens_only_files_that_hold_an_id(spark, tmp_dir):
    users = spark.range(0, 4000, 2).select(F.col("id").alias("user_id"), (F.col("id") * 1.5).alias("a"))
    items = spark.createDataFrame([(f"P{i:04d}", i) for i in range(300)] + [(None, -1)], "product_id string, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files of so few rows
    try:
        K.snapshot_write({"user_features": users, "item_features": items, "none": spark.range(2)}, tmp_dir, "v1",
                         created_at=dt.datetime(2024, 1, 1))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    every = spark.read.parquet(os.path.join(tmp_dir, "tables", "table=user_features", "version=v1")).inputFiles()
    assert len(every) > 2
    ids = spark.createDataFrame([(10,), (12,), (12,), (13,), (None,), (99999,)], "user_id long")
    got = K.snapshot_lookup(spark, tmp_dir, "user_features", ids)
    assert sorted(map(tuple, got.collect())) == [(10, 15.0), (12, 18.0)] and len(got.inputFiles()) == 1
    assert K.snapshot_lookup(spark, tmp_dir, "user_features", ids.where("user_id > 5000")).collect() == []
    many = spark.range(3000).select(F.col("id").alias("user_id"))
    got = K.snapshot_lookup(spark, tmp_dir, "user_features", many, "v1")
    assert got.count() == 1500 and len(got.inputFiles()) < len(every)
    got = K.snapshot_lookup(spark, tmp_dir, "item_features", spark.createDataFrame([("P0007",), ("P02",)], "product_id string"))
    assert [tuple(r) for r in got.collect()] == [("P0007", 7)]


def test_features_computed_again_have_the_same_fingerprint(spark):
    from basketry.plans.context import Tables
    old = spark.conf.get("spark.sql.shuffle.partitions")
    prints = []
    try:
        for n in (8, 13, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            t = Tables(spark, "/root/testdata/sf0.001")
            prints.append([tuple(K.fingerprint(df).first()) for df in (t.user_features, t.item_features, t.interactions)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert prints[0] == prints[1] == prints[2]


def test_fingerprint_tells_the_last_bit(spark):
    import numpy as np
    tiny = [1.0, 43.0921875, 1e-9, 5e-324, 0.1, -0.1, 1e18, 1e300, float("inf"), None]
    one = lambda x: spark.createDataFrame([(x,)], "a double")
    base = {x: K.fingerprint(one(x)).first()["hash_sum"] for x in tiny}
    assert len(set(base.values())) == len(tiny)
    assert base[5e-324] == K.fingerprint(one(0.0)).first()["hash_sum"]  # no bit down to 2^-104
    for x in (43.0921875, 0.1, -0.1, 1e-9):
        assert K.fingerprint(one(float(np.nextafter(x, 1e9)))).first()["hash_sum"] != base[x]
    assert K.fingerprint(one(-0.0)).first() == K.fingerprint(one(0.0)).first()


def test_catalogue_filter_by_entity(spark):
    tables = {"user_features": spark.createDataFrame([(1, 3)], "user_id long, total_transactions long"),
              "item_features": spark.createDataFrame([(1, 5)], "product_id long, total_purchases long"),
              "interaction_features": spark.createDataFrame([(1, 1, 4.0)], "user_id long, product_id long, avg_rating double")}
    cat = K.feature_catalogue(tables, entity="user").collect()
    assert len(cat) == 7 and {r.entity for r in cat} == {"user"}
    tt = [r for r in cat if r.name == "total_transactions"][0]
    assert tt.n == 1 and tt.max == 3.0


def test_csv_scan_permissive_and_lineage(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t.csv")
    with open(p, "w") as fh:
        fh.write("transaction_id,user_id,product_id,quantity,rating,timestamp,payment_method\n")
        fh.write("T1,1,2,3,4.5,2024-01-01 00:00:00,card\n")
        fh.write("T2,notanumber,2,,5,2024-01-01 00:00:00,cash\n")
    df = SF.ingest_with_lineage(SF.scan_csv(spark, p, S.TRANSACTIONS), dt.datetime(2024, 2, 1))
    rows = df.orderBy("transaction_id").collect()
    assert rows[1].user_id is None and rows[1].quantity is None
    assert rows[0]._source_file == "t.csv" and rows[0]._ingestion_timestamp == "2024-02-01 00:00:00"


def test_json_payload_list_or_object(spark, tmp_dir):
    schema = "product_id long, sentiment_score double"
    a, b = os.path.join(tmp_dir, "a.json"), os.path.join(tmp_dir, "b.json")
    json.dump([{"product_id": 1, "sentiment_score": 0.5}, {"product_id": 2}], open(a, "w"), indent=2)
    json.dump({"product_id": 3, "sentiment_score": -0.1}, open(b, "w"), indent=2)
    assert SF.scan_json_payload(spark, a, schema, "api").count() == 2
    r = SF.scan_json_payload(spark, b, schema, "api").collect()
    assert len(r) == 1 and r[0]._source_api == "api"


def test_ingestion_report_isolates_failures(spark, tmp_dir):
    def boom():
        raise RuntimeError("source down")
    rep = {r.source: r for r in SF.ingestion_report(spark, {"ok": lambda: spark.range(3), "bad": boom, "none": lambda: spark.range(0)},
                                                    tmp_dir).collect()}
    assert rep["ok"].records == 3 and rep["ok"].status == "success" and rep["none"].records == 0
    assert spark.read.parquet(os.path.join(tmp_dir, "ok")).count() == 3
    assert rep["bad"].status == "failed" and "source down" in rep["bad"].error


def test_land_timestamped_appends(spark, tmp_dir):
    df = spark.range(2).withColumnRenamed("id", "x")
    l1 = SF.land_timestamped(df, tmp_dir, "t", dt.datetime(2024, 1, 1, 0, 0, 0))
    l2 = SF.land_timestamped(df, tmp_dir, "t", dt.datetime(2024, 1, 1, 0, 0, 1))
    assert l1 != l2 and SF.read_landed(spark, tmp_dir, "t").groupBy("load_ts").count().orderBy("load_ts").collect() == [(l1, 2), (l2, 2)]


def test_a_load_stopped_half_way_and_repeated_gives_each_row_once(spark, tmp_dir):
    df = spark.range(20).repartition(4).withColumnRenamed("id", "x")
    SF.land_timestamped(df, tmp_dir, "t", dt.datetime(2024, 1, 1, 0, 0, 0))
    at = dt.datetime(2024, 1, 1, 0, 0, 1)
    stops = F.when(F.col("x") == 13, F.raise_error(F.lit("executor lost"))).otherwise(F.col("x")).alias("x")
    with pytest.raises(Exception, match="executor lost"):
        SF.land_timestamped(df.select(stops), tmp_dir, "t", at)
    # as if the data had been written and the commit had not
    df.limit(7).write.mode("append").parquet(os.path.join(tmp_dir, "t", "load_ts=20240101_000001"))
    assert SF.read_landed(spark, tmp_dir, "t").count() == 20
    for _ in range(2):
        load = SF.land_timestamped(df, tmp_dir, "t", at)
        rows = SF.read_landed(spark, tmp_dir, "t")
        assert sorted(r.x for r in rows.where(F.col("load_ts") == load).collect()) == list(range(20)) and rows.count() == 40


def test_landing_stream_available_now(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    for i in range(2):
        with open(os.path.join(src, f"f{i}.csv"), "w") as fh:
            fh.write("event_id,user_id,product_id,event_type,session_id,timestamp,device,page_duration_sec\n")
            fh.write(f"{i},1,2,search,s,2024-01-01 00:00:00,mobile,1.5\n")
    q = land_csv_stream(spark, src, S.CLICKSTREAM, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"),
                        "clickstream")
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmp_dir, "out"))
    assert out.count() == 2 and set(r._source_file for r in out.collect()) == {"f0.csv", "f1.csv"}


def test_a_committed_version_is_never_written_again(spark, tmp_dir):
    f = _feats(spark)
    K.snapshot_write(f, tmp_dir, "v1", created_at=dt.datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        K.snapshot_write({n: df.limit(0) for n, df in f.items()}, tmp_dir, "v1")
    assert K.snapshot_read(spark, tmp_dir, "v1")["user_features"].count() == 2


def test_read_errors_are_not_taken_for_missing_snapshots(spark, tmp_dir):
    f = _feats(spark)
    K.snapshot_write(f, tmp_dir, "v1", created_at=dt.datetime(2024, 1, 1))
    for name in os.listdir(os.path.join(tmp_dir, "manifest", "version=v1")):
        if name.endswith(".parquet"):
            with open(os.path.join(tmp_dir, "manifest", "version=v1", name), "wb") as fh:
                fh.write(b"not parquet")
    with pytest.raises(Exception):
        K.snapshot_read(spark, tmp_dir, current=f)


def test_corrupt_source_fails_alone_with_its_whole_error(spark, tmp_dir):
    good, bad = os.path.join(tmp_dir, "good"), os.path.join(tmp_dir, "bad")
    spark.range(5).write.parquet(good)
    spark.range(5).coalesce(1).write.parquet(bad)
    for name in os.listdir(bad):
        if name.endswith(".parquet"):
            data = open(os.path.join(bad, name), "rb").read()
            with open(os.path.join(bad, name), "wb") as fh:
                fh.write(data[:20] + b"\0" * (len(data) - 20))
    schema = "id long"
    rep = {r.source: r for r in SF.ingestion_report(spark, {
        "bad": lambda: spark.read.schema(schema).parquet(bad), "good": lambda: spark.read.schema(schema).parquet(good)},
        os.path.join(tmp_dir, "landed")).collect()}
    assert (rep["good"].status, rep["good"].records) == ("success", 5)
    assert rep["bad"].status == "failed" and rep["bad"].records is None and len(rep["bad"].error) > 500
    assert all(r.ended_at >= r.started_at for r in rep.values())


def test_only_this_sessions_intermediates_are_deleted(spark, tmp_dir, monkeypatch):
    from basketry.sources import shared
    monkeypatch.setattr(shared, "ensure_checkpoint_dir", lambda spark: tmp_dir)
    other = os.path.join(tmp_dir, "basketry-cut", "other-session", "x")
    spark.range(3).write.parquet(other)
    assert shared.materialised(spark.range(5), "t").count() == 5
    shared.discard_intermediates(spark)
    assert os.listdir(os.path.join(tmp_dir, "basketry-cut")) == ["other-session"] and spark.read.parquet(other).count() == 3


def test_local_scratch_only_in_single_process_sessions():
    from basketry.session import ensure_checkpoint_dir, is_single_process

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda key, default: default)

    class Session:
        sparkContext, conf = Context, Conf
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session)
    assert is_single_process("local") and is_single_process("local[4]") and not is_single_process("local-cluster[2,1,512]")
