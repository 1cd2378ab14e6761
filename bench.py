"""Benchmark: the six stage jobs end to end on the driver tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line with per-stage seconds; ``value`` is the total.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from basketry.plans import jobs
    from basketry.session import build_session
    from basketry.sources.files import scratch_dir
    from basketry.sources.roles import DEFAULT_AS_OF
    from basketry.sources.shared import discard_intermediates

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    out = scratch_dir(spark, "bench")
    times: dict[str, float] = {}

    def stage(name, fn):
        t0 = time.perf_counter()
        res = fn()
        if res is not None and hasattr(res, "collect"):
            res.collect()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"[bench] {name}: {times[name]}s", file=sys.stderr, flush=True)
        return res

    stage("ingest", lambda: jobs.ingest(spark, sf_dir, out))
    stage("validate", lambda: jobs.validate(spark, out))
    stage("prepare", lambda: jobs.prepare(spark, out, DEFAULT_AS_OF) and None)
    stage("transform", lambda: jobs.transform(spark, out, DEFAULT_AS_OF))
    stage("feature_store", lambda: jobs.feature_store(spark, out, "v1", created_at=DEFAULT_AS_OF))
    metrics = stage("train", lambda: jobs.train(spark, out, "v1"))
    m = {r["model"]: {k: r[k] for k in ("precision_at_k", "recall_at_k", "ndcg_at_k", "rmse")}
         for r in metrics.collect()}
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "end_to_end_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else sf_dir, "cpus": cpus,
                      "model_metrics": m}))
    discard_intermediates(spark)
    spark.stop()


if __name__ == "__main__":
    main()
