"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2).  Each query is forced to completion with the
``noop`` sink (full execution, nothing collected to the driver); its time is
the best of BENCH_REPEAT warm runs, which damps the host's run-to-run noise.
Rates are reported next to times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weekcast import queries as Q  # noqa: E402
from weekcast.session import local_session  # noqa: E402

HEADLINE = ["weekly_demand", "exo_features", "adjusted_demand", "dense_spine", "tail_split",
            "candidate_losses", "best_candidate", "model_index", "many_model_score", "routed_score",
            "runlog_latest", "exo_gain", "forecast_best", "rf_tuned"]


def run(spark, name, sf):
    t0 = time.perf_counter()
    df = Q.QUERIES[name](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)))
    run(spark, "weekly_demand", sf)  # warm-up: JVM, codegen, file listing
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times = {}
    for name in HEADLINE:
        times[name] = round(min(run(spark, name, sf) for _ in range(repeat)), 3)
    series = spark.read.parquet(f"{sf}/part.parquet").select("p_type", "p_brand").distinct().count()
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    total = round(sum(times.values()), 3)
    out = {"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
           "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""), "cpus": int(cpus),
           "repeat": repeat,
           "rates": {"exo_features_rows_per_s": round(rows / times["exo_features"], 1),
                     "many_model_score_rows_per_s": round(rows / times["many_model_score"], 1),
                     "forecast_best_series_per_s": round(series / times["forecast_best"], 2)}}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
