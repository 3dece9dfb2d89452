"""Benchmark: headline queries + vectorised vs naive lambda sweep.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Each query runs end to end from the parquet tables
(its own split included: kept analyses are reset before every query) and is
executed with the ``noop`` sink, so the whole plan runs without shipping
rows to Python.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from biasfit.plans.catalog import QUERIES, analysis, reset_analyses  # noqa: E402
from biasfit.operators.sweep import sweep_bias, sweep_bias_naive  # noqa: E402
from biasfit.session import get_session  # noqa: E402
from biasfit.sources.testdata import TestdataViews  # noqa: E402

HEADLINE = ["ratings_fact", "stratified_holdout", "train_test_split", "bias_lambda_sweep",
            "forward_selection", "flag_boxstats", "final_score"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", app="biasfit-bench", shuffle_partitions=2 * cpus,
                        extra={"spark.driver.memory": "16g"})
    # warm-up (JVM start, first scans): not timed
    run(TestdataViews(spark, sf_dir).facts())

    times: dict[str, float] = {}
    for name in HEADLINE:
        reset_analyses()          # every query pays for its own split: standalone timings
        t = time.time()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t, 3)

    # vectorised (one plan for 41 lambdas) vs naive (one fit + score per lambda), same split
    reset_analyses()
    p = analysis(spark, sf_dir)
    train, test, mu = p.train, p.test, p.mu
    grid = list(p.cfg.bias_grid)
    t = time.time()
    vec = {r["lambda"]: r["rmse"] for r in sweep_bias(train, test, grid, mu, stats=p.item_stats,
                                                       total=p.n_train).collect()}
    t_vec = time.time() - t
    t = time.time()
    naive = dict(sweep_bias_naive(train, test, grid, mu))
    t_naive = time.time() - t
    diff = max(abs(vec[l] - naive[l]) for l in grid)

    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "sweep": {"lambdas": len(grid), "vectorised_sec": round(t_vec, 3), "naive_sec": round(t_naive, 3),
                  "speedup": round(t_naive / t_vec, 2) if t_vec else None, "max_abs_rmse_diff": diff},
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
