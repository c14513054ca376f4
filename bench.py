"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The metric is the wall time of the heavy step (building the tests, signal preparation
and coloc of every test, materialised); tests/s/core is reported next to the baseline's
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from localspark import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    from sharedsignal.operators import abf
    from sharedsignal.plans import jobs
    from sharedsignal.plans.registry import queries
    from sharedsignal.sources.io import materialize

    qs = queries()
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        print(name, times[name], file=sys.stderr, flush=True)
        return out

    # warm-up: start the executors and read the tables' footers once
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").count().write.format("noop").mode("overwrite").save()

    # heavy step, stage by stage (each stage written to the scratch folder)
    tests = timed("tests", lambda: jobs.tests(spark, sf_dir))
    n_tests = tests.count()
    stats = timed("signal_stats", lambda: materialize(jobs.signal_stats(spark, sf_dir, tests), "signal_stats"))
    raw = timed("coloc", lambda: materialize(
        abf.run_coloc(tests, stats, window_kb=abf.COLOC_WINDOW_KB), "coloc_raw"))
    n_results = raw.count()
    heavy = times["tests"] + times["signal_stats"] + times["coloc"]

    jobs.clear_cache()
    for name in ["overlap_table", "coloc_processed", "join_betas", "ld_pairs", "coloc_features"]:
        if name in qs:  # coloc_processed builds the raw results that the later ones read
            timed(name, lambda n=name: qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save())

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "coloc_heavy_step_seconds",
        "value": round(heavy, 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else None,
        "n_tests": n_tests,
        "n_results": n_results,
        "tests_per_sec_per_core": round(n_tests / heavy / cpus, 3) if heavy else None,
        "baseline_tests_per_sec_per_core": 0.0143,
        "cpus": cpus,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
