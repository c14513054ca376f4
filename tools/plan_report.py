"""Print the formatted physical plans of the heavy step and key joins.

usage: python tools/plan_report.py [sf_dir]
Shows where the exchanges are (one hash exchange on test_id for window + aggregate),
which joins are broadcast after measurement, and the pushed filters / read schema of
each Parquet scan.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from localspark import local_session
    from sharedsignal.operators import abf, betas
    from sharedsignal.plans import jobs
    from sharedsignal.sources import adapters as A
    from sharedsignal.sources.io import materialize

    spark = local_session()
    tests = jobs.tests(spark, sf_dir)
    stats = materialize(jobs.signal_stats(spark, sf_dir, tests), "signal_stats")
    sections = {
        "signal_stats (binned range join signals x sumstats)": jobs.signal_stats(spark, sf_dir, tests),
        "run_coloc (harmonise + window + aggregate)": abf.run_coloc(tests, stats),
        "join_betas": betas.join_betas(jobs.coloc_processed(spark, sf_dir), A.sumstats(spark, sf_dir)),
    }
    for title, df in sections.items():
        print("=" * 100)
        print(title)
        print("=" * 100)
        df.explain("formatted")


if __name__ == "__main__":
    main()
