"""Query catalogue, part 5: prepared signal statistics kept between runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import abf
from ..operators.store import new_store
from ..sources import adapters as A
from ..sources.io import materialize, scratch_root
from . import jobs, oracle as O
from .adapters_sql import with_adapters
from .registry import query, rounded, rounded_sql

PP = [f"coloc_h{i}" for i in range(5)]
RAW_COLS = O.RES16 + ["nsnps"] + PP
#: The first run asks for the signals of the tests with an even left lead position, the others for all.
_FIRST = "left_lead_pos % 2 = 0"

_RUNS_SQL = f"""
, first_v AS ({' UNION '.join(f"SELECT {', '.join(f'{s}_{c} AS {c}' for c in abf.LOCUS_COLS)} FROM tests_v WHERE {_FIRST}" for s in ('left', 'right'))})
, n_v AS (SELECT (SELECT count(*) FROM first_v) AS f, (SELECT count(*) FROM signals_v) AS a, (SELECT count(*) FROM sig_stats_v) AS s,
  (SELECT count(*) FROM sig_stats_v x WHERE EXISTS (SELECT 1 FROM first_v y WHERE {O.nse_map('x', 'y', [(c, c) for c in abf.LOCUS_COLS])})) AS fs)
SELECT 'run1' AS run, f AS n_requested, 0 AS n_reused, f AS n_prepared, fs AS n_stats FROM n_v
UNION ALL SELECT 'run2', a, f, a - f, s FROM n_v
UNION ALL SELECT 'run3', a, a, 0, s FROM n_v"""


def _runs(spark, d):
    """The store and the report of three runs on it: half of the tests, all of them, all of them again."""
    store, tests, out = new_store(scratch_root(spark)), jobs.tests(spark, d), None
    for run, asked in (("run1", tests.filter(_FIRST)), ("run2", tests), ("run3", tests)):
        report = materialize(store.prepare(abf.signals_with_ids(asked), A.sumstats(spark, d), run), "store-run")
        out = report if out is None else out.unionByName(report)
    return store, tests, out


@query("signal_store_runs", with_adapters("SELECT 1", "signals_v", "sig_stats_v").removesuffix("SELECT 1").rstrip() + _RUNS_SQL)
def q_signal_store_runs(spark, d):
    """S18 + U5: signals requested, reused and prepared by each of three runs."""
    return _runs(spark, d)[2].select("run", *[F.col(c).cast("bigint").alias(c) for c in ("n_requested", "n_reused", "n_prepared", "n_stats")])


@query("coloc_results_stored", with_adapters(rounded_sql("SELECT * FROM coloc_raw_v", RAW_COLS, PP), "coloc_raw_v"))
def q_coloc_results_stored(spark, d):
    """M5 on statistics that two runs left in a store."""
    store, tests, _ = _runs(spark, d)
    return rounded(abf.run_coloc(tests, store.stats(spark), window_kb=abf.COLOC_WINDOW_KB).select(*RAW_COLS), PP)
