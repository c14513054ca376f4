"""Registered queries of the text operators: opN_<name> and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import costpack, covertree, filteraudit, fmindex, htmlcut, knlm, licenses, nnpu, simhash, spotsigs, suffixdedup, tokencounts, warc
from .common import ensure_scratch


def _with_scratch(fn):
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_scratch(spark)
        return fn(spark, sf_dir)
    return call


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_html_min_cut": htmlcut.query,
        "op2_quality_kneser_ney": knlm.query,
        "op3_spotsigs": spotsigs.query,
        "op4_cost_balanced_packing": costpack.query,
        "op5_token_counts": tokencounts.query,
        "op6_simhash_near_dedup": simhash.query,
        "op7_benchmark_decontamination": fmindex.query,
        "op8_toxicity_nnpu": nnpu.query,
        "op9_suffix_array_dedup": suffixdedup.query,
        "op10_license_scan": licenses.query,
        "op11_warc_segments": warc.query,
        "op12_cover_tree_negatives": covertree.query,
        "op13_filter_audit": filteraudit.query,
    }
    import corpus_pipeline

    found["pipeline"] = corpus_pipeline.run
    return {k: _with_scratch(f) for k, f in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op7_benchmark_decontamination": fmindex.SQL, "op11_warc_segments": warc.SQL, "op12_cover_tree_negatives": covertree.SQL,
            "op13_filter_audit": filteraudit.SQL}
