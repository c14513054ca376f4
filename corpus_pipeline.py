"""Training-corpus pipeline: quality filter, near-duplicates, repeated passages, benchmark passages, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns
a DataFrame.  ``run`` applies them to ``documents``: every stage's rows are written as
Parquet below ``spark.checkpoint.dir`` and read back as the next stage's input.  All but
the last return the columns of ``documents``.

Defined cases: an empty table passes through as an empty table; null and empty texts
are rejected by the quality stage; rows that repeat an id are judged each by their text,
and near-duplicate groups keep all rows of the kept id; extra columns pass through,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sharedsignal.llm import costpack, fmindex, knlm, simhash, suffixdedup
from sharedsignal.llm.common import ensure_scratch, scratch, small_batches, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies within their language's thresholds."""
    small_batches(spark)
    model = knlm.train(docs, knlm.trusted_ids(table(spark, sf_dir, "labels")))
    return model.kept(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    small_batches(spark)
    return simhash.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that also stand elsewhere."""
    small_batches(spark)
    return suffixdedup.remove_repeated_words(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items."""
    return fmindex.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences."""
    return costpack.pack(docs, costpack.tokenizer_path(), with_ids=False)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: The stages are a language model, hashes SQL lacks, and a tokenizer: tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
