"""Tables that several branches need are made once; results stay those of the plain rules."""

from __future__ import annotations

from sharedsignal.operators import manifest as mf, overlap as ov
from sharedsignal.plans import jobs, registry
from sharedsignal.schemas import LOCUS_COLS

LOCUS = {"type": "gwas", "study_id": "A", "phenotype_id": None, "bio_feature": None,
         "lead_chrom": "1", "lead_pos": 10, "lead_ref": "A", "lead_alt": "C"}
SCHEMA = ", ".join(f"{s}_{c} {'bigint' if c == 'lead_pos' else 'string'}" for s in mf.SIDES for c in LOCUS_COLS)


def _manifest(spark, tmp_path, pairs):
    rows = [tuple({**LOCUS, **x}[c] for x in pair for c in LOCUS_COLS) for pair in pairs]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "concat('/s/', left_study_id) AS left_sumstats", "concat('/s/', right_study_id) AS right_sumstats",
        "if(left_study_id = 'A', null, '/ld/1') AS left_ld", "if(right_study_id = 'A', null, '/ld/1') AS right_ld")
    table.write.parquet(str(tmp_path / "m"))
    return spark.read.parquet(str(tmp_path / "m"))


def _reads(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_signals_and_inputs_read_the_tests_once(spark, tmp_path):
    m = _manifest(spark, tmp_path, [({"study_id": "B"}, {}), ({"study_id": "B"}, {}), ({"study_id": "C", "type": "eqtl"}, {"study_id": None})])
    s = mf.signals_to_prepare(m)
    assert _reads(s) == 1
    assert sorted((r["study_id"] or "", r["type"], r["ld"]) for r in s.collect()) == [
        ("", "gwas", "/ld/1"), ("A", "gwas", None), ("B", "gwas", "/ld/1"), ("C", "eqtl", "/ld/1")]
    assert [r["study_id"] for r in mf.signals_to_prepare(m, "eqtl").collect()] == ["C"]
    known = spark.createDataFrame([("/s/B",), ("/s/A",)], "path string")
    x = mf.missing_inputs(m, known)
    assert _reads(x) == 1 and x.columns == ["column", "path"]
    assert sorted(tuple(r) for r in x.collect()) == [("left_ld", "/ld/1.bed"), ("left_sumstats", "/s/C"), ("right_ld", "/ld/1.bed")]


def test_loci_are_numbered_from_written_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ov, "dictionary", lambda rows, *a: seen.append(rows.inputFiles()) or DICTIONARY(rows, *a))
    row = {**LOCUS, "tag_chrom": "1", "tag_pos": 10, "tag_ref": "A", "tag_alt": "C", "key": "k"}
    rows = spark.createDataFrame([tuple(row.values())] * 2, ", ".join(f"{c} {'bigint' if c.endswith('pos') else 'string'}" for c in row))
    numbered, loci = ov.number_loci(rows)
    assert seen[0] and all("/credset-" in f for f in seen[0])
    assert numbered.count() == 2 and loci.count() == 1


DICTIONARY = ov.dictionary


def test_progress_makes_the_manifest_once(spark, tmp_path, monkeypatch):
    m = _manifest(spark, tmp_path, [({"study_id": "B", "lead_pos": 11}, {}), ({"study_id": "B", "lead_pos": 12}, {}), ({"study_id": "B", "lead_pos": 12}, {})])
    for name, rows in (("tests_done", 1), ("tests_todo", 1), ("progress_counts", 2)):
        calls = []
        monkeypatch.setattr(jobs, "manifest", lambda *a: calls.append(a) or m.withColumn("left_lead_pos", m.left_lead_pos + 1))
        out = registry.queries()[name](spark, "unused").collect()
        assert len(out) == rows and len(calls) == 1, name
        if name == "progress_counts":
            assert {r["state"]: r["n_tests"] for r in out} == {"finished": 1, "outstanding": 1}
