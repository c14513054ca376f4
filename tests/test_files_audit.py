"""Result files that cannot be read in full, the stage audit in one pass, locus ids without hashes."""

import gzip
import itertools
import json

from pyspark.sql import functions as F

from sharedsignal import schemas
from sharedsignal.operators import overlap as ov
from sharedsignal.operators import results as rs
from sharedsignal.sources import io

SIDES = ("left", "right")
NAN = float("nan")


def _report(spark, path):
    df = io.results_file_report(spark, str(path), spark.createDataFrame([], "a int, b string").schema)
    return {r.file.rsplit("/", 1)[1]: (r.rows_read, r.rows_bad, r.status) for r in df.collect()}


def test_every_result_file_is_accounted_for(spark, tmp_path):
    lines = "".join(json.dumps({"a": i, "b": "x" * 50 + str(i * i)}) + "\n" for i in range(20_000)).encode()
    whole = gzip.compress(lines)
    sub = tmp_path / "left_study=A B%"
    sub.mkdir()
    (sub / "good.json.gz").write_bytes(whole)
    (sub / "two.json.gz").write_bytes(gzip.compress(b'{"a": 1}\n') + gzip.compress(b'{"a": 2}\n'))
    (sub / "cut.json.gz").write_bytes(whole[: len(whole) // 2])
    (sub / "noise.json.gz").write_bytes(b"no gzip at all")
    (sub / "empty.json").write_bytes(b"")
    (sub / "blank.json").write_bytes(b"\n  \n")
    (sub / "bad.json").write_bytes(b'{"a": 1, "b": "x"}\n{"a": 2, "b"\n\n{"a": 3}\n')
    got = _report(spark, tmp_path)
    assert got["good.json.gz"] == (20_000, 0, "read")
    assert got["two.json.gz"] == (2, 0, "read")
    assert got["cut.json.gz"][2] == "broken" and got["cut.json.gz"][0] < 20_000
    assert got["noise.json.gz"] == (0, 0, "broken")
    assert got["empty.json"] == (0, 0, "empty")
    assert got["blank.json"] == (0, 0, "no rows")
    assert got["bad.json"] == (3, 1, "bad rows")
    assert len(got) == 7


def _raw(spark):
    """Every combination of a few values: types, right studies, places, variants, h3 and h4, NULLs and NaNs, ties."""
    cols = [f"{s}_{c}" for s in SIDES for c in schemas.RESULT_ID_COLS]
    schema = ", ".join(f"{c} {'int' if c.endswith('_pos') else 'string'}" for c in cols)
    schema += ", nsnps int, coloc_h0 double, coloc_h1 double, coloc_h2 double, coloc_h3 double, coloc_h4 double"
    rows = []
    for lt, rt, pos, n, h3, h4 in itertools.product(("gwas", "eqtl", None), ("gwas", "pqtl"), (5, None, 9), (9, 100, None),
                                                    (0.0, 0.2, NAN, None), (0.5, 0.5, 0.9, NAN, None)):
        rows.append((lt, "L", None, None, "1", 7, "A", "C", rt, "R", "P", None, "1", pos, "A", None if pos == 9 else "T",
                     n, 0.0, 0.0, 0.0, h3, h4))
    return spark.createDataFrame(rows, schema)


def _audit_by_steps(raw, least, digits):
    s0 = rs.add_ratios(rs.rename_raw(raw))
    s1 = rs.filter_min_vars(s0, least)
    s2 = rs.make_symmetric(s1)
    s3 = rs.filter_left_gwas(s2)
    s4 = rs.dedup_right(s3, digits)
    return [d.count() for d in (s0, s1, s2, s3, s4, rs.drop_null_stats(s4))]


def test_audit_equals_the_steps_one_by_one(spark):
    raw = _raw(spark)
    # of rows equal in the whole order any may be kept: keep one of each
    raw = raw.dropDuplicates([c for c in raw.columns if c != "coloc_h3"])
    for rows, least, digits in ((raw, 100, None), (raw, None, 9), (raw.limit(0), 100, None)):
        rows = io.materialize(rows, "audit-raw")
        got = {r.stage: r.n_rows for r in rs.stage_audit(rows, least, digits).collect()}
        assert [got[s] for s in rs.AUDIT_STAGES] == _audit_by_steps(rows, least, digits)


def test_audit_scans_its_input_once(spark):
    raw = io.materialize(_raw(spark), "audit-raw")
    plan = rs.stage_audit(raw, 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Window" not in plan


LOCI = [("gwas" if i % 2 else "eqtl", f"S{i % 5}", None if i % 3 else "P", None, "1", 100 + i, "A", "C") for i in range(30)]


def test_overlaps_do_not_depend_on_hashes(spark, monkeypatch):
    rows = [(*k, "1", t, "A", "C", None, 0.1, 0.1, 0.1, 0.1, True, True, "conditional")
            for i, k in enumerate(LOCI) for t in range(i % 4, 8)]
    names = schemas.CREDSET.fieldNames()
    df = spark.createDataFrame([dict(zip([*schemas.LOCUS_COLS, *ov.TAG_COLS], r)) | {"is95_credset": True, "is99_credset": True,
                                "multisignal_method": "conditional"} for r in rows], schemas.CREDSET).select(*names)
    want = sorted(map(tuple, ov.find_overlaps(df, keep_keys=True).collect()), key=str)
    # every hash collides: the same result
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("bigint"))
    monkeypatch.setattr(ov, "locus_id", lambda *a, **k: F.lit(1).cast("bigint"))
    assert sorted(map(tuple, ov.find_overlaps(df, keep_keys=True).collect()), key=str) == want
    numbered, loci = ov.number_loci(ov.prepare_credset(df))
    assert sorted(r.id for r in loci.collect()) == list(range(30))
    assert numbered.count() == len(rows)
    assert want and len({(r[0], r[1]) for r in want}) == len(want)
